"""SNK-3, SNK-6: a crash at any step leaves the old or the new table readable."""

import os
from concurrent.futures import ThreadPoolExecutor

import pytest

from metroframe.sinks import versions as V


def table(spark, *names):
    return spark.createDataFrame([(k, n) for k, n in enumerate(names)], "k int, d string")


def names(df):
    return sorted(r["d"] for r in df.collect())


def test_publish_read_roll_back_clean_up(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    assert V.commits(spark, root) == []
    assert V.publish(table(spark, "강남구", "중구"), root, ["d"]) == 1
    assert V.publish(table(spark, "05"), root, ["d"]) == 2
    assert names(V.read_published(spark, root)) == ["05"]  # text stays text, and the old partitions are gone
    assert V.read_published(spark, root).columns == ["k", "d"]
    assert names(V.read_published(spark, root, 1)) == ["강남구", "중구"]
    assert V.commit(spark, root, 1)["rows"] == 2
    assert V.roll_back(spark, root, 1) == 3 and names(V.read_published(spark, root)) == ["강남구", "중구"]
    V.publish(table(spark, "c"), root)
    V.publish(table(spark, "d"), root)
    assert len(V.clean_up(spark, root, keep=2)) == 2  # commit 3 named the first folder again
    assert V.commits(spark, root) == [4, 5] and names(V.read_published(spark, root, 4)) == ["c"]
    assert V.publish(table(spark), root, ["d"]) == 6 and V.read_published(spark, root).count() == 0
    with pytest.raises(ValueError):
        V.clean_up(spark, root, keep=0)


@pytest.mark.parametrize("step", ["write", "draft", "rename", "table"])
def test_crash_at_each_step(spark, tmp_dir, monkeypatch, step):
    root, name = f"{tmp_dir}/t", f"crash_{step}"
    V.publish_table(table(spark, "old"), name, root, ["d"])

    class Lost(Exception):
        pass

    def lost(*a, **k):
        raise Lost

    if step == "write":  # some files of the new version are written, then the job dies
        from pyspark.sql import functions as F
        bad = table(spark, "x", "y").withColumn("k", F.when(F.col("d") == "y", F.raise_error(F.lit("lost"))).otherwise(F.col("k")))
        with pytest.raises(Exception, match="lost"):
            V.publish_table(bad, name, root, ["d"])
        assert names(V.read_published(spark, root)) == ["old"] and names(spark.table(name)) == ["old"]
        return
    where = {"draft": "_commit", "rename": "commits", "table": "repair_table"}[step]
    with monkeypatch.context() as m:
        m.setattr(V, where, lost)
        with pytest.raises(Lost):
            V.publish_table(table(spark, "new"), name, root, ["d"])
    if step == "table":  # committed: path readers see the new rows, the catalog the old, until it is repaired
        assert names(V.read_published(spark, root)) == ["new"] and names(spark.table(name)) == ["old"]
        assert V.repair_table(spark, name, root) and names(spark.table(name)) == ["new"]
        assert not V.repair_table(spark, name, root)
    else:
        assert names(V.read_published(spark, root)) == ["old"] and names(spark.table(name)) == ["old"]
        assert not [f for f in os.listdir(f"{root}/_versions") if not f.startswith(".") and int(f) > 1]
    # the dead job's folder goes once it is old enough; the current one stays
    V.publish_table(table(spark, "next"), name, root, ["d"])
    V.clean_up(spark, root, keep=1, older_than=-1)
    assert len([f for f in os.listdir(root) if f.startswith("v-")]) == 1 and names(spark.table(name)) == ["next"]
    spark.sql(f"DROP TABLE {name}")


def test_writers_at_once_all_commit(spark, tmp_dir):
    root = f"{tmp_dir}/t"
    with ThreadPoolExecutor(6) as pool:
        got = list(pool.map(lambda k: V.publish(table(spark, f"n{k}"), root), range(6)))
    assert sorted(got) == V.commits(spark, root) == [1, 2, 3, 4, 5, 6]
    assert {names(V.read_published(spark, root, n))[0] for n in got} == {f"n{k}" for k in range(6)}


def test_plain_folders_are_read_as_they_are(spark, tmp_dir):
    table(spark, "p").write.parquet(f"{tmp_dir}/plain")
    assert names(V.read_published(spark, f"{tmp_dir}/plain")) == ["p"]
