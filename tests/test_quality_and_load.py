"""DQ-1 and P-7 in the pass that writes; SNK-7 by position, with rejects."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from metroframe.operators.quality import ObservedQuality, Rule, check_quality, store_results
from metroframe.sinks import tables as ST
from metroframe.sinks.versions import publish, read_published

RULES = [Rule("column_count", "=", 2), Rule("row_count", ">", 3), Rule("completeness", ">=", 0.75, "a"), Rule("uniqueness", "<", 1, "b")]


def watched(spark, folder, values):
    """A table that leaves a file for every time one of its partitions is computed."""
    os.makedirs(folder)

    def leave(batches):
        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        yield from batches

    return spark.createDataFrame(values, "a string, b int").coalesce(1).mapInArrow(leave, "a string, b int")


def test_rules_are_measured_by_the_write(spark, tmp_dir):
    values = [("x", 1), (None, 1), ("y", 2), ("z", 3)]
    quality = ObservedQuality(watched(spark, f"{tmp_dir}/seen", values), RULES)
    publish(quality.data, f"{tmp_dir}/t")
    results = quality.results(read_published(spark, f"{tmp_dir}/t"))
    assert [(r["value"], r["passed"]) for r in results.collect()] == [(2.0, True), (4.0, True), (0.75, True), (0.75, True)]
    assert len(os.listdir(f"{tmp_dir}/seen")) == 1  # one pass over the source
    plain = check_quality(spark.createDataFrame(values, "a string, b int"), RULES)
    assert plain.collect() == results.collect()
    store_results(results, f"{tmp_dir}/results", "t", "1")
    store_results(results.where("rule_id = 0"), f"{tmp_dir}/results", "t", "2")
    assert spark.read.parquet(f"{tmp_dir}/results").groupBy("run").count().count() == 2
    with pytest.raises(ValueError):
        quality.results()
    with pytest.raises(ValueError):
        ObservedQuality(read_published(spark, f"{tmp_dir}/t"), [Rule("nonsense", ">", 0)])


def test_schema_rules_read_nothing(spark, tmp_dir):
    rules = [Rule("column_count", ">", 0)]
    df = watched(spark, f"{tmp_dir}/seen", [("x", 1)])
    assert check_quality(df, rules).first()["passed"] and not os.listdir(f"{tmp_dir}/seen")
    quality = ObservedQuality(df, rules)
    assert quality.results().first()["value"] == 2.0 and not os.listdir(f"{tmp_dir}/seen")


def test_empty_tables(spark, tmp_dir):
    quality = ObservedQuality(spark.createDataFrame([], "a string, b int"), RULES)
    publish(quality.data, f"{tmp_dir}/t")
    assert [(r["value"], r["passed"]) for r in quality.results(read_published(spark, f"{tmp_dir}/t")).collect()] == [
        (2.0, True), (0.0, False), (1.0, True), (1.0, False)]


def test_library_job_reads_once_and_keeps_results(spark, tmp_dir):
    from metroframe.plans import jobs as J

    os.makedirs(f"{tmp_dir}/raw/request_date=240601/district=강남구")
    with open(f"{tmp_dir}/raw/request_date=240601/district=강남구/a.csv", "w", encoding="utf-8") as f:
        f.write("libCode,libName,latitude,longitude,homepage,BookCount,district\n1,가,37.5,127.0,http://l,5,강남구\n2,,37.5,127.0,,x,강남구\n")
    rules = [Rule("column_count", ">", 0), Rule("completeness", "=", 1, "lib_name")]
    for _ in range(2):
        out = J.library_job(spark, f"{tmp_dir}/raw", f"{tmp_dir}/cur", f"{tmp_dir}/results", rules)
    assert [(r["value"], r["passed"]) for r in out.collect()] == [(6.0, True), (0.5, False)]
    assert read_published(spark, f"{tmp_dir}/cur").count() == 2  # a failed rule blocks nothing
    kept = spark.read.parquet(f"{tmp_dir}/results")
    assert kept.count() == 4 and kept.select("run").distinct().count() == 2 and kept.first()["dataset"] == "library"


@pytest.fixture
def target(spark, tmp_dir):
    name = f"load_{uuid.uuid4().hex[:8]}"
    ST.create_empty_table(spark, name, spark.createDataFrame([], "k bigint, d date, x double, s string").schema, f"{tmp_dir}/table")
    yield name
    spark.sql(f"DROP TABLE {name}")


def test_load_by_position(spark, tmp_dir, target):
    rows = spark.createDataFrame([("1", "2024-01-05", 1.5, 7), (None, None, None, None)], "s string, x string, d float, k int")
    rows.withColumn("part", F.lit("p")).write.partitionBy("part").parquet(f"{tmp_dir}/files")  # the folder's key is no column
    assert ST.bulk_load(spark, target, f"{tmp_dir}/files") == (2, 0)
    got = sorted(map(str, map(tuple, spark.table(target).collect())))
    assert got == sorted(["(1, datetime.date(2024, 1, 5), 1.5, '7')", "(None, None, None, None)"])


def test_load_rejects(spark, tmp_dir, target):
    rows = spark.createDataFrame([("1", "2024-01-05", "1"), ("x", "no", "1"), ("3", "2024-01-07", "y"), ("99999999999999999999", None, None)],
                                 "a string, b string, c string").withColumn("e", F.lit("t"))
    rows.write.parquet(f"{tmp_dir}/files")
    with pytest.raises(ST.LoadError, match="3 rows .* k 2, d 1, x 1"):
        ST.bulk_load(spark, target, f"{tmp_dir}/files", rejects_path=f"{tmp_dir}/bad", max_rejects=2)
    assert spark.table(target).count() == 0 and not os.path.exists(f"{tmp_dir}/bad")
    assert ST.bulk_load(spark, target, f"{tmp_dir}/files", rejects_path=f"{tmp_dir}/bad", max_rejects=3) == (1, 3)
    bad = {r["row"]: r["failed"] for r in spark.read.parquet(f"{tmp_dir}/bad").collect()}
    assert bad['{"a":"x","b":"no","c":"1","e":"t"}'] == ["k", "d"] and len(bad) == 3


def test_load_refuses_other_shapes(spark, tmp_dir, target):
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{tmp_dir}/narrow")
    with pytest.raises(ValueError, match="4 columns, the files 1"):
        ST.bulk_load(spark, target, f"{tmp_dir}/narrow")
    spark.sql("SELECT array(1) a, DATE'2024-01-01' b, 1.0D c, 's' d").write.parquet(f"{tmp_dir}/odd")
    with pytest.raises(TypeError, match="array"):
        ST.bulk_load(spark, target, f"{tmp_dir}/odd")
    assert spark.table(target).count() == 0
