"""SNK-8: only partitions that differ are copied, and the result is verified."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from metroframe.sinks import files as SK


def files(path):
    return {f: os.path.getmtime(f) for f in glob.glob(f"{path}/**/*.parquet", recursive=True)}


@pytest.fixture
def stores(spark, tmp_dir):
    rows = [(k, f"v{k}", 2024, k % 3) for k in range(30)] + [(99, None, 2023, 1), (100, "x", 2024, None)]
    SK.write_parquet(spark.createDataFrame(rows, "k long, v string, y int, m int"), f"{tmp_dir}/src", ["y", "m"])
    return f"{tmp_dir}/src", f"{tmp_dir}/dst"


def run(spark, stores, where=None):
    out = SK.copy_partitions(spark, *stores, F.col("y") == 2024 if where is None else where, ["y", "m"])
    return {r["m"]: r["state"] for r in out.collect()}


def test_second_run_copies_nothing(spark, stores):
    assert run(spark, stores) == {0: "copied", 1: "copied", 2: "copied", None: "copied"}
    before = files(stores[1])
    assert run(spark, stores) == {0: "same", 1: "same", 2: "same", None: "same"} and files(stores[1]) == before
    copied = spark.read.parquet(stores[1])
    assert copied.count() == 31 and copied.where("y = 2023").count() == 0


def test_damaged_and_interrupted_copies_are_repaired(spark, stores):
    run(spark, stores)
    part = f"{stores[1]}/y=2024/m=1"
    old = spark.read.parquet(part).collect()
    for damage in (old[:-1], old + old[:2], [(r["k"], "changed") for r in old], []):
        spark.createDataFrame(damage, "k long, v string").coalesce(1).write.mode("overwrite").parquet(part)
        before = files(f"{stores[1]}/y=2024/m=0")
        assert run(spark, stores) == {0: "same", 1: "copied", 2: "same", None: "same"}
        assert files(f"{stores[1]}/y=2024/m=0") == before  # the others are not touched
        assert sorted(map(tuple, spark.read.parquet(part).collect())) == sorted(map(tuple, old))
    # a run that died after one partition: the next one copies the rest
    SK.copy_partitions(spark, stores[0], f"{stores[1]}2", (F.col("y") == 2024) & (F.col("m") == 0), ["y", "m"])
    assert run(spark, (stores[0], f"{stores[1]}2")) == {0: "same", 1: "copied", 2: "copied", None: "copied"}


def test_extra_partitions_stay(spark, stores):
    run(spark, stores)
    SK.append_parquet(spark.createDataFrame([(7, "own", 2024, 9)], "k long, v string, y int, m int"), stores[1], ["y", "m"])
    assert run(spark, stores)[9] == "extra"
    assert spark.read.parquet(stores[1]).where("m = 9").count() == 1


def test_a_copy_that_does_not_arrive_fails(spark, stores, monkeypatch):
    monkeypatch.setattr(SK, "overwrite_partitions", lambda *a: None)
    with pytest.raises(OSError, match="differ"):
        run(spark, stores)
