"""STM-1: incremental ingest, 3 rows, 3 again on re-run, 5 after a new file."""

import os

from metroframe.streaming.ingest import incremental_ingest


def test_incremental_ingest(spark, tmp_dir):
    land, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("land", "sink", "ckpt"))
    os.makedirs(land)
    schema = spark.createDataFrame([], "bookname string, district string, loan_count string").schema
    with open(os.path.join(land, "a.csv"), "w", encoding="utf-8-sig") as f:
        f.write("bookname,district,loan_count\n책1,강남구,3\n책2,강남구,5\n책3,종로구,1\n")
    assert incremental_ingest(spark, land, schema, sink, ckpt) == 3
    assert spark.read.parquet(sink).count() == 3
    assert incremental_ingest(spark, land, schema, sink, ckpt) == 0  # nothing new: nothing added
    assert spark.read.parquet(sink).count() == 3
    with open(os.path.join(land, "b.csv"), "w", encoding="utf-8-sig") as f:
        f.write("bookname,district,loan_count\n책4,중구,2\n책5,중구,7\n")
    assert incremental_ingest(spark, land, schema, sink, ckpt) == 2
    back = spark.read.parquet(sink)
    assert back.count() == 5
    assert sorted(r["bookname"] for r in back.collect()) == ["책1", "책2", "책3", "책4", "책5"]


def test_back_dated_files_many_batches_and_reset(spark, tmp_dir):
    from metroframe.streaming.ingest import reset_ingest

    land, sink, ckpt = (os.path.join(tmp_dir, n) for n in ("land", "sink", "ckpt"))
    os.makedirs(land)
    schema = spark.createDataFrame([], "a string").schema
    for k in range(103):
        with open(os.path.join(land, f"{k}.csv"), "w") as f:
            f.write(f"a\n{k}\n")
    assert incremental_ingest(spark, land, schema, sink, ckpt, max_files_per_trigger=1) == 103
    path = os.path.join(land, "old.csv")
    with open(path, "w") as f:
        f.write("a\nold\n")
    os.utime(path, (1_000_000_000, 1_000_000_000))
    assert incremental_ingest(spark, land, schema, sink, ckpt) == 1
    reset_ingest(spark, sink, ckpt)
    assert incremental_ingest(spark, land, schema, sink, ckpt) == 104
    assert spark.read.parquet(sink).count() == 104
