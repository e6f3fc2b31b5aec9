"""SRC-1, SRC-5, P-1: columns by header name, in batch and in the stream."""

import os

import pytest
from pyspark.sql import types as T

from metroframe.sources import headers as H
from metroframe.streaming.ingest import LEDGER, incremental_ingest, ledger


def put(path, text, encoding="utf-8"):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding=encoding, newline="") as f:
        f.write(text)


SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.LongType()), T.StructField("k", T.StringType())])


def test_orders_missing_extra_and_folders(spark, tmp_dir):
    put(f"{tmp_dir}/t/k=x/1.csv", "﻿a,n\n가,1\n\"q,\"\"r\"\"\nline\",2\n")
    put(f"{tmp_dir}/t/k=x/2.csv", "n,zzz, a \n3,drop,나\nbad,drop,다\n")
    put(f"{tmp_dir}/t/k=y z/3.csv", "k,n\nfile,4\n")
    put(f"{tmp_dir}/t/k=y z/4.csv", "")
    put(f"{tmp_dir}/t/k=y z/5.csv", "a,n\n")
    rows = H.read_csv_by_name(spark, f"{tmp_dir}/t", SCHEMA)
    assert rows.columns == ["a", "n", "k"]
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(
        [("가", 1, "x"), ('q,"r"\nline', 2, "x"), ("나", 3, "x"), ("다", None, "x"), (None, 4, "y z")], key=str)
    free = H.read_csv_by_name(spark, f"{tmp_dir}/t")
    assert free.columns == ["a", "n", "k", "zzz"] and set(dict(free.dtypes).values()) == {"string"} and free.count() == 5
    with pytest.raises(ValueError, match="missing"):
        H.read_csv_by_name(spark, f"{tmp_dir}/t", SCHEMA, required=["a"])
    put(f"{tmp_dir}/t/k=x/6.csv", "a,n,a\n1,2,3\n")
    with pytest.raises(ValueError, match="twice"):
        H.read_csv_by_name(spark, f"{tmp_dir}/t", SCHEMA)
    assert H.read_csv_by_name(spark, f"{tmp_dir}/nothing", SCHEMA).count() == 0


def test_catalog_opens_only_new_files(spark, tmp_dir, monkeypatch):
    wide = ",".join(f"column_{k}" for k in range(2000))  # longer than the first read
    put(f"{tmp_dir}/t/1.csv", wide + "\n" + ",".join(["v"] * 2000) + "\n")
    put(f"{tmp_dir}/t/2.csv", '"two\nlines",b\r\n1,2\r\n')
    put(f"{tmp_dir}/t/3.csv", "이름,값", encoding="cp949")
    files = H.list_files(spark, f"{tmp_dir}/t")
    first = H.header_catalog(spark, files[:2])
    assert [len(v) for v in first.values()] == [2000, 2] and first[files[1]] == ("two\nlines", "b")
    assert H.read_header(spark, files[2], encoding="cp949") == ("이름", "값")
    opened = []
    monkeypatch.setattr(H, "read_header", lambda s, f, **o: opened.append(f.path) or ("x",))
    H.header_catalog(spark, files, known=first)
    assert opened == [files[2].path]


def test_stream_takes_columns_by_name(spark, tmp_dir):
    land, sink, ckpt = (f"{tmp_dir}/{n}" for n in ("land", "sink", "ckpt"))
    put(f"{land}/k=x/1.csv", "a,n\n가,1\n")
    put(f"{land}/k=x/2.csv", "n,a\n2,나\n")
    assert incremental_ingest(spark, land, SCHEMA, sink, ckpt, partition_by=["k"]) == 2
    put(f"{land}/k=y/3.csv", "extra,n\nz,3\n")
    assert incremental_ingest(spark, land, SCHEMA, sink, ckpt, partition_by=["k"]) == 1
    put(f"{land}/k=y/4.csv", "")
    put(f"{land}/k=y/5.csv", "n,a\n")
    assert incremental_ingest(spark, land, SCHEMA, sink, ckpt, partition_by=["k"]) == 0
    assert {tuple(r) for r in spark.read.parquet(sink).select("a", "n", "k").collect()} == {("가", 1, "x"), ("나", 2, "x"), (None, 3, "y")}
    assert [(r["rows"], len(r["files"])) for r in ledger(spark, sink).orderBy("batch").collect()] == [(2, 2), (1, 1), (0, 1)]  # empty files are not files to the stream


def test_stream_batch_that_runs_again(spark, tmp_dir):
    land, sink, ckpt = (f"{tmp_dir}/{n}" for n in ("land", "sink", "ckpt"))
    put(f"{land}/k=x/1.csv", "a,n\n가,1\n")
    calls = []

    def failing(rows):
        calls.append(1)
        if len(calls) == 1:
            # an attempt that has written, and dies before its record
            rows.write.mode("append").option("mapreduce.output.basename", "batch000000000").partitionBy("k").parquet(sink)
            raise OSError("lost")
        return rows

    with pytest.raises(Exception, match="lost"):
        incremental_ingest(spark, land, SCHEMA, sink, ckpt, partition_by=["k"], transform=failing)
    assert spark.read.parquet(sink).count() == 1
    assert incremental_ingest(spark, land, SCHEMA, sink, ckpt, partition_by=["k"], transform=failing) == 1
    assert spark.read.parquet(sink).count() == 1  # replaced, not added
    # the record is there but the checkpoint is not: skipped
    for name in ("0", ".0.crc"):
        os.rename(f"{ckpt}/commits/{name}", f"{tmp_dir}/lost{name}")
    assert incremental_ingest(spark, land, SCHEMA, sink, ckpt, partition_by=["k"]) == 0
    assert spark.read.parquet(sink).count() == 1
    assert sorted(os.listdir(f"{sink}/{LEDGER}"))[-2:] == ["000000000.done", "000000000.started"]


def test_best_loans_with_other_column_orders(spark, tmp_dir):
    from metroframe.plans import jobs as J

    head = "no,ranking,bookname,authors,publisher,isbn13,loan_count"
    put(f"{tmp_dir}/raw/district=강남구/year=2024/month=6/a.csv", head + "\n1,1,책,저자,출판사,9788936434120,12\n")
    put(f"{tmp_dir}/raw/district=중구/year=2024/month=7/a.csv",
        "no,ranking,bookname,publisher,authors,loan_count,isbn13,district,year,month\n1,1,책2,출판사2,저자2,5,9788936434121,틀림,1,1\n")
    assert J.best_loan_job(spark, f"{tmp_dir}/raw", f"{tmp_dir}/cur", f"{tmp_dir}/ckpt") == 2
    rows = spark.read.parquet(f"{tmp_dir}/cur").select("bll_book_name", "bll_authors", "bll_publisher", "bll_isbn13", "bll_loan_count",
                                                       "bll_district", "bll_month", "bll_vol").collect()
    assert {tuple(r) for r in rows} == {("책", "저자", "출판사", 9788936434120, 12, "강남구", 6, None),
                                        ("책2", "저자2", "출판사2", 9788936434121, 5, "중구", 7, None)}
