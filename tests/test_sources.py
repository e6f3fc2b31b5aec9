"""Sources and sinks: CSV quoting, charset, snapshots, XML, catalog repair."""

import os

import pytest
from pyspark.sql import functions as F

from metroframe.sinks import files as SK
from metroframe.sources import csv as CSV
from metroframe.sources import snapshot as SNAP
from metroframe.sources import xml as XML
from metroframe.sources.catalog import create_external_table, repair_table


def test_multiline_csv_keeps_quoted_breaks(spark, tmp_dir):
    path = os.path.join(tmp_dir, "ev.csv")
    with open(path, "w", encoding="utf-8-sig") as f:  # BOM, as the ingest wrote it
        f.write('TITLE,ETC_DESC\n"공연","설명, ""따옴표""\n둘째 줄"\n"전시",\n')
    df = CSV.read_csv(spark, path)
    got = sorted((r["TITLE"], r["ETC_DESC"]) for r in df.collect())
    assert got == [("공연", '설명, "따옴표"\n둘째 줄'), ("전시", None)]
    assert df.columns == ["TITLE", "ETC_DESC"]  # the BOM is not part of the first name
    # without multiLine the two records read as three
    assert CSV.read_csv(spark, path, multiline=False).count() == 3


def test_cp949_round_trip(spark, tmp_dir):
    df = spark.createDataFrame([("강남구", "역삼(2), 강남(2)", 2)], "district string, stations string, n int")
    path = os.path.join(tmp_dir, "cp949")
    SK.write_csv_charset(df, path, "CP949")
    raw = b"".join(open(os.path.join(path, f), "rb").read() for f in os.listdir(path) if f.endswith(".csv"))
    assert "강남구".encode("cp949") in raw
    back = CSV.read_csv_charset(spark, path, "CP949", "district string, stations string, n int")
    assert [tuple(r) for r in back.collect()] == [("강남구", "역삼(2), 강남(2)", 2)]
    assert spark.conf.get("spark.sql.legacy.javaCharsets", "false") in ("false", None)
    # decoded once: later actions do not need the legacy setting
    assert back.count() == 1
    with CSV.legacy_charsets(spark):  # a session that allows the charset reads the files themselves
        lazy = CSV.read_csv_charset(spark, path, "CP949", "district string, stations string, n int")
        assert lazy.inputFiles() and [tuple(r) for r in lazy.collect()] == [tuple(r) for r in back.collect()]


def test_latest_snapshot_reads_only_the_newest(spark, tmp_dir):
    base = os.path.join(tmp_dir, "snap")
    for d, name in (("240105", "old"), ("240612", "new"), ("091231", "older")):
        os.makedirs(f"{base}/request_date={d}")
        with open(f"{base}/request_date={d}/x.csv", "w") as f:
            f.write(f"name\n{name}\n")
    df = SNAP.read_latest_snapshot(spark, base, "csv", spark.createDataFrame([], "name string").schema)
    assert [tuple(r) for r in df.collect()] == [("new", "240612")]
    assert "PartitionFilters: [isnotnull(request_date" in df._jdf.queryExecution().executedPlan().toString() or \
        "request_date" in df._jdf.queryExecution().executedPlan().toString()


def test_xml_records_and_status_gate(spark, tmp_dir):
    pages = {
        "p1.xml": "<r><RESULT><CODE>INFO-000</CODE></RESULT><row><A> x &amp; y </A><B></B></row><row><A>z</A></row></r>",
        "p2.xml": "<r><RESULT><CODE>ERROR-500</CODE><MESSAGE>bad key</MESSAGE></RESULT><row><A>no</A></row></r>",
        "p3.xml": "<r><CODE>INFO-200</CODE><MESSAGE>none</MESSAGE></r>",
    }
    for n, body in pages.items():
        with open(os.path.join(tmp_dir, n), "w") as f:
            f.write(body)
    schema = spark.createDataFrame([], "A string, B string").schema
    all_rows = XML.read_xml_records(spark, tmp_dir, "row", schema)
    assert sorted((r["A"], r["B"]) for r in all_rows.collect()) == [("no", None), ("x & y", ""), ("z", None)]
    kept, rejects = XML.read_xml_gated(spark, tmp_dir, "row", schema)
    assert sorted(r["A"] for r in kept.collect()) == ["x & y", "z"]
    assert [r["code"] for r in rejects.collect()] == ["ERROR-500"]


def test_external_table_needs_repair(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k long, part string")
    path = os.path.join(tmp_dir, "t")
    SK.write_parquet(df, path, ["part"])
    create_external_table(spark, "t_repair_test", path, df.schema, partition_cols=["part"])
    assert spark.table("t_repair_test").count() == 0
    repair_table(spark, "t_repair_test")
    assert spark.table("t_repair_test").count() == 2
    spark.sql("DROP TABLE t_repair_test")


def test_partition_copy_keeps_other_partitions(spark, tmp_dir):
    src, dst = os.path.join(tmp_dir, "src"), os.path.join(tmp_dir, "dst")
    SK.write_parquet(spark.createDataFrame([(1, "A", 2024, 1), (2, "B", 2024, 2)], "k long, d string, y int, m int"),
                     src, ["d", "y", "m"])
    SK.write_parquet(spark.createDataFrame([(9, "A", 2024, 1), (8, "C", 2023, 12)], "k long, d string, y int, m int"),
                     dst, ["d", "y", "m"])
    SK.copy_partitions(spark, src, dst, (F.col("d") == "A") & (F.col("y") == 2024) & (F.col("m") == 1), ["d", "y", "m"])
    got = sorted(tuple(r) for r in spark.read.parquet(dst).select("k", "d").collect())
    assert got == [(1, "A"), (8, "C")]


def test_contains_join_equals_nested_loop(spark):
    from metroframe.operators.joins import contains_join

    texts = spark.createDataFrame([(1, "cold anvil"), (2, "red widget"), (3, "hot rod"), (4, None), (5, "aa"),
                                   (6, "red red"), (6, "red red")], "id int, s string")
    terms = spark.createDataFrame([("old",), ("red",), ("d",), ("anvil",), ("",), (None,), ("a",), ("aa",), ("zz",)],
                                  "t string")
    small = texts.join(terms.where("t <> ''"), texts.s.contains(terms.t))
    large = contains_join(texts, "s", terms, "t")
    got = sorted(tuple(r) for r in large.select("id", "t").collect())
    assert got == sorted(tuple(r) for r in small.select("id", "t").collect())
    assert (1, "old") in got and (1, "d") in got and (3, "d") in got and (5, "a") in got and (5, "aa") in got
    assert got.count((6, "red")) == 2  # identical rows both kept, each matched once
    assert got.count((6, "d")) == 2 and len(got) - 2 == len(set(got))


def test_partition_column_in_path_wins_over_file_column(spark, tmp_dir):
    base = os.path.join(tmp_dir, "lib")
    os.makedirs(f"{base}/request_date=240601/district=강남구")
    with open(f"{base}/request_date=240601/district=강남구/a.csv", "w", encoding="utf-8") as f:
        f.write("libName,district\n도서관,종로구\n")
    df = SNAP.read_latest_snapshot(spark, base, "csv")
    r = df.first()
    assert (r["libName"], r["district"], r["request_date"]) == ("도서관", "강남구", "240601")
    assert dict(df.dtypes)["request_date"] == "string"  # '240601' stays text


def _csv(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_latest_snapshot_ignores_other_headers(spark, tmp_dir):
    base = os.path.join(tmp_dir, "stops")
    _csv(f"{base}/request_date=240101/a.csv", "NAME,ID,LAT\nold,1,37.0\n")
    _csv(f"{base}/request_date=240201/a.csv", "ID,NAME,LAT\n122000001,new,37.5\n")
    r = SNAP.read_latest_snapshot(spark, base, "csv").first()
    assert (r["ID"], r["NAME"], r["LAT"], r["request_date"]) == ("122000001", "new", "37.5", "240201")


def test_csv_with_another_header_order_fails_instead_of_swapping(spark, tmp_dir):
    import pytest

    from metroframe.sources.csv import read_csv

    _csv(os.path.join(tmp_dir, "x", "a.csv"), "b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, os.path.join(tmp_dir, "x"), "a string, b string").collect()


def test_csv_keeps_padding(spark, tmp_dir):
    from metroframe.sinks.files import write_csv
    from metroframe.sources.csv import read_csv

    path = os.path.join(tmp_dir, "pad")
    write_csv(spark.createDataFrame([("  padded  ",)], "s string"), path)
    assert read_csv(spark, path).first()["s"] == "  padded  "


def test_failed_refresh_keeps_old_rows(spark, tmp_dir):
    import pytest
    from pyspark.sql import functions as F

    from metroframe.sinks.files import write_parquet

    path = os.path.join(tmp_dir, "table")
    write_parquet(spark.range(3), path)
    with pytest.raises(Exception):
        write_parquet(spark.range(3).select(F.raise_error(F.lit("no")).cast("bigint").alias("id")), path)
    assert spark.read.parquet(path).count() == 3
    write_parquet(spark.range(5), path)
    assert spark.read.parquet(path).count() == 5


def test_xml_gate_with_blanks_in_the_path(spark, tmp_dir):
    from metroframe.sources.xml import read_xml_gated

    _csv(f"{tmp_dir}/with blank/강남/a.xml", "<r><RESULT><CODE>INFO-000</CODE></RESULT><row><A>1</A></row></r>")
    _csv(f"{tmp_dir}/with blank/b.xml", "<r><CODE>ERROR-500</CODE></r>")
    rows, rejects = read_xml_gated(spark, tmp_dir, "row", spark.createDataFrame([], "A string").schema)
    assert [r["A"] for r in rows.collect()] == ["1"] and [r["code"] for r in rejects.collect()] == ["ERROR-500"]


def test_numeric_entities(spark):
    from metroframe.functions.text import html_to_text

    df = spark.createDataFrame([("&#49436;&#xC11C;점&amp;&#0;&#x1F600;.",), ("plain",), (None,)], "h string")
    assert [r[0] for r in df.select(html_to_text("h")).collect()] == ["서서점&\ufffd\U0001f600.", "plain", None]
