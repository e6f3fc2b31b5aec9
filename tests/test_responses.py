"""SRC-7, SET-3: one pass over responses, and what is missing from a feed."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroframe.sources import xml as X

ROW = T.StructType([T.StructField(n, T.StringType()) for n in ("A", "B")])


def responses(spark, bodies):
    return spark.createDataFrame([(f"/x/{name}.xml", body) for name, body in bodies.items()], "file string, body string")


def test_pages_are_parsed_once_into_status_and_records(spark):
    pages = X.parse_pages(responses(spark, {
        "page=1": "<f><list_total_count>5</list_total_count><RESULT><CODE> INFO-000 </CODE><MESSAGE>ok</MESSAGE></RESULT>"
                  "<row id='7'><A> x &amp; y </A><B></B><C>extra</C></row><row><A>z</A></row></f>",
        "page=2": "<f><RESULT><CODE>INFO-000</CODE></RESULT><row><B>one record</B></row></f>",
        "page=3": "<f><RESULT><CODE>ERROR-300</CODE><MESSAGE>key</MESSAGE></RESULT><row><A>no</A></row></f>",
        "page=5": "<f><CODE>INFO-000</CODE></f>", "page=6": "<f><RESULT><CODE>INFO-000</CODE></RESULT><row><A>cut",
        "page=7": "<f><row><A>no code</A></row></f>", "page=8": "", "page=9": "<f><CODE>INFO-200</CODE><MESSAGE>end</MESSAGE></f>"}), ROW)
    got = {r["page"]: r for r in pages.collect()}
    assert (got[1]["code"], got[1]["message"], got[1]["total"], len(got[1]["records"])) == ("INFO-000", "ok", 5, 2)
    rows = X.page_rows(pages, keep=["page"])
    assert sorted((r["page"], r["A"], r["B"]) for r in rows.collect()) == [(1, "x & y", ""), (1, "z", None), (2, None, "one record")]
    rejects = {(r["page"], r["code"], r["message"]) for r in X.page_rejects(pages, first_page=0).collect()}
    assert rejects == {(3, "ERROR-300", "key"), (6, X.MALFORMED, None), (7, X.NO_CODE, None), (8, X.MALFORMED, None),
                       (4, X.MISSING, None), (0, X.MISSING, None), (None, X.SHORT, "3 of 5")}


def test_feeds_are_told_apart_and_records_may_lie_deeper(spark):
    body = "<response><docs><doc><A>{}</A></doc><doc><A>second</A></doc></docs></response>"
    pages = X.parse_pages(responses(spark, {f"feed={f}/page={p}": body.format(f) for f, p in (("a", 1), ("a", 2), ("b", 1), ("b", 4))}),
                          ROW, ("docs", "doc"), feed=F.regexp_extract("file", "feed=([a-z])", 1))
    pages = pages.withColumn("code", F.lit("INFO-000"))
    assert X.page_rows(pages).count() == 8
    assert {(r["feed"], r["page"], r["code"]) for r in X.page_rejects(pages).collect()} == {("b", 2, X.MISSING), ("b", 3, X.MISSING)}


def test_no_responses(spark):
    pages = X.parse_pages(spark.createDataFrame([], "file string, body string"), ROW)
    assert X.page_rows(pages).count() == 0 and X.page_rejects(pages).count() == 0


def test_each_file_is_read_once(spark, tmp_dir):
    for k in range(3):
        with open(f"{tmp_dir}/page={k}.xml", "w") as f:
            f.write(f"<f><RESULT><CODE>INFO-000</CODE></RESULT><row><A>{k}</A></row></f>")
    rows, _ = X.read_xml_gated(spark, tmp_dir, "row", ROW)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and plan.lower().count("join") == 0
    assert sorted(r["A"] for r in rows.collect()) == ["0", "1", "2"]
