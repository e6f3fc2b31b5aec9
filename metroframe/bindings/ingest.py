"""The ingest chain on responses made from the driver's tables (JN-5, SRC-7, STR-3, JN-3, SNK-4, STM-1, P-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from metroframe import constants as K
from metroframe.bindings import query
from metroframe.bindings import tables as tb
from metroframe.bindings.curated import DISTRICTS, DISTRICTS_SQL, raw_events, raw_loans
from metroframe.plans.ingest import ingest_best_loans, ingest_events
from metroframe.schemas import BEST_LOAN_RESPONSE, EVENT_PARSE_RAW
from metroframe.session import scratch_path


def _element(name: str, value):
    text = F.replace(F.replace(F.replace(value, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    return F.coalesce(F.concat(F.lit(f"<{name}>"), text, F.lit(f"</{name}>")), F.lit(""))


def _record(tag: str, names):
    return F.concat(F.lit(f"<{tag}>"), *[_element(n, F.col(n)) for n in names], F.lit(f"</{tag}>")).alias("xml")


BROKEN = (DISTRICTS[0], "12")  # the response of this district and month is an error


@query("ingest_best_loans", f"""
SELECT p_name AS bll_book_name, p_brand AS bll_authors, CAST(p_size + 1970 AS INTEGER) AS bll_publication_year,
       p_partkey + 9788900000000 AS bll_isbn13, p_type AS bll_class_major, p_brand AS bll_class_sub,
       CASE WHEN p_size > 25 THEN p_name END AS bll_class_detailed, CAST(p_size AS BIGINT) AS bll_loan_count,
       dk.district_ko AS bll_district, 2024 AS bll_year, CAST(p_partkey % 12 + 1 AS INTEGER) AS bll_month
FROM part JOIN {DISTRICTS_SQL} ON dk.k = p_partkey % {tb.NATIONS}
WHERE NOT (dk.district_ko = '{BROKEN[0]}' AND p_partkey % 12 + 1 = {BROKEN[1]})""")
def q_ingest_best_loans(spark, d):
    """JN-5 to P-1: loans as a response per district and month. The first half of the year is asked for, then all
    of it; a third run finds one open request, whose response is an error, and adds nothing."""
    loans = raw_loans(spark, d).withColumn("class_nm", F.concat_ws(" > ", "class_major", "class_sub", "class_detailed"))
    rows = loans.select("district", "year", "month", _record("doc", BEST_LOAN_RESPONSE.fieldNames()))
    responses, raw, ledger, curated, ckpt = (scratch_path(spark, n) for n in ("loan_responses", "loan_raw", "loan_ledger", "loan_table", "loan_ckpt"))
    files = rows.groupBy("district", "year", "month").agg(F.collect_list("xml").alias("xmls")).select(
        "district", "year", "month", F.when((F.col("district") == BROKEN[0]) & (F.col("month") == BROKEN[1]),
                                            F.lit("<response><error>limit reached</error></response>")).otherwise(
            F.concat(F.lit("<response><request/><docs>"), F.array_join("xmls", ""), F.lit("</docs></response>"))).alias("value"))
    files.repartition("district", "year", "month").write.partitionBy("district", "year", "month").text(responses)
    for end, adds in (("202406", True), ("202412", True), ("202412", False)):
        landed, taken = ingest_best_loans(spark, responses, raw, ledger, curated, ckpt, "202401", end)
        if landed.rows != taken or (taken > 0) != adds:
            raise AssertionError(f"to {end}: {landed.rows} rows landed, {taken} taken")
    return spark.read.parquet(curated).select(
        "bll_book_name", "bll_authors", "bll_publication_year", "bll_isbn13", "bll_class_major", "bll_class_sub", "bll_class_detailed",
        "bll_loan_count", "bll_district", "bll_year", "bll_month")


PAGE = 100
QUIET = "과천시"  # a district that no event names


@query("ingest_events", f"""
SELECT c_name AS "TITLE", strftime(DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER), '%Y-%m-%d') AS "STRTDATE",
       CASE WHEN c_acctbal >= 0 THEN strftime(DATE '2024-01-01' + CAST(c_custkey % 365 AS INTEGER) + 30, '%Y-%m-%d') END AS "END_DATE",
       dk.district_ko AS district, '240612' AS request_date FROM customer JOIN {DISTRICTS_SQL} ON dk.k = c_nationkey""")
def q_ingest_events(spark, d):
    """SRC-7 to SNK-4: two feeds of event pages; the older one lands first, the newer one when its missing page has
    come, a third feed breaks off and stays out. The latest snapshot's rows come back, routed by district."""
    rows = raw_events(spark, d).select(
        F.floor(F.regexp_extract("HMPG_ADDR", "([0-9]+)$", 1).cast("long") / PAGE).alias("page"), _record("row", EVENT_PARSE_RAW.fieldNames()))
    head, tail = f"<f><RESULT><CODE>{K.STATUS_OK}</CODE></RESULT>", "</f>"
    pages = rows.groupBy("page").agg(F.array_join(F.collect_list("xml"), "").alias("xml")).select(
        "page", F.concat(F.lit(head), "xml", F.lit(tail)).alias("value"))
    end = pages.agg((F.max("page") + 1).alias("page")).withColumn("value", F.lit(f"<f><CODE>{K.STATUS_NO_DATA}</CODE></f>"))
    feed = pages.unionByName(end)
    responses, raw, ledger = (scratch_path(spark, n) for n in ("event_responses", "event_raw", "event_ledger"))

    def put(date, part):
        part.withColumn("request_date", F.lit(date)).repartition("page").write.mode("append").partitionBy("request_date", "page").text(responses)

    def run():
        return ingest_events(spark, responses, raw, ledger, [*DISTRICTS, QUIET])

    put("240105", feed.where("page <= 1").unionByName(end.withColumn("page", F.lit(2).cast("long"))))
    put("240612", feed.where("page <> 1"))
    put("240701", pages)
    first, _ = run()
    put("240612", feed.where("page = 1"))
    second, latest = run()
    third, _ = run()
    if (first.requests, second.requests, third.requests) != (1, 1, 0):
        raise AssertionError(f"dates landed: {first.requests}, {second.requests}, {third.requests}")
    return latest.select("TITLE", "STRTDATE", "END_DATE", "district", "request_date")
