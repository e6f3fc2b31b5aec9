"""The ingest chain: what is wanted, what has been committed, and landed responses to raw CSV.

Fetching is not part of it: responses are files that a client left in folders named by the request.
The chain says which requests are open (the calendar grid without what the ledger holds, JN-5), turns the
responses of open requests into raw CSV (SRC-7, STR-3, JN-3, SNK-4), and commits them to the ledger. A request is
committed with all of its rows or not at all: one error page, or one that is missing, leaves it open and
listed. Raw folders are replaced and the ledger is written after them, so a run that dies in between is
repeated by the next one; a run with nothing new adds nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroframe import constants as K
from metroframe.functions.dates import parse_date
from metroframe.functions.text import split_part
from metroframe.operators.joins import contains_join, month_grid
from metroframe.plans.jobs import best_loan_job
from metroframe.schemas import BEST_LOAN_RAW, BEST_LOAN_RESPONSE, EVENT_PARSE_RAW
from metroframe.session import scratch_path
from metroframe.sinks.files import write_csv
from metroframe.sources.headers import hadoop_path, has_files, list_files
from metroframe.sources.manifest import child_values
from metroframe.sources.xml import page_rejects, page_rows, parse_pages, read_responses

LOAN_KEYS = ["district", "year", "month"]
LOAN_LEDGER = "district string, year int, month int, records long"
EVENT_LEDGER = "request_date string, records long"


@dataclass(frozen=True)
class Landed:
    """What a run committed, and what it found wrong with the responses of requests that stay open."""

    requests: int
    rows: int
    rejects: DataFrame


def read_ledger(spark: SparkSession, path: str, schema: str) -> DataFrame:
    fs, folder = hadoop_path(spark, path)
    return spark.read.schema(schema).parquet(path) if fs.exists(folder) else spark.createDataFrame([], schema)


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# popular loans: a response per district and month -------------------------------------------------------
def open_loan_requests(spark: SparkSession, start_month: str, end_month: str, ledger_path: str,
                       districts: Sequence[str] | None = None) -> DataFrame:
    """JN-5: the requests that the ledger does not hold: district, its code, year, month, first and last day, folder.

    Months are 'yyyyMM'. The grid has a row per month and district, whatever the size of the data.
    """
    codes = [(d, c) for d, c in K.LOAN_DISTRICT_CODES if districts is None or d in districts]
    unknown = set(districts or ()) - {d for d, _ in codes}
    if unknown:
        raise ValueError(f"no code for {sorted(unknown)}")
    grid = month_grid(F.to_date(F.lit(start_month), "yyyyMM"), F.to_date(F.lit(end_month), "yyyyMM"),
                      spark.createDataFrame(codes, "district string, dtl_region int"))
    wanted = grid.select("district", "dtl_region", F.year("month_start").alias("year"), F.month("month_start").alias("month"),
                         F.date_format("month_start", "yyyy-MM-dd").alias("start_dt"), F.date_format("month_end", "yyyy-MM-dd").alias("end_dt"),
                         F.lit(K.LOAN_REGION).alias("region"), F.lit(K.LOAN_PAGE_SIZE).alias("page_size"))
    folder = F.format_string("district=%s/year=%d/month=%d", "district", "year", "month")
    return wanted.join(read_ledger(spark, ledger_path, LOAN_LEDGER), LOAN_KEYS, "left_anti").withColumn("folder", folder)


def _no_rejects(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], "feed string, page long, file string, code string, message string")


def land_loans(spark: SparkSession, responses_path: str, raw_path: str, ledger_path: str, start_month: str, end_month: str,
               districts: Sequence[str] | None = None) -> Landed:
    """Responses of open requests to raw CSV by district/year/month, then the ledger.

    Only the folders of open requests are listed and read, each file once. A response without loans is committed with none.
    """
    asked = open_loan_requests(spark, start_month, end_month, ledger_path, districts)
    # the grid is months times districts: its folders are looked up one by one
    files = [f.path for r in asked.select("folder").collect() for f in list_files(spark, f"{responses_path}/{r['folder']}")]
    if not files:
        return Landed(0, 0, _no_rejects(spark))
    feed = F.regexp_extract("file", r"(district=[^/]+/year=[0-9]+/month=[0-9]+)/", 1)
    pages = _written(parse_pages(read_responses(spark, files), BEST_LOAN_RESPONSE, ("docs", "doc"), feed=feed, error_tag="error",
                                 default_code=K.STATUS_OK), "loan_pages")
    rejects = _written(page_rejects(pages), "loan_rejects")
    key = [F.regexp_extract("feed", "district=([^/]+)", 1).alias("district"), F.regexp_extract("feed", "year=([0-9]+)", 1).cast("int").alias("year"),
           F.regexp_extract("feed", "month=([0-9]+)", 1).cast("int").alias("month")]
    good = pages.join(rejects.select("feed"), "feed", "left_anti")
    rows = page_rows(good, keep=["feed"])
    for k, name in enumerate(("class_major", "class_sub", "class_detailed")):
        rows = rows.withColumn(name, split_part("class_nm", K.CATEGORY_SEPARATOR, k))
    write_csv(rows.select(*BEST_LOAN_RAW.fieldNames(), *key), raw_path, LOAN_KEYS, dynamic=True)
    done = _written(good.groupBy("feed").agg(F.sum(F.size("records")).cast("long").alias("records")).select(*key, "records"), "loan_done")
    done.coalesce(1).write.mode("append").parquet(ledger_path)
    n, total = done.agg(F.count("*"), F.sum("records")).first()
    return Landed(n, total or 0, rejects)


def ingest_best_loans(spark: SparkSession, responses_path: str, raw_path: str, ledger_path: str, curated_path: str, checkpoint_path: str,
                      start_month: str, end_month: str, districts: Sequence[str] | None = None) -> tuple[Landed, int]:
    """Open requests to P-1's table: land what has come, then ingest the new raw files. Returns what landed, and the rows P-1 took.

    P-1 takes each raw file once; raw folders are final once the ledger has their request, and P-1 runs after that.
    """
    landed = land_loans(spark, responses_path, raw_path, ledger_path, start_month, end_month, districts)
    return landed, best_loan_job(spark, raw_path, curated_path, checkpoint_path) if list_files(spark, raw_path) else 0


# cultural events: pages of all events per request date ---------------------------------------------------
def land_events(spark: SparkSession, responses_path: str, raw_path: str, ledger_path: str, districts: Sequence[str]) -> Landed:
    """Pages below ``request_date=.../`` of dates that the ledger does not hold to raw CSV by request_date/district.

    A date lands when its feed is whole: every page up to the one that ends it, none an error, as many
    records as announced. An event goes to each district that its GUNAME contains (JN-3); a district without events
    gets a file with a header alone, so that it shows in the snapshot. Dates that stay open are listed in the rejects, one that
    has no end page as ``NO-END``.
    """
    known = {r["request_date"] for r in read_ledger(spark, ledger_path, EVENT_LEDGER).collect()}  # a row per date
    new = {d: p for d, p in child_values(spark, responses_path, "request_date").items() if d not in known}
    folders = [p for p in new.values() if has_files(spark, p)]
    if not folders:
        return Landed(0, 0, _no_rejects(spark))
    feed = F.regexp_extract("file", "request_date=([^/]+)/", 1)
    # Spark lists the dates' folders, in tasks where they are many; names that begin with _ are left out as elsewhere
    found = read_responses(spark, folders).where(~F.col("file").rlike("request_date=[^/]+/(?:[^/]+/)*_"))
    pages = _written(parse_pages(found, EVENT_PARSE_RAW, feed=feed), "event_pages")
    ends = pages.where(F.col("code") == K.STATUS_NO_DATA).select("feed").distinct()
    endless = pages.select("feed").distinct().join(ends, "feed", "left_anti").select(
        "feed", F.lit(None).cast("long").alias("page"), F.lit(None).cast("string").alias("file"), F.lit("NO-END").alias("code"),
        F.lit(None).cast("string").alias("message"))
    rejects = _written(page_rejects(pages).unionByName(endless), "event_rejects")
    good = pages.join(rejects.select("feed"), "feed", "left_anti")
    rows = page_rows(good, keep=["feed"]).withColumnRenamed("feed", "request_date")
    for c in ("STRTDATE", "END_DATE"):
        rows = rows.withColumn(c, F.date_format(parse_date(c), "yyyy-MM-dd"))
    names = spark.createDataFrame([(d,) for d in districts], "district string")
    routed = _written(contains_join(rows, "GUNAME", names, "district"), "event_routed")
    columns = [*EVENT_PARSE_RAW.fieldNames(), "request_date", "district"]
    write_csv(routed.select(*columns), raw_path, ["request_date", "district"], dynamic=True)
    done = _written(good.groupBy("feed").agg(F.sum(F.when(F.col("code") == K.STATUS_OK, F.size("records")).otherwise(0)).cast("long").alias("records"))
                    .select(F.col("feed").alias("request_date"), "records"), "event_done")
    wanted = done.select("request_date", F.explode(F.array(*[F.lit(d) for d in districts])).alias("district"))
    empty = wanted.join(routed.select("request_date", "district"), ["request_date", "district"], "left_anti")
    for r in empty.collect():  # dates of this run times districts at most
        fs, path = hadoop_path(spark, f"{raw_path}/request_date={r['request_date']}/district={r['district']}/empty.csv")
        out = fs.create(path, True)
        out.write(bytearray((",".join(EVENT_PARSE_RAW.fieldNames()) + "\n").encode()))
        out.close()
    done.coalesce(1).write.mode("append").parquet(ledger_path)
    n, total = done.agg(F.count("*"), F.sum("records")).first()
    return Landed(n, total or 0, rejects)


def ingest_events(spark: SparkSession, responses_path: str, raw_path: str, ledger_path: str, districts: Sequence[str]) -> tuple[Landed, DataFrame]:
    """Land new event feeds; returns what landed and the raw rows of the latest snapshot, as P-5 and P-6 read them."""
    from metroframe.sources.snapshot import read_latest_snapshot

    landed = land_events(spark, responses_path, raw_path, ledger_path, districts)
    if not child_values(spark, raw_path, "request_date"):
        schema = T.StructType([*EVENT_PARSE_RAW.fields, T.StructField("request_date", T.StringType()), T.StructField("district", T.StringType())])
        return landed, spark.createDataFrame([], schema)
    return landed, read_latest_snapshot(spark, raw_path, "csv")
