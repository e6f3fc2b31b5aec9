"""The reference platform's jobs as single calls: raw folders in, curated and
mart tables out.

Each transform job reads the latest ``request_date`` snapshot (SRC-4: one listing,
then its files), applies its plan, and publishes its output as a new version
(SNK-3, ``sinks.versions``: read it by ``read_published``); the loan job is
incremental (SRC-5 / STM-1); the L2 and mart jobs read curated tables (SRC-11)
and publish theirs. Paths are folders of any Hadoop-compatible store.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroframe import constants as K
from metroframe.operators.joins import left_join_spread_nulls
from metroframe.operators.projection import apply_mapping, positional_rename
from metroframe.operators.quality import ObservedQuality, store_results
from metroframe.plans import curated as C
from metroframe.plans.keywords import keyword_columns, top_keywords
from metroframe.plans.marts import entity_union, facility_union, integrated_accessibility
from metroframe.schemas import BEST_LOAN_RAW
from metroframe.sinks.files import write_csv
from metroframe.sinks.tables import bulk_load, create_empty_table
from metroframe.sinks.versions import current_path, publish, publish_table, read_published
from metroframe.sources.csv import read_csv_charset
from metroframe.sources.snapshot import read_latest_snapshot
from metroframe.streaming.ingest import incremental_ingest, reset_ingest

# P-1 -------------------------------------------------------------------------------
LOAN_PARTITIONS = ["bll_district", "bll_year", "bll_month"]


def best_loan_job(spark: SparkSession, raw_path: str, curated_path: str, checkpoint_path: str,
                  reset: bool = False) -> int:
    """New district/year/month files only (the checkpoint replaces the job
    bookmark); returns the number of rows ingested by this run. ``reset``
    ingests every file again."""
    if reset:
        reset_ingest(spark, curated_path, checkpoint_path)
    schema = T.StructType(BEST_LOAN_RAW.fields + [T.StructField(c, T.StringType()) for c in ("district", "year", "month")])
    return incremental_ingest(spark, raw_path, schema, curated_path, checkpoint_path,
                              partition_by=LOAN_PARTITIONS, transform=C.build_best_loans)


# P-2 -------------------------------------------------------------------------------
def bus_stop_job(spark: SparkSession, raw_path: str, curated_path: str) -> None:
    raw = read_latest_snapshot(spark, raw_path, "csv")
    publish(C.build_bus_stops(raw), curated_path, ["bus_district"])


# P-3 -------------------------------------------------------------------------------
def subway_station_job(spark: SparkSession, raw_path: str, district_info_path: str, curated_path: str,
                       encoding: str = "CP949") -> None:
    """The district file (CP949, Korean headers) is renamed by position."""
    master = read_latest_snapshot(spark, raw_path, "csv")
    info = positional_rename(read_csv_charset(spark, district_info_path, encoding), ["district", "stations", "n"])
    out = C.build_subway_stations(master, info, "district", "stations")
    publish(out, curated_path, ["sta_district", "sta_line"])


# P-4 -------------------------------------------------------------------------------
def city_park_job(spark: SparkSession, raw_path: str, curated_path: str) -> None:
    raw = read_latest_snapshot(spark, raw_path, "csv")
    publish(C.build_parks(raw), curated_path, ["park_district"])


# P-5 -------------------------------------------------------------------------------
def event_keyword_job(spark: SparkSession, parse_path: str, pages: DataFrame, info_path: str, *,
                      url_col: str = "url", html_col: str = "html", pattern: str = K.HANGUL_WORD) -> None:
    """Latest event snapshot + the home pages (a table of url, html) -> the
    three top keywords per event, written as CSV by request_date/district.

    Only pages that an event names in HMPG_ADDR are read into words, one page per
    address (the least html); events without a page, or with a null address, keep
    null keywords.
    """
    events = read_latest_snapshot(spark, parse_path, "csv")
    asked = events.select(F.col("HMPG_ADDR").alias(url_col)).where("HMPG_ADDR is not null").distinct()
    own = pages.select(url_col, html_col).join(asked, url_col, "left_semi") \
        .groupBy(url_col).agg(F.min(html_col).alias(html_col))
    page_kw = keyword_columns(top_keywords(own, url_col, html_col, pattern=pattern), url_col)
    out = left_join_spread_nulls(events, page_kw, ["HMPG_ADDR"], [url_col]).drop(url_col)
    write_csv(out, info_path, ["request_date", "district"])


# P-6 -------------------------------------------------------------------------------
def event_info_job(spark: SparkSession, info_path: str, curated_path: str) -> None:
    raw = read_latest_snapshot(spark, info_path, "csv")
    publish(C.build_event_info(raw), curated_path, ["cul_district"])


# P-7 -------------------------------------------------------------------------------
def library_job(spark: SparkSession, raw_path: str, curated_path: str, results_path: str | None = None,
                rules=C.LIBRARY_RULES) -> DataFrame:
    """Publishes the mapped rows as the curated table (the reference purged
    the prefix, then let its writer add files); returns the data-quality
    results (one row per rule), which never block the write and are measured by it:
    the raw files are read once. With ``results_path`` they are appended there."""
    raw = read_latest_snapshot(spark, raw_path, "csv")
    quality = ObservedQuality(apply_mapping(raw, C.LIBRARY_MAPPING), rules)
    number = publish(quality.data, curated_path, ["lib_district"])
    results = quality.results(read_published(spark, curated_path, number))
    if results_path:
        store_results(results, results_path, "library", f"{curated_path}@{number}")
    return results


# P-8, P-9, P-10 ----------------------------------------------------------------------
def _out(df: DataFrame, path: str, table: str | None) -> int:
    return publish_table(df, table, path) if table else publish(df, path)


def entity_union_job(spark: SparkSession, library_path: str, event_path: str, loan_path: str, out_path: str,
                     table: str | None = None) -> int:
    """P-8; with ``table`` the catalog table of that name is pointed at the new version. Returns the version."""
    lib, cul, bll = (read_published(spark, p) for p in (library_path, event_path, loan_path))
    return _out(entity_union(lib, cul, bll), out_path, table)


def facility_locations_job(spark: SparkSession, bus_path: str, subway_path: str, park_path: str,
                           out_path: str, table: str | None = None) -> int:
    bus, sta, park = (read_published(spark, p) for p in (bus_path, subway_path, park_path))
    return _out(facility_union(bus, sta, park), out_path, table)


def accessibility_job(spark: SparkSession, entity_path: str, facility_path: str, out_path: str, *,
                      radius_m: float = K.RADIUS_M, parts: int | None = None, table: str | None = None) -> int:
    out = integrated_accessibility(read_published(spark, entity_path), read_published(spark, facility_path),
                                   radius_m=radius_m, parts=parts)
    return _out(out, out_path, table)


def load_table_job(spark: SparkSession, table: str, schema: T.StructType, published_path: str, table_path: str,
                   rejects_path: str | None = None, max_rejects: int = 0) -> tuple[int, int]:
    """A typed table built anew and loaded by position from the current version of a published one (SNK-7);
    returns the numbers of rows loaded and rejected."""
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    create_empty_table(spark, table, schema, f"{table_path}/{uuid.uuid4().hex}")
    return bulk_load(spark, table, current_path(spark, published_path), rejects_path=rejects_path, max_rejects=max_rejects)
