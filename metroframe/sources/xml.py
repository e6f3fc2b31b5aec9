"""SRC-6, SRC-7, SET-3: XML responses to rows, gated by their status code, in one pass over the files.

A response file is one page of an API: a status (RESULT/CODE, or CODE on its own) and records, at most a page size of
them. It is read as one row and parsed once into status, announced total and an array of records; rows, rejects and
the check for missing pages all come from that table of pages.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroframe import constants as K

PAGE_IN_PATH = r"page[=_-]?([0-9]+)"
# what a page can be rejected for, beside the code it gives itself
MALFORMED, NO_CODE, ERROR, MISSING, SHORT = "MALFORMED", "NO-CODE", "ERROR", "MISSING-PAGE", "SHORT-FEED"


def read_xml_records(spark: SparkSession, path: str, row_tag: str, schema: T.StructType) -> DataFrame:
    """SRC-6: each ``row_tag`` element is a row, child tag = column.

    Values are trimmed, entities decoded, an empty element is '' and a missing
    one null. Every file of the folder is read (SET-3: pages united by name).
    """
    return (spark.read.format("xml").option("rowTag", row_tag).option("ignoreSurroundingSpaces", True)
            .option("recursiveFileLookup", True).schema(schema).load(path))


def read_responses(spark: SparkSession, path: str | Sequence[str], charset: str = "UTF-8") -> DataFrame:
    """(file, body): each response file as one row. A page holds at most a page size of records, so rows stay small."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path if isinstance(path, str) else list(path))
            .select(F.col("path").alias("file"), F.decode("content", charset).alias("body")))


def _nested(tags: Sequence[str], leaf: T.DataType) -> T.StructField:
    head, *rest = tags
    return T.StructField(head, T.StructType([_nested(rest, leaf)]) if rest else leaf)


def parse_pages(responses: DataFrame, records: T.StructType, record_path: Sequence[str] = ("row",), *, page: Column | None = None,
                feed: Column | None = None, total_tag: str = "list_total_count", error_tag: str | None = None,
                default_code: str | None = None) -> DataFrame:
    """SRC-7: ``responses`` (file, body) with feed, page, code, message, total, malformed and records (an array of structs).

    ``record_path`` leads from the root element to the records. ``page`` is the number of the page within its ``feed`` (by
    default from the file's path, all files one feed). Where both RESULT/CODE and CODE are there, the first counts. An
    API without codes has an ``error_tag``, which makes a page an error, and a ``default_code`` for other pages.
    """
    status = [T.StructField("CODE", T.StringType()), T.StructField("MESSAGE", T.StringType())]
    schema = T.StructType([T.StructField("RESULT", T.StructType(status)), *status, T.StructField(total_tag, T.LongType()),
                           _nested(record_path, T.ArrayType(records)), *([T.StructField(error_tag, T.StringType())] if error_tag else []),
                           T.StructField("_corrupt_record", T.StringType())])
    parsed = responses.select("*", F.from_xml("body", schema.json(), {"ignoreSurroundingSpaces": "true"}).alias("x"))
    given = lambda name: F.coalesce(*[F.nullif(F.trim(F.col(c)), F.lit("")) for c in (f"x.RESULT.{name}", f"x.{name}")])
    code, message = given("CODE"), given("MESSAGE")
    if error_tag:
        failed = F.col(f"x.{error_tag}").isNotNull()
        code, message = F.when(failed, ERROR).otherwise(code), F.when(failed, F.col(f"x.{error_tag}")).otherwise(message)
    number = F.nullif(F.regexp_extract("file", PAGE_IN_PATH, 1), F.lit("")).cast("long") if page is None else page.cast("long")
    return parsed.select(
        "file", (F.lit("") if feed is None else feed).alias("feed"), number.alias("page"), F.coalesce(code, F.lit(default_code)).alias("code"),
        message.alias("message"), F.col(f"x.{total_tag}").alias("total"),
        (F.col("x").isNull() | F.col("x._corrupt_record").isNotNull()).alias("malformed"),
        F.coalesce(F.col("x." + ".".join(record_path)), F.array()).cast(T.ArrayType(records)).alias("records"))


def _good(ok_codes: Sequence[str]) -> Column:
    return ~F.col("malformed") & F.coalesce(F.col("code").isin(list(ok_codes)), F.lit(False))


def page_rows(pages: DataFrame, ok_codes: Sequence[str] = (K.STATUS_OK,), keep: Sequence[str] = ()) -> DataFrame:
    """SET-3: the records of the pages coded OK, united; ``keep`` are columns of the page to keep."""
    return pages.where(_good(ok_codes)).select(*keep, F.explode("records").alias("r")).select(*keep, "r.*")


def page_rejects(pages: DataFrame, ok_codes: Sequence[str] = (K.STATUS_OK,), end_codes: Sequence[str] = (K.STATUS_NO_DATA,),
                 first_page: int | None = None) -> DataFrame:
    """(feed, page, file, code, message): what a complete feed would not have.

    Pages with an error code, without one, or that are no XML; numbers between a feed's first (or ``first_page``) and last page for
    which no file is there; and feeds whose good pages hold fewer records than a page announced. A feed's
    pages are aggregated to a few numbers and gaps are joined by (feed, page): nothing is collected.
    """
    code = F.when(F.col("malformed"), MALFORMED).otherwise(F.coalesce("code", F.lit(NO_CODE)))
    ended = ~F.col("malformed") & F.coalesce(F.col("code").isin(list(end_codes)), F.lit(False))
    errors = pages.where(~_good(ok_codes) & ~ended).select("feed", "page", "file", code.alias("code"), "message")
    got = F.sum(F.when(_good(ok_codes), F.size("records")).otherwise(0))
    feeds = pages.groupBy("feed").agg(F.min("page").alias("low"), F.max("page").alias("high"), F.max("total").alias("total"), got.alias("got"))
    low = F.col("low") if first_page is None else F.least(F.col("low"), F.lit(first_page))
    numbers = feeds.where("high is not null").select("feed", F.explode(F.sequence(low, F.col("high"))).alias("page"))
    none = F.lit(None).cast("string")
    missing = numbers.join(pages.select("feed", "page"), ["feed", "page"], "left_anti").select(
        "feed", "page", none.alias("file"), F.lit(MISSING).alias("code"), none.alias("message"))
    short = feeds.where("got < total").select("feed", F.lit(None).cast("long").alias("page"), none.alias("file"), F.lit(SHORT).alias("code"),
                                              F.concat_ws(" of ", F.col("got").cast("string"), F.col("total").cast("string")).alias("message"))
    return reduce(DataFrame.unionByName, [errors, missing, short])


def read_xml_gated(spark: SparkSession, path: str, row_tag: str, schema: T.StructType, *,
                   ok_codes=(K.STATUS_OK,), end_codes=(K.STATUS_NO_DATA,)) -> tuple[DataFrame, DataFrame]:
    """SRC-7 + SRC-6: rows of the pages coded OK; returns (rows, rejects).

    Pages coded with an end code add nothing; other pages, and page numbers that are not there, are
    listed in ``rejects`` instead of stopping the job. Each of the two reads a file once; a job that
    needs both writes :func:`parse_pages` and derives them from that table.
    """
    pages = parse_pages(read_responses(spark, path), schema, (row_tag,))
    return page_rows(pages, ok_codes), page_rejects(pages, ok_codes, end_codes)
