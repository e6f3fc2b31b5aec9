"""FLT-1..FLT-5: row filters."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def not_null(df: DataFrame, *cols: str) -> DataFrame:
    """FLT-1."""
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond)


def in_list(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """FLT-2: pushed to the scan as an In filter."""
    return df.where(F.col(col).isin(list(values)))


def contains(df: DataFrame, col: str, needle: str) -> DataFrame:
    """FLT-3: literal substring (pushed to Parquet as StringContains)."""
    return df.where(F.col(col).contains(needle))


def word_list(spark: SparkSession, words: Sequence[str], name: str = "word") -> DataFrame:
    """A fixed word list as a one-column DataFrame (size known up front)."""
    return spark.createDataFrame([(w,) for w in dict.fromkeys(words)], f"{name} string")


def exclude_words(df: DataFrame, col: str, stop_words: Sequence[str]) -> DataFrame:
    """FLT-4: drop rows whose ``col`` is a stop word.

    The list is a fixed, literal set (its size is bounded by construction), so
    it is broadcast into a left-anti join; nothing about it grows with data.
    """
    spark = df.sparkSession
    stops = F.broadcast(word_list(spark, stop_words, "__stop"))
    return df.join(stops, F.col(col) == F.col("__stop"), "left_anti")


def partition_equals(df: DataFrame, col: str, value) -> DataFrame:
    """FLT-5: equality on a partition column, pruned at planning time."""
    return df.where(F.col(col) == F.lit(value))
