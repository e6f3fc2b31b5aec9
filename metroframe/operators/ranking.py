"""TOP-1..TOP-3, DUP-1: top-k per group, rank pivot, first row, dedup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], k: int,
                    rank_col: str = "rank") -> DataFrame:
    """TOP-1: the first ``k`` rows of each group under ``order``.

    ``row_number() <= k`` is planned with a WindowGroupLimit on both sides of
    the shuffle, so only k rows per group and task cross the network even
    when one group holds a large share of the rows.
    """
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def ranks_to_columns(df: DataFrame, group: Sequence[str], rank_col: str, value_col: str,
                     names: Sequence[str]) -> DataFrame:
    """TOP-2: rank i -> column names[i-1]; null when the group has fewer."""
    return df.groupBy(*group).agg(*[
        F.max(F.when(F.col(rank_col) == i + 1, F.col(value_col))).alias(n) for i, n in enumerate(names)
    ])


def first_row(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """TOP-3: the first row under a total order (a top-1, not a sort)."""
    return df.orderBy(*order).limit(1)


def drop_duplicates_stable(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None = None) -> DataFrame:
    """DUP-1: one row per key. ``dropDuplicates`` keeps an arbitrary row; here
    the kept row is the first under ``order`` (default: all other columns),
    so reruns give the same output."""
    if order is None:
        order = [F.col(c).asc_nulls_first() for c in df.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).where(F.col("__rn") == 1).drop("__rn")
