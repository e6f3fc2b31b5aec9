"""AGG-2..AGG-5: value counts, row counts, maxima, latest groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def value_counts(df: DataFrame, keys: Sequence[str], value: str, *, count_col: str = "n",
                 first_pos: str | None = None, pos: str | None = None) -> DataFrame:
    """AGG-2: occurrences of each value per key (Counter per row).

    With ``pos``/``first_pos`` the first position of the value is kept too,
    which is what ``most_common`` uses to order ties. Partial aggregation runs
    map-side, so a key holding many rows is combined before the shuffle.
    """
    aggs = [F.count(F.lit(1)).alias(count_col)]
    if pos and first_pos:
        aggs.append(F.min(pos).alias(first_pos))
    return df.groupBy(*keys, value).agg(*aggs)


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    """AGG-3 as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def max_value(df: DataFrame, col: str, name: str | None = None) -> DataFrame:
    """AGG-4: maximum of a column as a one-row DataFrame, with partial maxima per
    task. The latest date of dated folders comes from a listing instead (``sources.manifest``)."""
    return df.agg(F.max(col).alias(name or f"max_{col}"))


def collect_latest(df: DataFrame, snapshot_col: str, member_col: str, *,
                   members_name: str = "members") -> DataFrame:
    """AGG-5 over rows: the distinct members of the latest snapshot, one row. Of dated folders they
    come from the manifest (``sources.manifest.latest_members``), which keeps members without rows."""
    newest = df.agg(F.max(snapshot_col).alias("__newest"))
    rows = df.join(newest, df[snapshot_col] == newest["__newest"], "left_semi")
    return rows.groupBy(snapshot_col).agg(F.array_sort(F.collect_set(member_col)).alias(members_name))
