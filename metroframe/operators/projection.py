"""PRJ-1..PRJ-10: projection, renames, casts, mappings, tags and recodes."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroframe.functions.casts import lenient_cast


def select_cast(df: DataFrame, spec: Sequence[tuple[str, str, str | None]]) -> DataFrame:
    """PRJ-1: ``[(source, target, type or None)]`` -> one select with lenient casts."""
    cols = []
    for source, target, type_name in spec:
        c = F.col(source)
        cols.append((lenient_cast(c, type_name) if type_name else c).alias(target))
    return df.select(*cols)


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """PRJ-2: rename, keeping other columns. Two sources may not share a target
    (the reference mapped two names to one target; only one can survive)."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    targets = list(present.values())
    dupes = {t for t in targets if targets.count(t) > 1}
    if dupes:
        raise ValueError(f"several present columns renamed to {sorted(dupes)}")
    return df.withColumnsRenamed(present)


def cast_columns(df: DataFrame, types: Mapping[str, str], *, strict: Iterable[str] = ()) -> DataFrame:
    """PRJ-3: cast named columns leniently; integral columns listed in
    ``strict`` turn decimal text into null instead of its integer part."""
    strict = set(strict)
    return df.withColumns({
        c: lenient_cast(F.col(c), t, truncate_decimals=c not in strict)
        for c, t in types.items()
    })


def apply_mapping(df: DataFrame, mappings: Sequence[tuple[str, str, str]]) -> DataFrame:
    """PRJ-4: declarative ``(source, target, type)`` mapping.

    Source names match without regard to case; unmapped columns are dropped;
    a source that is absent gives a typed null column.
    """
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for source, target, type_name in mappings:
        actual = by_lower.get(source.lower())
        c = F.col(actual) if actual is not None else F.lit(None).cast("string")
        cols.append(lenient_cast(c, type_name).alias(target))
    return df.select(*cols)


def positional_rename(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """PRJ-5: rename all columns by position."""
    if len(names) != len(df.columns):
        raise ValueError(f"expected {len(df.columns)} names, got {len(names)}")
    return df.toDF(*names)


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """PRJ-6."""
    return df.drop(*names)


def tag(df: DataFrame, name: str, value) -> DataFrame:
    """PRJ-7: a constant column."""
    return df.withColumn(name, F.lit(value))


def align_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """PRJ-8: select the schema's columns in order; missing ones become typed
    nulls, present ones are cast to the declared type."""
    present = set(df.columns)
    return df.selectExpr(*[
        f"CAST({'`' + f.name + '`' if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
        for f in schema.fields
    ])


def case_by_prefix(c, mapping: Sequence[tuple[str, str]], length: int | None = None) -> Column:
    """PRJ-9: searched CASE over a fixed-length prefix, else null.

    Use for short code lists; large lists belong in a lookup join (JN-2).
    """
    col = F.col(c) if isinstance(c, str) else c
    n = length or len(mapping[0][0])
    key = F.substring(col, 1, n)
    out = None
    for code, value in mapping:
        out = F.when(key == code, value) if out is None else out.when(key == code, value)
    return out.otherwise(F.lit(None))


def recode_bool(c, true_value, false_value) -> Column:
    """PRJ-10: three-valued recode, anything else null."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(col == true_value, True).when(col == false_value, False).otherwise(F.lit(None).cast("boolean"))
