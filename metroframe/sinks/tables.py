"""SNK-5..SNK-7: catalog sinks (CTAS, whole-table rebuild, bulk load)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroframe.sinks.observed import observe_rows, rows_of


def create_table_as_select(spark: SparkSession, name: str, query_view: str, path: str,
                           fmt: str = "parquet", partition_cols: Sequence[str] = ()) -> None:
    """SNK-5: ``CREATE TABLE name USING fmt LOCATION path AS SELECT * FROM view``.

    The table is external (its files at ``path``), so no warehouse folder on
    a local disk is involved.
    """
    part = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE {name} USING {fmt}{part} LOCATION '{path}' AS SELECT * FROM {query_view}")


def create_empty_table(spark: SparkSession, name: str, schema: T.StructType, path: str, fmt: str = "parquet") -> None:
    """A typed, empty table (the DDL step of SNK-6/SNK-7)."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE {name} ({cols}) USING {fmt} LOCATION '{path}'")


def insert_overwrite(df: DataFrame, name: str) -> None:
    """SNK-6: whole-table rebuild; columns are matched by name, not position."""
    target_cols = df.sparkSession.table(name).columns
    df.select(*target_cols).write.insertInto(name, overwrite=True)


# a file column of one type may go to a table column of the other without a look at its values
_WIDER = {("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"), ("int", "bigint"),
          ("int", "double"), ("smallint", "double"), ("tinyint", "double"), ("float", "double"), ("date", "timestamp_ntz")}
_NUMBERS = (T.NumericType,)


class LoadError(ValueError):
    """More rows could not be converted than the load allows; nothing was loaded."""


def _binding(source: T.DataType, target: T.DataType) -> str:
    """'same' (also wider), 'checked' (value by value), or 'never'."""
    if source == target or (source.simpleString(), target.simpleString()) in _WIDER:
        return "same"
    plain = T.StringType, T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType
    if isinstance(source, T.StringType) and isinstance(target, plain):
        return "checked"
    if isinstance(target, T.StringType) and isinstance(source, plain):
        return "same"
    return "checked" if isinstance(source, _NUMBERS) and isinstance(target, _NUMBERS) else "never"


def bulk_load(spark: SparkSession, name: str, source_path: str, columns: Sequence[str] | None = None, fmt: str = "parquet", *,
              rejects_path: str | None = None, max_rejects: int = 0) -> tuple[int, int]:
    """SNK-7: load files into a typed table by position (COPY semantics); returns the numbers of rows loaded and rejected.

    The i-th column of the files goes to the i-th column of the table, whatever the names (``columns`` picks file columns in
    another order); folders' key=value pairs are not columns. Another number of columns, or a pair of
    types that has no conversion, fails before anything is read. Text, and numbers that may not fit, are converted value by value:
    a row with one that cannot be is rejected. With more than ``max_rejects`` of them nothing is loaded (:class:`LoadError`);
    otherwise they are written to ``rejects_path``: the columns that failed and the row as JSON.
    """
    target = spark.table(name).schema
    src = spark.read.format(fmt).option("recursiveFileLookup", True).load(source_path)
    if columns is not None:
        src = src.select(*[F.col(f"`{c}`") for c in columns])
    if len(src.columns) != len(target.fields):
        raise ValueError(f"{name} has {len(target.fields)} columns, the files {len(src.columns)}")
    kinds = [_binding(s.dataType, t.dataType) for s, t in zip(src.schema.fields, target.fields, strict=True)]
    never = [f"{s.name} {s.dataType.simpleString()} to {t.name} {t.dataType.simpleString()}"
             for s, t, k in zip(src.schema.fields, target.fields, kinds, strict=True) if k == "never"]
    if never:
        raise TypeError(f"no conversion for {', '.join(never)}")
    # places instead of names: files may have any
    rows = src.toDF(*[f"s{i}" for i in range(len(kinds))])
    value = [F.col(f"s{i}").try_cast(f.dataType) if k == "checked" else F.col(f"s{i}").cast(f.dataType)
             for i, (f, k) in enumerate(zip(target.fields, kinds, strict=True))]
    failed = [F.when(F.col(f"s{i}").isNotNull() & value[i].isNull(), F.lit(target.fields[i].name)) for i, k in enumerate(kinds) if k == "checked"]
    bad = F.filter(F.array(*failed), lambda c: c.isNotNull()) if failed else F.array().cast("array<string>")
    rows = rows.withColumn("failed", bad)
    rejected = rows.where(F.size("failed") > 0).count() if failed else 0
    if rejected > max_rejects:
        worst = rows.select(F.explode("failed").alias("c")).groupBy("c").count().orderBy(F.desc("count"), "c").collect()
        raise LoadError(f"{rejected} rows of {source_path} do not fit {name}: {', '.join(f'{r[0]} {r[1]}' for r in worst)}")
    if rejected and rejects_path:
        original = F.to_json(F.struct(*[F.col(f"s{i}").alias(c) for i, c in enumerate(src.columns)]))
        rows.where(F.size("failed") > 0).select(F.lit(name).alias("table_name"), "failed", original.alias("row")).write.mode("append").parquet(rejects_path)
    kept = rows.where(F.size("failed") == 0) if failed else rows
    counted, seen = observe_rows(kept.select(*[v.alias(f.name) for v, f in zip(value, target.fields, strict=True)]))
    counted.write.insertInto(name, overwrite=False)
    return rows_of(seen), rejected
