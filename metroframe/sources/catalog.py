"""SRC-8..SRC-11: catalog tables over CSV and Parquet folders."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def create_external_table(spark: SparkSession, name: str, path: str, schema: T.StructType, *,
                          fmt: str = "parquet", partition_cols: Sequence[str] = (),
                          options: dict[str, str] | None = None) -> None:
    """SRC-8 / SRC-9: ``CREATE TABLE ... USING fmt PARTITIONED BY ... LOCATION``.

    ``schema`` lists data columns then partition columns. Partitions already
    on storage are only visible after ``repair_table``.
    """
    opts = dict(options or {})
    if fmt == "csv":
        opts.setdefault("header", "true")
        opts.setdefault("multiLine", "true")
        opts.setdefault("escape", '"')
    opt_sql = ""
    if opts:
        opt_sql = " OPTIONS (" + ", ".join(f"'{k}' '{v}'" if v != '"' else f"'{k}' '\\\"'" for k, v in opts.items()) + ")"
    part_sql = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    spark.sql(f"CREATE TABLE {name} ({_ddl(schema)}) USING {fmt}{opt_sql}{part_sql} LOCATION '{path}'")


def repair_table(spark: SparkSession, name: str) -> None:
    """SRC-10: register the partitions found on storage."""
    spark.sql(f"MSCK REPAIR TABLE {name}")


def read_table(spark: SparkSession, name: str) -> DataFrame:
    """SRC-11: a catalog table as a DataFrame."""
    return spark.table(name)
