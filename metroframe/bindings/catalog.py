"""Catalog tables over written folders (SRC-8, SRC-9, SRC-10)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroframe.bindings import query
from metroframe.bindings import tables as tb
from metroframe.session import scratch_path, unique_name
from metroframe.sinks import files as SK
from metroframe.sources.catalog import create_external_table, read_table, repair_table

ORDER_DATA = T.StructType([
    T.StructField("o_orderkey", T.LongType()), T.StructField("o_custkey", T.LongType()),
    T.StructField("o_totalprice", T.DoubleType()), T.StructField("o_orderdate", T.TimestampNTZType()),
    T.StructField("o_orderpriority", T.StringType()), T.StructField("o_orderstatus", T.StringType())])
COLS = [f.name for f in ORDER_DATA.fields]


def _external(spark, d, fmt):
    o = tb.table(spark, d, "orders").select(*COLS)
    path = scratch_path(spark, f"orders_{fmt}_table")
    (SK.write_csv if fmt == "csv" else SK.write_parquet)(o, path, ["o_orderstatus"])
    name = unique_name(f"orders_{fmt}")
    create_external_table(spark, name, path, ORDER_DATA, fmt=fmt, partition_cols=["o_orderstatus"],
                          options={"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"} if fmt == "csv" else None)
    before = read_table(spark, name).count()
    if before != 0:
        raise AssertionError(f"{name}: {before} rows visible before the partitions were registered")
    repair_table(spark, name)
    return name


@query("cat_external_csv", f"SELECT {', '.join(COLS)} FROM orders")
def q_cat_external_csv(spark, d):
    """SRC-8: external table over a partitioned CSV folder, partitions
    registered by repair."""
    return read_table(spark, _external(spark, d, "csv")).select(*COLS)


@query("cat_external_parquet", f"SELECT {', '.join(COLS)} FROM orders")
def q_cat_external_parquet(spark, d):
    """SRC-9: external table over a partitioned Parquet folder."""
    return read_table(spark, _external(spark, d, "parquet")).select(*COLS)


@query("cat_repair_partitions", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus")
def q_cat_repair_partitions(spark, d):
    """SRC-10: MSCK REPAIR TABLE: no rows before, every partition after."""
    t = read_table(spark, _external(spark, d, "parquet"))
    return t.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))
