"""Incremental ingest with a file stream and a checkpoint (STM-1, SRC-5, FLT-6)."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroframe.bindings import query
from metroframe.bindings import tables as tb
from metroframe.session import scratch_path
from metroframe.sinks import files as SK
from metroframe.streaming.ingest import incremental_ingest

EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])
FIRST_BATCH = ["click", "view", "error"]


@query("stm_incremental_ingest", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_stm_incremental_ingest(spark, d):
    """STM-1: events land in two batches of CSV files, the second with its
    columns in another order; each AvailableNow run ingests only the new files, by
    header name, and a run with nothing new adds nothing."""
    e = tb.table(spark, d, "events").select(*[f.name for f in EVENT_SCHEMA.fields])
    landing, sink, ckpt = (scratch_path(spark, n) for n in ("events_landing", "events_sink", "events_ckpt"))
    first = e.where(F.col("event_type").isin(FIRST_BATCH))
    second = e.where(~F.col("event_type").isin(FIRST_BATCH) | F.col("event_type").isNull())
    opts = {"timestampNTZFormat": "yyyy-MM-dd HH:mm:ss[.SSSSSS]"}
    SK.write_csv(first, landing, mode="append")
    n1 = incremental_ingest(spark, landing, EVENT_SCHEMA, sink, ckpt, partition_by=["event_type"], options=opts)
    SK.write_csv(second.select(*reversed(second.columns)), landing, mode="append")
    n2 = incremental_ingest(spark, landing, EVENT_SCHEMA, sink, ckpt, partition_by=["event_type"], options=opts)
    n3 = incremental_ingest(spark, landing, EVENT_SCHEMA, sink, ckpt, partition_by=["event_type"], options=opts)
    if n3 != 0:
        raise AssertionError(f"re-run without new files ingested {n3} rows (batches: {n1}, {n2})")
    return spark.read.parquet(sink).select(*[f.name for f in EVENT_SCHEMA.fields])
