"""STM-1 / SRC-5 / FLT-6: incremental ingest of newly landed files.

A file stream with a checkpoint replaces the job bookmark: each run (``Trigger.AvailableNow``)
takes exactly the files not seen before and stops. The stream carries file names only; each batch
reads its files (CSV by header name, whatever the order of columns in each) and appends them to the
sink under file names of its own number, with a record in the ledger beside the data. A batch that
is run again after a crash first removes what its earlier attempt left; one that the ledger holds
is skipped. So every file's rows are in the sink once.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from metroframe.sinks.observed import observe_rows, rows_of
from metroframe.sources.headers import SourceFile, hadoop_path, partition_values, read_csv_files

MAX_FILE_AGE = "36500d"  # the source's default of a week would skip older files
LEDGER = "_ingested"  # readers of the sink pass over names that begin with _


def reset_ingest(spark: SparkSession, sink_path: str, checkpoint_path: str) -> None:
    """Forget what was ingested: the next run takes every file again into an empty sink."""
    for path in (sink_path, checkpoint_path):
        fs, target = hadoop_path(spark, path)
        fs.delete(target, True)


def _record(spark: SparkSession, sink_path: str, batch: int, state: str):
    return hadoop_path(spark, f"{sink_path}/{LEDGER}/{batch:09d}.{state}")


def _put(spark: SparkSession, sink_path: str, batch: int, state: str, value: dict) -> None:
    fs, path = _record(spark, sink_path, batch, state)
    out = fs.create(path, True)
    try:
        out.write(bytearray(json.dumps(value).encode()))
    finally:
        out.close()


def ledger(spark: SparkSession, sink_path: str) -> DataFrame:
    """(batch, files, rows) of every batch that is wholly in the sink."""
    fs, folder = hadoop_path(spark, f"{sink_path}/{LEDGER}")
    schema = "batch long, files array<string>, rows long"
    if not fs.exists(folder) or not fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, "*.done")):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("pathGlobFilter", "*.done").json(f"{sink_path}/{LEDGER}/*.done")


def _remove_attempt(spark: SparkSession, sink_path: str, depth: int, name: str) -> None:
    fs, pattern = hadoop_path(spark, "/".join([sink_path, *["*"] * depth, f"{name}-*"]))
    for status in fs.globStatus(pattern) or []:
        fs.delete(status.getPath(), False)


def incremental_ingest(spark: SparkSession, source_path: str, schema: T.StructType, sink_path: str,
                       checkpoint_path: str, *, fmt: str = "csv", partition_by: Sequence[str] = (),
                       options: dict[str, str] | None = None, transform: Callable[[DataFrame], DataFrame] | None = None,
                       max_files_per_trigger: int | None = None, required: Sequence[str] = ()) -> int:
    """Run one AvailableNow pass; returns the number of input rows it took.

    A file counts as new whatever its modification time (back-dated copies too). CSV columns
    are matched by name: one that a file lacks is null (or fails the run, if ``required``), others of the file are
    left out, key=value folders are columns.
    """
    names = spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary") \
        .option("maxFileAge", MAX_FILE_AGE).option("recursiveFileLookup", True)
    if max_files_per_trigger:
        names = names.option("maxFilesPerTrigger", max_files_per_trigger)
    taken = 0

    def take(batch_df: DataFrame, batch: int) -> None:
        nonlocal taken
        session = batch_df.sparkSession
        done, done_path = _record(session, sink_path, batch, "done")
        if done.exists(done_path):
            return  # written before, only the checkpoint did not learn of it
        started, started_path = _record(session, sink_path, batch, "started")
        name = f"batch{batch:09d}"
        if started.exists(started_path):
            _remove_attempt(session, sink_path, len(partition_by), name)
        files = sorted((SourceFile(r["path"], r["length"], int(r["modificationTime"].timestamp() * 1000))
                        for r in batch_df.select("path", "length", "modificationTime").collect()), key=lambda f: f.path)
        _put(session, sink_path, batch, "started", {"batch": batch})
        if fmt == "csv":
            rows = read_csv_files(session, files, schema, base=source_path, required=required, options=options)
        else:
            keys = {k for f in files for k in partition_values(f.path, source_path)}
            full = T.StructType([f for f in schema.fields if f.name not in keys] + [f for f in schema.fields if f.name in keys])
            rows = session.read.format(fmt).options(**(options or {})).option("basePath", source_path).schema(full).load([f.path for f in files])
        rows, seen = observe_rows(rows)
        out = (transform(rows) if transform is not None else rows).write.mode("append").option("mapreduce.output.basename", name)
        (out.partitionBy(*partition_by) if partition_by else out).parquet(sink_path)
        count = rows_of(seen)
        _put(session, sink_path, batch, "done", {"batch": batch, "files": [f.path for f in files], "rows": count})
        taken += count

    query = names.load(source_path).select("path", "length", "modificationTime").writeStream.foreachBatch(take) \
        .option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
    query.awaitTermination()
    if query.exception() is not None:
        raise RuntimeError(str(query.exception()))
    return taken
