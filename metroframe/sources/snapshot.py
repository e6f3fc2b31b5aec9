"""SRC-4, FLT-5: dated snapshots of a folder; listings are in :mod:`metroframe.sources.manifest`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroframe.sources.csv import TIMESTAMP_TEXT
from metroframe.sources.headers import SourceFile, list_files, partition_values, read_csv_files
from metroframe.sources.manifest import child_values, files_of, latest_snapshot, refresh_manifest


def _type(name: str) -> T.DataType:
    return T.StringType() if name == "string" else T._parse_datatype_string(name)


def read_partitioned(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None,
                     partition_types: dict[str, str] | None = None, folder: str | None = None,
                     files: list[SourceFile] | None = None, multiline: bool = True) -> DataFrame:
    """Read a Hive-style ``key=value`` folder; its folders' keys are columns.

    They have the given types and are text otherwise: ``request_date`` is 'yyMMdd', and inference
    would turn '050105' into a number. With ``folder`` only that part of ``path`` is read, with ``files`` only those. CSV
    columns are taken by header name. Keys that the schema lacks come last.
    """
    types = partition_types or {}
    if fmt == "csv":
        files = list_files(spark, folder or path) if files is None else files
        keys = dict.fromkeys(k for f in files for k in partition_values(f.path, path))
        full = schema
        if schema is not None:
            own = set(schema.fieldNames())
            full = T.StructType([*schema.fields, *[T.StructField(k, _type(types.get(k, "string"))) for k in {**types, **keys} if k not in own]])
        return read_csv_files(spark, files, full, base=path, options={"multiLine": multiline, "timestampNTZFormat": TIMESTAMP_TEXT})
    reader = spark.read.format(fmt).option("basePath", path)
    if schema is not None:
        reader = reader.schema(T.StructType([*schema.fields, *[T.StructField(k, _type(t)) for k, t in types.items()]]))
    return reader.load(folder or path)


def read_latest_snapshot(spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType | None = None,
                         col: str = "request_date", manifest_path: str | None = None, multiline: bool = True) -> DataFrame:
    """SRC-4: the rows of the latest snapshot only.

    The date comes from a listing of the root's children, and only that folder is listed and
    read: neither the files nor the headers of other snapshots play a part. With a ``manifest_path`` the
    manifest there is refreshed and names the files.
    """
    date, folder = latest_snapshot(spark, path, col)
    return _snapshot(spark, path, fmt, schema, col, date, folder, manifest_path, multiline)


def read_snapshot(spark: SparkSession, path: str, date: str, fmt: str = "csv", schema: T.StructType | None = None,
                  col: str = "request_date", manifest_path: str | None = None, multiline: bool = True) -> DataFrame:
    """FLT-5: the rows of one snapshot; only its folder is listed and read."""
    folder = child_values(spark, path, col).get(date)
    if folder is None:
        raise ValueError(f"no {col}={date} under {path}")
    return _snapshot(spark, path, fmt, schema, col, date, folder, manifest_path, multiline)


def _snapshot(spark, path, fmt, schema, col, date, folder, manifest_path, multiline) -> DataFrame:
    files = files_of(refresh_manifest(spark, path, manifest_path, col), date, col) if manifest_path else None
    df = read_partitioned(spark, path, fmt, schema, {col: "string"}, folder=folder, files=files, multiline=multiline)
    return df.withColumn(col, F.lit(date))
