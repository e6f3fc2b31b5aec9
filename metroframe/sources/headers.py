"""SRC-1 / SRC-5: CSV columns taken by header name, whatever their order in each file.

A catalog says which header line each file has. Files of one header are one scan, with as many
columns as the header and in its order; the scans are united by name. A header is a few bytes at the start of a
file, so a file is opened once for it, by a few threads of the driver: reading the first line with a
job would read the files twice. What was seen of a file (its length and time) is kept with it, so a
catalog that is handed on opens only new or changed files.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

HEAD_BYTES = 4096  # read at first; a longer header is read on
THREADS = 16


@dataclass(frozen=True)
class SourceFile:
    path: str
    length: int
    modified: int


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of a location in any store that Spark reads."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _visible(name: str) -> bool:
    return not name.startswith(("_", "."))


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether :func:`list_files` would find one; looks no further than the first."""
    fs, root = hadoop_path(spark, path)
    if not fs.exists(root):
        return False
    above, found = fs.getFileStatus(root).getPath().depth(), fs.listFiles(root, True)
    while found.hasNext():
        file = found.next().getPath()
        if all(map(_visible, file.toString().split("/")[above - file.depth():])):
            return True
    return False


def list_files(spark: SparkSession, path: str) -> list[SourceFile]:
    """All files below ``path`` in order of their paths; names that begin with _ or . are left out, as Spark does."""
    fs, root = hadoop_path(spark, path)
    if not fs.exists(root):
        return []
    out, folders = [], [root]
    while folders:
        for status in fs.listStatus(folders.pop()):
            if _visible(status.getPath().getName()):
                if status.isDirectory():
                    folders.append(status.getPath())
                else:
                    out.append(SourceFile(status.getPath().toString(), status.getLen(), status.getModificationTime()))
    return sorted(out, key=lambda f: f.path)


def _first_record(text: str, quote: str) -> str | None:
    """The text up to the first line end outside quotes, or None when it is not there yet."""
    quoted = False
    for k, c in enumerate(text):
        if c == quote:
            quoted = not quoted
        elif c in "\r\n" and not quoted:
            return text[:k]
    return None


def read_header(spark: SparkSession, file: SourceFile, *, sep: str = ",", quote: str = '"', encoding: str = "UTF-8") -> tuple[str, ...]:
    """The column names of a file: byte-order mark and spaces around names removed; () for an empty file."""
    fs, path = hadoop_path(spark, file.path)
    codec = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration()).getCodec(path)
    size = HEAD_BYTES
    while True:
        stream = fs.open(path)
        try:
            head = bytes((stream if codec is None else codec.createInputStream(stream)).readNBytes(size))
        finally:
            stream.close()
        # a character cut at the end is not part of the header unless the file ends there
        text = head.decode(encoding, "ignore" if len(head) == size else "strict").removeprefix("﻿")
        record = _first_record(text, quote)
        if record is None and len(head) == size:
            size *= 8
            continue
        names = next(csv.reader(io.StringIO(text if record is None else record), delimiter=sep, quotechar=quote), [])
        return tuple(n.strip() for n in names)


def header_catalog(spark: SparkSession, files: Iterable[SourceFile], known: dict[SourceFile, tuple[str, ...]] | None = None,
                   **options: str) -> dict[SourceFile, tuple[str, ...]]:
    """The header of every file; those in ``known`` (same path, length and time) are not opened again."""
    known = known or {}
    files = list(files)
    new = [f for f in files if f not in known and f.length > 0]
    with ThreadPoolExecutor(THREADS) as pool:
        found = dict(zip(new, pool.map(lambda f: read_header(spark, f, **options), new), strict=True))
    return {f: found.get(f, known.get(f, ())) for f in files}


def partition_values(path: str, base: str) -> dict[str, str]:
    """The key=value folders of ``path`` below ``base``, in order."""
    below = path[len(base.rstrip("/")):] if path.startswith(base) else path.split(re.sub(r"^[a-z0-9+.-]+:/*", "/", base).rstrip("/"), 1)[-1]
    return {unquote(k): unquote(v) for k, v in re.findall(r"(?<=/)([^/=]+)=([^/]*)(?=/)", below)}


def read_csv_files(spark: SparkSession, files: Sequence[SourceFile], schema: T.StructType | None = None, *, base: str,
                   known: dict[SourceFile, tuple[str, ...]] | None = None, required: Sequence[str] = (), sep: str = ",",
                   quote: str = '"', encoding: str = "UTF-8", options: dict[str, str] | None = None) -> DataFrame:
    """The rows of ``files``, columns by header name.

    With a ``schema`` its columns are returned in its order: one that a file lacks is null there, and
    others of the file are left out. Without one, all columns of all headers, as text, in the order they
    are first met. A key=value folder below ``base`` is a column too and wins over one of the file. A header that
    names a column twice, or lacks a ``required`` one, fails the read. Files without a header add no rows.
    """
    catalog = header_catalog(spark, files, known, sep=sep, quote=quote, encoding=encoding)
    groups: dict[tuple, list[str]] = {}
    for file, header in catalog.items():
        if not header:
            continue
        keys = tuple(partition_values(file.path, base))
        twice = {n for n in header if header.count(n) > 1}
        missing = set(required) - set(header) - set(keys)
        if twice or missing:
            raise ValueError(f"{file.path}: {f'columns {sorted(twice)} are named twice' if twice else f'columns {sorted(missing)} are missing'}")
        groups.setdefault((header, keys), []).append(file.path)
    if schema is None:
        names = dict.fromkeys(n for header, keys in groups for n in (*header, *keys))
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    types = {f.name: f.dataType for f in schema.fields}
    reader = {"header": True, "sep": sep, "quote": quote, "escape": quote, "multiLine": True, "encoding": encoding, "mode": "PERMISSIVE",
              **(options or {})}

    def scan(header: tuple[str, ...], keys: tuple[str, ...], paths: list[str]) -> DataFrame:
        # places instead of names, so that no file column meets a folder's
        own = [T.StructField(f"c{k}", types.get(n, T.StringType())) for k, n in enumerate(header)]
        rows = spark.read.options(**reader).option("basePath", base).schema(
            T.StructType([*own, *[T.StructField(k, T.StringType()) for k in keys]])).csv(paths)
        place = {n: f"c{k}" for k, n in enumerate(header)}
        return rows.select(*[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in keys else F.col(place[f.name]) if f.name in place
             else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields])

    scans = [scan(header, keys, paths) for (header, keys), paths in groups.items()]
    return reduce(DataFrame.unionByName, scans) if scans else spark.createDataFrame([], schema)


def read_csv_by_name(spark: SparkSession, path: str, schema: T.StructType | None = None, *, base: str | None = None, **options) -> DataFrame:
    """SRC-1: every CSV file below ``path`` by header name, see :func:`read_csv_files`."""
    return read_csv_files(spark, list_files(spark, path), schema, base=base or path, **options)
