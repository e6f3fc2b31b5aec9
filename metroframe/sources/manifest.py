"""SRC-4, FLT-5, AGG-4, AGG-5: dated snapshots known from listings, without opening a data file.

``<root>/request_date=yyMMdd/district=.../files``: the dates are the children of the root, so the newest one
takes a listing of one level, however long the history. Whoever asks about the history keeps a
manifest: a small table of every date's members, files and sizes. Refreshing it lists the
folders of new dates alone (and of the newest known one, which may still have been filling),
and forgets dates whose folders are gone.
"""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroframe.sources.headers import SourceFile, _visible, hadoop_path, list_files

MANIFEST = "member string, file string, bytes long, modified long"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def child_values(spark: SparkSession, path: str, col: str) -> dict[str, str]:
    """The values of the ``col=value`` folders directly below ``path``, each with its folder, in order of the values."""
    fs, root = hadoop_path(spark, path)
    if not fs.exists(root):
        return {}
    found = {}
    for status in fs.listStatus(root):
        name = status.getPath().getName()
        if status.isDirectory() and _visible(name) and name.startswith(f"{col}=") and not name.endswith(f"={NO_VALUE}"):
            found[unquote(name[len(col) + 1:])] = status.getPath().toString()
    return dict(sorted(found.items()))


def latest_snapshot(spark: SparkSession, path: str, col: str = "request_date") -> tuple[str, str]:
    """AGG-4: (date, folder) of the largest ``col`` below ``path``, as text; only the root is listed."""
    dates = child_values(spark, path, col)
    if not dates:
        raise ValueError(f"no {col}= partition under {path}")
    return max(dates.items())


def _entries(spark: SparkSession, folder: str, member: str) -> list[tuple[str | None, str | None, int, int]]:
    """(member, file, bytes, modified) of a date's folder; a member without files has one row without a file."""
    out: list[tuple[str | None, str | None, int, int]] = []
    members = child_values(spark, folder, member)
    for value, path in members.items():
        files = list_files(spark, path)
        out += [(value, f.path, f.length, f.modified) for f in files] or [(value, None, 0, 0)]
    fs, root = hadoop_path(spark, folder)
    for status in fs.listStatus(root):  # what lies beside the members' folders
        path = status.getPath().toString()
        if _visible(status.getPath().getName()) and path not in members.values():
            files = list_files(spark, path) if status.isDirectory() else [SourceFile(path, status.getLen(), status.getModificationTime())]
            out += [(None, f.path, f.length, f.modified) for f in files]
    return out


def refresh_manifest(spark: SparkSession, path: str, manifest_path: str, col: str = "request_date", member: str = "district") -> DataFrame:
    """Bring the manifest up to date and return it: ``col``, member, file, bytes, modified.

    New dates are listed and written as partitions of the manifest, so a run that dies leaves the others as they were.
    """
    present, known = child_values(spark, path, col), child_values(spark, manifest_path, col)
    for date in known.keys() - present.keys():
        fs, gone = hadoop_path(spark, known[date])
        fs.delete(gone, True)
    both = present.keys() & known.keys()
    again = [d for d in present if d not in known or (both and d == max(both))]
    rows = [(date, *entry) for date in again for entry in _entries(spark, present[date], member)]
    if rows:
        (spark.createDataFrame(rows, f"`{col}` string, {MANIFEST}").repartition(col).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy(col).parquet(manifest_path))
    return read_manifest(spark, manifest_path, col)


def read_manifest(spark: SparkSession, manifest_path: str, col: str = "request_date") -> DataFrame:
    """The manifest as it was last written; without one, no rows."""
    schema = f"{MANIFEST}, `{col}` string"
    if not child_values(spark, manifest_path, col):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(manifest_path)


def files_of(manifest: DataFrame, date: str, col: str = "request_date") -> list[SourceFile]:
    """FLT-5: the files of one snapshot."""
    rows = manifest.where((F.col(col) == F.lit(date)) & F.col("file").isNotNull()).select("file", "bytes", "modified").collect()
    return sorted((SourceFile(*r) for r in rows), key=lambda f: f.path)


def latest_date(manifest: DataFrame, col: str = "request_date", name: str | None = None) -> DataFrame:
    """AGG-4: the largest date, one row."""
    return manifest.agg(F.max(col).alias(name or f"max_{col}"))


def latest_members(manifest: DataFrame, col: str = "request_date", members_name: str = "members") -> DataFrame:
    """AGG-5: the members of the latest snapshot, one row. A member counts by its folder, whether its files hold rows or not.

    A date's members are folder names, a few dozen districts; they are grouped, not the data.
    """
    newest = manifest.agg(F.max(col).alias("__newest"))
    return (manifest.join(newest, manifest[col] == newest["__newest"], "left_semi").groupBy(col)
            .agg(F.array_sort(F.collect_set("member")).alias(members_name)))
