"""SNK-3 / SNK-6: tables replaced as a whole, so that readers see the old or the new one and never none.

    <root>/v-<id>/...                 the data of a version, written by an ordinary job
    <root>/_versions/000000000007     one small file per commit: the version's folder and what is known of it

A version is current once its commit file is there; that file is created, never changed. A job that dies before leaves the old
version current, and data are neither renamed nor deleted while somebody may read them. Two writers that
want the same commit number: one creates the file, the other sees that and takes the next. Rolling back is a new
commit of an older folder. :func:`clean_up` removes folders that no kept commit names.

A catalog table is switched by its location: :func:`publish_table` commits first, then points the table at the
new folder, and :func:`repair_table` makes up for a death in between.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from metroframe.sinks.files import _clustered
from metroframe.sinks.observed import observe_rows, rows_of
from metroframe.sources.headers import hadoop_path

COMMITS = "_versions"
DIGITS = 9


def commits(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all commits, in order."""
    fs, folder = hadoop_path(spark, f"{root}/{COMMITS}")
    if not fs.exists(folder):
        return []
    names = (status.getPath().getName() for status in fs.listStatus(folder))
    return sorted(int(n) for n in names if n.isdigit())


def commit(spark: SparkSession, root: str, number: int) -> dict:
    """What a commit says: folder, rows, columns, written (seconds)."""
    fs, path = hadoop_path(spark, f"{root}/{COMMITS}/{number:0{DIGITS}d}")
    stream = fs.open(path)
    try:
        return json.loads(bytes(stream.readAllBytes()))
    finally:
        stream.close()


def _commit(spark: SparkSession, root: str, entry: dict) -> int:
    """Add ``entry`` as the next commit. The file appears with its content or, where it exists, not at all."""
    fs, folder = hadoop_path(spark, f"{root}/{COMMITS}")
    fs.mkdirs(folder)
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(folder.toUri(), spark._jsc.hadoopConfiguration())
    draft = hadoop_path(spark, f"{root}/{COMMITS}/.{uuid.uuid4().hex}")[1]
    out = fs.create(draft, False)
    try:
        out.write(bytearray(json.dumps(entry).encode()))
    finally:
        out.close()
    rename = spark._jvm.org.apache.hadoop.fs.Options.Rename
    without = spark.sparkContext._gateway.new_array(rename, 1)
    without[0] = rename.NONE
    try:
        while True:
            number = max(commits(spark, root), default=0) + 1
            target = hadoop_path(spark, f"{root}/{COMMITS}/{number:0{DIGITS}d}")[1]
            try:
                context.rename(draft, target, without)  # of this small file; it fails where the target exists
                return number
            except Exception as e:  # noqa: BLE001 - py4j wraps the store's own exception
                if "AlreadyExists" not in str(e):
                    raise
    finally:
        fs.delete(draft, False)


def write_version(df: DataFrame, root: str, partition_by: Sequence[str] = (), *, fmt: str = "parquet", cluster: bool = True,
                  options: dict[str, str] | None = None) -> dict:
    """Write ``df`` to a folder of its own below ``root``; nobody reads it before it is committed."""
    folder = f"v-{uuid.uuid4().hex}"
    counted, seen = observe_rows(df)
    out = _clustered(counted, partition_by if cluster else ()).write.format(fmt).options(**(options or {}))
    (out.partitionBy(*partition_by) if partition_by else out).save(f"{root}/{folder}")
    return {"folder": folder, "format": fmt, "rows": rows_of(seen), "schema": df.schema.jsonValue(), "partition_by": list(partition_by),
            "written": int(time.time())}


def publish(df: DataFrame, root: str, partition_by: Sequence[str] = (), **options) -> int:
    """SNK-3: replace the table at ``root`` by ``df``; returns the commit number."""
    return _commit(df.sparkSession, root, write_version(df, root, partition_by, **options))


def current_path(spark: SparkSession, root: str, number: int | None = None) -> str:
    """The folder of the current version, or of a commit; ``root`` itself where nothing was published."""
    numbers = commits(spark, root)
    if not numbers:
        return root
    return f"{root}/{commit(spark, root, numbers[-1] if number is None else number)['folder']}"


def read_published(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The current version (or that of a commit). The schema is the published one, so partition columns keep their types;
    a folder without commits is read as plain Parquet."""
    numbers = commits(spark, root)
    if not numbers:
        return spark.read.parquet(root)
    entry = commit(spark, root, numbers[-1] if number is None else number)
    schema = T.StructType.fromJson(entry["schema"])
    rows = spark.read.format(entry["format"]).schema(schema).load(f"{root}/{entry['folder']}")
    return rows.select(*[f"`{n}`" for n in schema.fieldNames()])


def roll_back(spark: SparkSession, root: str, number: int) -> int:
    """Make the version of commit ``number`` current again, as a new commit."""
    return _commit(spark, root, commit(spark, root, number))


def clean_up(spark: SparkSession, root: str, keep: int = 2, older_than: float = 86_400.0) -> list[str]:
    """Remove folders that none of the last ``keep`` commits names, and the commits before those; returns the folders.

    A folder without a commit may be a job's that still writes: it stays until ``older_than`` seconds have passed.
    """
    if keep < 1:
        raise ValueError("the current version stays")
    fs, base = hadoop_path(spark, root)
    numbers = commits(spark, root)
    kept = {commit(spark, root, n)["folder"] for n in numbers[-keep:]}
    named = {commit(spark, root, n)["folder"] for n in numbers}
    removed = []
    for n in numbers[:-keep]:  # first the commits, so that none names a folder that is gone
        fs.delete(hadoop_path(spark, f"{root}/{COMMITS}/{n:0{DIGITS}d}")[1], False)
    for status in fs.listStatus(base):
        name = status.getPath().getName()
        young = time.time() - status.getModificationTime() / 1000 < older_than
        if status.isDirectory() and name.startswith("v-") and name not in kept and (name in named or not young):
            fs.delete(status.getPath(), True)
            removed.append(name)
    return sorted(removed)


def _location(spark: SparkSession, name: str) -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'").select("data_type").collect()
    return rows[0][0] if rows else ""


def repair_table(spark: SparkSession, name: str, root: str) -> bool:
    """Point the catalog table at the current version; returns whether it pointed elsewhere.

    One metastore change. The catalog holds no list of partitions that would have to change with it: the
    folder's key=value folders are found when the table is read.
    """
    entry = commit(spark, root, commits(spark, root)[-1])
    fs, folder = hadoop_path(spark, f"{root}/{entry['folder']}")
    path = fs.makeQualified(folder).toString()
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(entry["schema"]).fields)
        spark.sql(f"CREATE TABLE {name} ({columns}) USING {entry['format']} LOCATION '{path}'")
    elif _location(spark, name).rstrip("/") == path.rstrip("/"):
        return False
    else:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    return True


def publish_table(df: DataFrame, name: str, root: str, partition_by: Sequence[str] = (), **options) -> int:
    """SNK-6: rebuild a catalog table as a whole; it keeps its old rows until the new version is committed."""
    number = publish(df, root, partition_by, **options)
    repair_table(df.sparkSession, name, root)
    return number
