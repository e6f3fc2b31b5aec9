"""SNK-1..SNK-5, SNK-8: file sinks."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _clustered(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    # One shuffle on the partition keys, so a task writes few output folders
    # instead of a file per (task, partition) pair. ``rebalance`` (unlike a
    # plain repartition) lets AQE split a key holding a large share of the
    # rows over several tasks and files, and merge small ones.
    return df.hint("rebalance", *keys) if keys else df


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), *, mode: str = "overwrite",
                  cluster: bool = True, compression: str = "snappy") -> None:
    """SNK-1: one partitioned folder. An overwrite goes to a folder beside ``path`` and takes its place
    after the job has committed, so a failed job leaves the old data; between the two there is a moment without
    a folder. A table that others read meanwhile is replaced by ``sinks.versions.publish`` (SNK-3)."""
    out = _clustered(df, partition_by) if cluster else df
    w = out.write.option("compression", compression)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if mode != "overwrite":
        w.mode(mode).parquet(path)
        return
    fresh = f"{path.rstrip('/')}.new-{uuid.uuid4().hex[:12]}"
    w.parquet(fresh)
    spark = df.sparkSession
    new, old = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (fresh, path))
    fs = old.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(old, True)
    fs.mkdirs(old.getParent())
    if not fs.rename(new, old):
        raise OSError(f"the new data stay in {fresh}: it could not be renamed to {path}")


def append_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = (), *, cluster: bool = True) -> None:
    """SNK-2: add files; existing partitions are kept."""
    write_parquet(df, path, partition_by, mode="append", cluster=cluster)


def overwrite_partitions(df: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """SNK-8: replace only the partitions present in ``df`` (dynamic overwrite)."""
    out = _clustered(df, partition_by)
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by).parquet(path))


def write_csv(df: DataFrame, path: str, partition_by: Sequence[str] = (), *, mode: str = "overwrite", dynamic: bool = False) -> None:
    """SNK-4: header CSV, UTF-8, one folder per key, quoting as RFC 4180. With ``dynamic`` an overwrite
    replaces only the folders that ``df`` has rows for.

    No byte-order mark is written; readers accept files with or without one.
    """
    out = _clustered(df, partition_by)
    w = (out.write.mode(mode).option("header", True).option("quote", '"').option("escape", '"')
         .option("encoding", "UTF-8").option("ignoreLeadingWhiteSpace", False)
         .option("ignoreTrailingWhiteSpace", False).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
         .option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.csv(path)


def partition_sums(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Per partition: rows, and two order-free checksums over whole rows (columns by name), combined map-side.

    The sum tells how often a row is there, which the exclusive or does not.
    """
    columns = sorted(c for c in df.columns if c not in partition_by)
    row = F.xxhash64(*[F.struct(F.lit(i), F.col(f"`{c}`")) for i, c in enumerate(columns)]) if columns else F.lit(0).cast("long")
    return df.groupBy(*partition_by).agg(F.count(F.lit(1)).alias("rows"), F.sum(row.cast("decimal(38,0)")).alias("total"),
                                         F.bit_xor(row).alias("mixed"))


def copy_partitions(spark, source_path: str, target_path: str, partition_filter, partition_by: Sequence[str],
                    fmt: str = "parquet") -> DataFrame:
    """SNK-8: copy the chosen partitions between stores, verified and resumable.

    The filter is on partition columns, so only those folders are read; the target keeps every partition not being
    copied. Only partitions whose rows differ between the two sides are copied, so a run that is repeated copies
    what is left and repairs what was damaged; one that finds no difference writes nothing. Afterwards both sides are compared
    again, and a difference that is left fails the run. Returns the partitions with their state: ``same``, ``copied``, or ``extra`` (in the
    target alone, left as it is).
    """
    names = list(partition_by)
    source = spark.read.format(fmt).load(source_path).where(partition_filter)

    def target() -> DataFrame:
        path = spark._jvm.org.apache.hadoop.fs.Path(target_path)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if not fs.exists(path) or not any(s.isDirectory() for s in fs.listStatus(path)):
            return spark.createDataFrame([], source.schema)
        spark.catalog.refreshByPath(target_path)
        return spark.read.format(fmt).schema(source.schema).load(target_path).where(partition_filter)

    wanted = partition_sums(source, names).withColumnRenamed("rows", "source_rows")
    # null is a value of a partition column too
    same = [F.col(f"w.{k}").eqNullSafe(F.col(f"h.{k}")) for k in names]

    def compared() -> DataFrame:
        w, h = wanted.alias("w"), partition_sums(target(), names).alias("h")
        state = F.when(F.col("w.source_rows").isNull(), "extra").when(
            F.col("h.rows").isNotNull() & (F.col("w.source_rows") == F.col("h.rows")) & F.col("w.total").eqNullSafe(F.col("h.total"))
            & F.col("w.mixed").eqNullSafe(F.col("h.mixed")), "same").otherwise("differs")
        rows = w.join(h, reduce(lambda a, b: a & b, same), "full").select(
            *[F.coalesce(F.col(f"w.{k}"), F.col(f"h.{k}")).alias(k) for k in names],
            F.coalesce("w.source_rows", "h.rows").alias("rows"), state.alias("state"))
        # a row per partition; kept, since the target changes below
        return spark.createDataFrame(rows.collect(), rows.schema)

    before = compared()
    differs = before.where("state = 'differs'").select(*[F.col(k).alias(f"__{k}") for k in names])
    if differs.isEmpty():
        return before
    chosen = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in names])
    overwrite_partitions(source.join(F.broadcast(differs), chosen, "left_semi"), target_path, names)
    left = compared().where("state = 'differs'").count()
    if left:
        raise OSError(f"{left} partitions of {target_path} differ from {source_path} after the copy")
    return before.withColumn("state", F.when(F.col("state") == "differs", "copied").otherwise(F.col("state")))


def write_csv_charset(df: DataFrame, path: str, encoding: str = "CP949", *, mode: str = "overwrite") -> None:
    """SNK-4 in a legacy charset (CP949 / EUC-KR); the legacy setting is on
    for this write only and then put back."""
    from metroframe.sources.csv import legacy_charsets

    with legacy_charsets(df.sparkSession):
        df.write.mode(mode).option("header", True).option("encoding", encoding) \
            .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
