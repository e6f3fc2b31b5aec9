"""Helpers shared by the operators: tables, written tables, bit filters, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroframe.session import scratch_path

FILTER_BITS = 1 << 25  # a bit filter is 4 MB, whatever the size of the input


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bit_filter(df: DataFrame, key: str) -> np.ndarray:
    """Bits of the low 25 bits of ``key`` (long), as bytes: 4 MB at most on the driver.

    A key that is in ``df`` always finds its bit; another one may. Use it only
    to spare work before an exact join.
    """
    low = F.col(key).bitwiseAND(F.lit(FILTER_BITS - 1))
    rows = (df.select(low.alias("k"))
            .groupBy(F.expr("bitmap_bucket_number(k)").alias("b"))
            .agg(F.expr("bitmap_construct_agg(bitmap_bit_position(k))").alias("bits")).collect())
    out = np.zeros(FILTER_BITS // 8 + 8192, np.uint8)
    for b, bits in rows:
        # bucket b (from 1) holds keys (b-1)*32768+1 .. b*32768, bucket 0 the key 0
        at = b * 4096
        out[at:at + 4096] = np.frombuffer(bits, np.uint8)
    return out


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which int64/uint64 ``keys`` find their bit in a filter made by :func:`bit_filter`."""
    k = keys.astype(np.int64) & (FILTER_BITS - 1)
    # Spark: bucket = (k-1)/32768+1 for k>0 (0 for k=0), position = (k-1)%32768 (0 for k=0)
    pos = np.where(k > 0, k + 32767, 0)
    return (bits[pos >> 3] >> (pos & 7).astype(np.uint8)) & 1 > 0


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over the undirected ``edges`` (x, y).

    Minimum labels spread over the edges with pointer jumping, a written table
    per round, until a round changes nothing; no edge or label reaches the driver.
    """
    both = written(edges.select("x", "y").union(edges.select("y", "x")).distinct(), "cc_edges")
    labels = written(both.groupBy(F.col("x").alias("id")).agg(F.min("y").alias("near"))
                     .select("id", F.least("id", "near").alias("component"), F.lit(True).alias("moved")), "cc")
    while not labels.filter("moved").isEmpty():
        old = labels.select("id", "component")
        near = (both.join(old, both.y == old.id).groupBy(F.col("x").alias("id"))
                .agg(F.min("component").alias("near")))
        step = old.join(near, "id").select("id", F.col("component").alias("was"),
                                           F.least("component", "near").alias("component"))
        hop = old.select(F.col("id").alias("component"), F.col("component").alias("next"))
        labels = written(step.join(hop, "component", "left")
                         .select("id", F.least("component", F.coalesce("next", "component")).alias("component"), "was")
                         .select("id", "component", (F.col("component") != F.col("was")).alias("moved")), "cc")
    return labels.select("id", "component")


def slices(offsets: np.ndarray, limit: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Runs [i, j) of texts of about ``limit`` bytes together, at least one text each."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def crc32_of(col: Column) -> Column:
    return F.crc32(F.coalesce(col.cast("binary"), F.lit("").cast("binary")))
