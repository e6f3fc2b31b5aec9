"""Sharding by a two-pass external shuffle.

Pass one scatters rows by seeded hashes: a shard by the highest hash of
(seed, shard, id) (rendezvous hashing, so the id and the number of shards decide,
and one more shard takes rows only into itself), then one of the shard's buckets
by a hash of id and text. The number of buckets comes from the measured size, so
that a bucket fits in a task's memory. Pass two shuffles each bucket by
Fisher-Yates with a generator seeded by (seed, shard, bucket) and writes it. A
shard is its buckets in order; as a row's bucket is random, so is its place.

Defined cases: a null text has no bytes (size 8) and the checksum of nothing; rows
with a null id go by the hash of null; rows with one id go to one shard, equal
rows to one bucket, in any order among themselves; an empty table gives an empty
folder with the schema; an input column with the name of an output column is
replaced, all others are written along.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroframe.llm.common import crc32_of, written
from metroframe.session import scratch_path

SEED = 20_240_607
BUCKET_BYTES = 32 << 20
OVERHEAD = 8  # bytes a row counts beside its text


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard whose hash of (seed, shard, key) is highest."""
    ranked = [F.struct(F.xxhash64(F.lit(seed), F.lit(s), key).alias("h"), F.lit(s).alias("s")) for s in range(shards)]
    return F.greatest(*ranked)["s"] if shards > 1 else F.lit(0)


def fisher_yates(n: int, seed: list[int]) -> np.ndarray:
    """A random order of 0..n-1: each place, from the last, swaps with one at or before it."""
    order = list(range(n))
    draw = np.random.Generator(np.random.PCG64(seed)).random(max(n - 1, 0))
    for k, i in enumerate(range(n - 1, 0, -1)):
        j = int(draw[k] * (i + 1))
        order[i], order[j] = order[j], order[i]
    return np.array(order, np.int64)


def write_shards(df: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text",
                 bucket_bytes: int = BUCKET_BYTES, seed: int = SEED) -> DataFrame:
    """Write ``df`` under ``path`` as shard=*/ folders; return the rows read back.

    Added columns: size, text_crc32, grown_shard (with one shard more), bucket, place
    (in the bucket), slot (in the shard, gapless from 0) and shard.
    """
    added = ["size", "text_crc32", "grown_shard", "bucket", "place", "slot", "shard", "tie"]
    text = F.col(f"`{text_col}`").cast("string")
    rows = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in added])
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + OVERHEAD
    total = rows.agg(F.sum(size).alias("n")).first()["n"] or 0
    buckets = max(1, -(-total // (shards * bucket_bytes)))
    key = F.col(f"`{id_col}`")
    # the tie separates rows of one id; equal rows are alike
    rows = (rows.withColumn("size", size).withColumn("text_crc32", crc32_of(text))
            .withColumn("grown_shard", shard_of(key, shards + 1, seed))
            .withColumn("tie", F.xxhash64(F.lit(seed + 1), key, text))
            .withColumn("bucket", F.pmod("tie", F.lit(buckets)).cast("int"))
            .withColumn("shard", shard_of(key, shards, seed)))
    out = T.StructType([f for f in rows.schema.fields if f.name != "tie"] + [T.StructField("place", T.LongType())])

    def run(keys: tuple, group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        # a fixed order first, so that a task that runs again writes the same bucket
        order = pc.sort_indices(group, sort_keys=[("tie", "ascending"), (id_col, "ascending")])
        mixed = fisher_yates(group.num_rows, [seed, keys[0].as_py(), keys[1].as_py()])
        group = group.take(order.take(pa.array(mixed))).append_column("place", pa.array(np.arange(group.num_rows)))
        return group.select([f.name for f in out.fields])

    (rows.groupBy("shard", "bucket").applyInArrow(run, out)
     .write.partitionBy("shard").parquet(path))
    back = df.sparkSession.read.schema(T.StructType([f for f in out.fields if f.name != "shard"] + [out["shard"]])) \
        .parquet(path)
    # a row per bucket: shards times buckets, a number set by the size of a bucket
    sizes = written(back.groupBy("shard", "bucket").agg(F.count("*").alias("n")), "shard_buckets")
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    return back.join(first, ["shard", "bucket"]).withColumn("slot", F.col("before") + F.col("place")).drop("before")


def shards_of(df: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards to a fresh folder below the shared one; the rows as read back."""
    return write_shards(df, scratch_path(df.sparkSession, "shards"), shards, id_col, text_col)
