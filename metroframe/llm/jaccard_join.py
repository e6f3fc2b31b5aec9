"""N-gram Jaccard join by parity sketches.

Tokens (word shingles) are XORed into a sketch of blocks. A token changes one
block only, so the number of blocks that differ, like the Hamming distance of
the bit sketch, is at most the symmetric difference of two sets. At a Jaccard
similarity of 0.8 that is (a + b) / 9 at most, and as b <= 1.25 a, a / 4 at
most. Of a set's non-empty blocks, taken in one global order (most tokens
first, then by hash), the first a // 4 + 1 therefore hold a block that the
other set's first ones hold too: those blocks are the join keys (pigeonhole).

Block counts go by size bands [2**k, 2**(k+1)); a set within a factor 1.25 of
the next band emits keys there too, so each similar pair meets in one band. A
set with too few non-empty blocks emits all of them and its smallest shingles.

Keys are joined through pivots: each set of a bucket is compared with three of
the bucket's only, exactly, after a Hamming test of a 512-bit sketch: its smallest set, the
same over many buckets, and its neighbours in an order by a hash of key and set, others in each bucket, which
tie together groups of near copies around the limit, not all of them linked with the smallest.
Then pairs of a bucket that are in different components are compared, so no link between
components is lost and few near copies are left to be paired. Such a pair is made where no key
among the BEFORE preceding ones of each set, in order of keys, is in both lists: at its first common key
always, at later ones seldom, however many keys the two sets share.

Equal sets share a 64-bit id; two different sets get the same one with a
probability of 2**-64 a pair.

Defined cases: a null or empty text, or one without words, has an empty set and
links with nothing (its component is its own id); fewer than five words make
one shingle; repeated rows are kept, each with its result, and rows of one
doc_id count as one node; a row without a doc_id keeps its size and has no
component; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from metroframe.llm import vectext as V
from metroframe.llm.common import bit_filter, components, may_hold, slices, written

K = 5
SKETCH_WORDS = 8  # 512 bits
BEFORE = 16  # preceding keys that go with a key of a set; only spares work
SEEN_LIMIT = 200_000  # ids a task remembers to emit a copy's keys once; only spares work
U = np.uint64


def shingle_sets(column, k: int = K) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text of an Arrow string column."""
    data, at = V.buffer(column)
    for i, j in slices(at):
        part, bounds = data[at[i]:at[j]], at[i:j + 1] - at[i]
        _, _, words, _owner = V.words(part, bounds, lower=True)
        first = np.searchsorted(_owner, np.arange(j - i + 1))
        rolled = V.shingles(words, k)
        for d in range(j - i):
            a, b = first[d], first[d + 1]
            if b - a >= k:
                own = np.sort(rolled[a:b - k + 1])
                yield own[np.concatenate([[True], own[1:] != own[:-1]])]
            elif b > a:  # the whole short text as one shingle, its length told apart
                yield V.mix(V.shingles(words[a:b], b - a) + U(b - a))
            else:
                yield np.zeros(0, U)


def set_id(own: np.ndarray) -> int:
    """A 64-bit id of a set: from the sum and the XOR of its mixed hashes and its size."""
    a = V.mix(own ^ U(0x51ED270B35A7AD01))
    x = np.array([a.sum(dtype=U), np.bitwise_xor.reduce(own * U(0x9E3779B97F4A7C15)), len(own)], U)
    return int(V.mix(V.mix(V.mix(x[:1]) + x[1:2]) + x[2:]).astype(np.int64)[0])


def parity_sketch(own: np.ndarray) -> np.ndarray:
    """512 bits as 8 words: each token flips one bit."""
    bit = (own >> U(55)).astype(np.int64)
    odd = (np.bincount(bit, minlength=512) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def block_count(band: int) -> int:
    return max(16, -(-(2 << band) * 5 // 16)) + 4


def keys_of(own: np.ndarray) -> np.ndarray:
    """The join keys of a set of n >= 1 tokens: n // 4 + 1 in its band, and as many in the next one if near it."""
    n = len(own)
    band, need, out = n.bit_length() - 1, n // 4 + 1, []
    for b in (band, band + 1) if 5 * n >= 4 * (2 << band) else (band,):
        m = block_count(b)
        block = ((own >> U(32)) * U(m) >> U(32)).astype(np.int64)  # own is sorted, so blocks ascend
        cut = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
        fill = np.diff(np.append(cut, n))
        value = np.bitwise_xor.reduceat(V.mix(own), cut)
        key = V.mix(value + block[cut].astype(U) * U(0x9E3779B97F4A7C15) + U(b << 56))
        if len(key) < need:  # all blocks, and the prefix of the set itself
            out += [key, V.mix(own[:n // 5 + 1] + U((b + 64) << 56))]
        else:
            out.append(key[np.lexsort((key, -fill))[:need]])
    return np.concatenate(out)


def _members(batches):
    for b in batches:
        ids, size, sketch = [], [], []
        for own in shingle_sets(b.column(1)):
            ids.append(set_id(own) if len(own) else None)
            size.append(len(own))
            sketch.append(parity_sketch(own))
        cols = np.array(sketch, np.int64).reshape(-1, SKETCH_WORDS).T
        yield pa.RecordBatch.from_arrays(
            [b.column(0).cast(pa.int64()), pa.array(size, pa.int64()), pa.array(ids, pa.int64()),
             *(pa.array(np.ascontiguousarray(c)) for c in cols)],
            names=["doc_id", "n_shingles", "sid", *(f"s{i}" for i in range(SKETCH_WORDS))])


def _keys(batches):
    seen: set[int] = set()
    for b in batches:
        keys, ids = [], []
        for own in shingle_sets(b.column(1)):
            if not len(own) or (sid := set_id(own)) in seen:
                continue
            if len(seen) < SEEN_LIMIT:
                seen.add(sid)
            keys.append(keys_of(own).astype(np.int64))
            ids.append(np.full(len(keys[-1]), sid, np.int64))
        if keys:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(ids))],
                                             names=["key", "sid"])


def _sets(bits: np.ndarray):
    def run(batches):
        seen: set[int] = set()
        for b in batches:
            ids, sets = [], []
            for own in shingle_sets(b.column(1)):
                if not len(own) or not may_hold(bits, np.array([sid := set_id(own)]))[0] or sid in seen:
                    continue
                if len(seen) < SEEN_LIMIT:
                    seen.add(sid)
                ids.append(sid)
                sets.append(own.astype(np.int64))
                if sum(map(len, sets[-1000:])) > 500_000:
                    yield _set_batch(ids, sets)
                    ids, sets = [], []
            if ids:
                yield _set_batch(ids, sets)
    return run


def _set_batch(ids, sets):
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(sets)))],
        names=["sid", "tokens"])


def _sketch(prefix: str) -> list:
    return [F.col(f"{prefix}{i}") for i in range(SKETCH_WORDS)]


def _may_link(percent: int):
    """The size and sketch tests of two sets; the columns are n_x, n_y, x0.. and y0.. ."""
    apart = sum((F.bit_count(a.bitwiseXOR(b)) for a, b in zip(_sketch("x"), _sketch("y"), strict=True)), F.lit(0))
    # similar: 100 i >= p (both - i), so the symmetric difference is at most both (100 - p) / (100 + p)
    return ((100 * F.least("n_x", "n_y") >= percent * F.greatest("n_x", "n_y"))
            & ((100 + percent) * apart <= (100 - percent) * (F.col("n_x") + F.col("n_y"))))


def _side(df: DataFrame, name: str, *more: str) -> DataFrame:
    """A set's columns (sid, size, sketch) named for one side of a pair."""
    return df.select(*more, F.col("sid").alias(name), F.col("n_shingles").alias(f"n_{name}"),
                     *(F.col(f"s{i}").alias(f"{name}{i}") for i in range(SKETCH_WORDS)))


def _verified(near: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """The pairs (x, y, n_x, n_y) of set ids that are similar, by their exact sets."""
    near = written(near.select("x", "y", "n_x", "n_y"), "jaccard_near")
    wanted = near.select(F.col("x").alias("sid")).union(near.select("y"))
    run = _sets(bit_filter(wanted, "sid"))
    sets = (docs.mapInArrow(run, "sid bigint, tokens array<bigint>")
            .join(wanted.distinct(), "sid", "left_semi").dropDuplicates(["sid"]))
    sets = written(sets, "jaccard_sets")
    pair = (near.join(sets.select(F.col("sid").alias("x"), F.col("tokens").alias("tx")), "x")
            .join(sets.select(F.col("sid").alias("y"), F.col("tokens").alias("ty")), "y"))
    common = F.size(F.array_intersect("tx", "ty"))
    return (pair.select("x", "y", (F.col("n_x") + F.col("n_y")).alias("both"), common.alias("i"))
            .filter(F.col("i") * 100 >= percent * (F.col("both") - F.col("i"))).select("x", "y"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       percent: int = 80) -> DataFrame:
    """Per row of ``docs``: doc_id, n_shingles, component_id. ``percent`` is 80 or more."""
    if percent < 80:
        raise ValueError("the key bounds hold for 80 percent or more")
    docs = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    members = written(docs.mapInArrow(_members, "doc_id bigint, n_shingles bigint, sid bigint, " + ", ".join(
        f"s{i} bigint" for i in range(SKETCH_WORDS))), "jaccard_members")
    info = members.filter("sid is not null").drop("doc_id").dropDuplicates(["sid"])
    bucket = Window.partitionBy("key").orderBy("sid")
    # the smallest id of a bucket; a bucket of one id needs no row
    buckets = written(docs.mapInArrow(_keys, "key bigint, sid bigint")
                      .withColumn("pivot", F.first("sid").over(bucket))
                      .filter("sid <> pivot").distinct(), "jaccard_buckets")
    ring = Window.partitionBy("key").orderBy(F.xxhash64("key", "sid"), "sid")
    spread = (buckets.select("sid", F.lead("sid").over(ring).alias("p")).filter("p is not null")
              .select(F.least("sid", "p").alias("x"), F.greatest("sid", "p").alias("y")))
    star = buckets.select(F.col("pivot").alias("x"), F.col("sid").alias("y")).union(spread).distinct()
    star = star.join(_side(info, "x"), "x").join(_side(info, "y"), "y").filter(_may_link(percent))
    links = written(_verified(star, docs, percent), "jaccard_links")
    groups = components(links)
    # pairs of a bucket that no link joins yet; the pivot has met everyone
    placed = (buckets.join(groups.withColumnRenamed("id", "sid"), "sid", "left")
              .withColumn("component", F.coalesce("component", "sid")))
    mixed = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")) \
        .filter("lo <> hi").select("key")
    earlier = Window.partitionBy("sid").orderBy("key").rowsBetween(-BEFORE, -1)
    rest = written(placed.join(mixed, "key", "left_semi").select("key", "sid", "component")
                   .withColumn("before", F.collect_list("key").over(earlier)).join(info, "sid"), "jaccard_rest")
    left, right = _side(rest, "x", "key", F.col("component").alias("cx"), F.col("before").alias("before_x")), \
        _side(rest, "y", "key", F.col("component").alias("cy"), F.col("before").alias("before_y"))
    # size, sketch and earlier keys decide inside the join: sets that merely share a passage give no rows, others few
    more = left.join(right, (left["key"] == right["key"]) & (F.col("x") < F.col("y")) & (F.col("cx") != F.col("cy"))
                     & _may_link(percent) & ~F.arrays_overlap("before_x", "before_y")) \
        .select("x", "y", "n_x", "n_y").distinct()
    late = written(_verified(more, docs, percent), "jaccard_links")
    if not late.isEmpty():
        groups = components(links.union(late))
    named = members.filter("doc_id is not null and sid is not null").select("doc_id", "sid")
    # documents are the nodes in the end: a doc_id with several rows ties their sets together
    named = named.join(groups.withColumnRenamed("id", "sid"), "sid", "left") \
        .select("doc_id", F.coalesce("component", "sid").alias("node")).distinct()
    twice = named.groupBy("doc_id").agg(F.min("node").alias("x"), F.max("node").alias("y")).filter("x <> y")
    if not twice.isEmpty():
        ties = named.join(twice.select("doc_id", "x"), "doc_id").select("x", F.col("node").alias("y"))
        merged = components(ties).withColumnRenamed("id", "node")
        named = named.join(merged, "node", "left").select("doc_id", F.coalesce("component", "node").alias("node")) \
            .distinct()
    least = named.groupBy("node").agg(F.min("doc_id").alias("component_id"), F.count("*").alias("n"))
    of = named.join(least.filter("n > 1"), "node").select("doc_id", "component_id")
    return members.select("doc_id", "n_shingles").join(of, "doc_id", "left") \
        .select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
