"""Token files: ids ranked by frequency in a byte-aligned variable-length code.

Documents are encoded once, into a table of ids. Counts of every id over all documents
give ranks (the most frequent id is rank 0); a rank takes one to four bytes, and
two bits of a separate control byte say how many, four ranks to a control byte,
so that a decoder finds all lengths by a table of 256 rows and gathers the bytes
with numpy. Rows go by range to files in ascending id order and are packed into
blocks of whole documents. The container is Parquet, written by Spark, whose
commit survives lost tasks; the rank table (a row per id of the vocabulary, a
fixed size) lies beside the files.

Encoding splits a text before each single space between two non-space characters,
where the tokenizer's own pattern always cuts, and remembers the ids of pieces in
a bounded memory; a text where such a cut is not certain is encoded whole.

Defined cases: a null text counts as empty and has the end id only; rows with one id
lie next to each other by a hash of their ids; rows without an id come first; an
empty table gives files without rows; other columns are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroframe.llm import vectext as V
from metroframe.llm.common import slices, written
from metroframe.session import scratch_path

PIECES = 1_000_000  # pieces a worker remembers
NEW = -2  # the slot of a piece not met yet
BLOCK_IDS = 1 << 20
FILE_IDS = 16 << 20


class _Pieces:
    """Ids of the pieces met so far, in one array; a piece has a slot: where its ids start, and how many."""

    def __init__(self, tokenizer, width: str, lead: str):
        self.tokenizer, self.width, self.lead = tokenizer, width, lead
        # the ids that begin with a space: where pieces are joined by spaces, they tell the pieces apart
        spaced = [i for t, i in tokenizer.get_vocab().items() if t.startswith("\u0120")]
        self.opens = np.zeros(max(tokenizer.get_vocab_size(), 1 + max(spaced, default=0)), bool)
        self.opens[spaced] = True
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.pool, self.starts, self.sizes = np.zeros(1 << 16, self.width), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64)
        self.used = 0

    def ids(self, text: str) -> np.ndarray:
        return self.each([text])[0]

    def each(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(f.ids, self.width) for f in found]

    def slots(self, keys: list[str]) -> np.ndarray:
        """The slot of each piece (all different), -1 for one that cannot stand alone; new ones are encoded together."""
        got = np.fromiter(map(self.slot.get, keys, repeat(NEW)), np.int64, len(keys))
        new = np.flatnonzero(got == NEW).tolist()
        if new and len(self.slot) + len(new) > PIECES:
            self.forget()
            new = range(len(keys))
        for k in range(0, len(new), 20_000):
            part = new[k:k + 20_000]
            got[part] = self._learn([keys[i] for i in part])
        return got

    def _learn(self, part: list[str]) -> np.ndarray:
        good = np.array([p != "" and p == p.strip() for p in part])
        alone = part if good.all() else [p for p, g in zip(part, good.tolist(), strict=True) if g]
        got = np.full(len(part), -1)
        if len(alone) < len(part):
            self.slot.update((p, -1) for p, g in zip(part, good.tolist(), strict=True) if not g)
        if not alone:
            return got
        if self.lead:
            ids = self.ids(self.lead + self.lead.join(alone))
            at = np.flatnonzero(self.opens[ids])
        if not self.lead or len(at) != len(alone) or at[0]:
            own = self.each([self.lead + p for p in alone])
            ids = np.concatenate(own)
            at = np.cumsum([0, *[len(o) for o in own[:-1]]])
        first, size = len(self.slot), np.diff(at, append=len(ids))
        end = first + len(alone)
        if end > len(self.starts):
            self.starts, self.sizes = (np.concatenate([x, np.zeros(end, np.int64)]) for x in (self.starts, self.sizes))
        if self.used + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros(self.used + len(ids), self.width)])
        self.pool[self.used:self.used + len(ids)] = ids
        self.starts[first:end], self.sizes[first:end] = at + self.used, size
        self.slot.update(zip(alone, range(first, end), strict=True))
        self.used += len(ids)
        got[good] = np.arange(first, end)
        return got


class Encoder:
    """A tokenizers file whose pre-tokenizer is the byte-level pattern."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import tokenizers

        kind = json.loads((tok := tokenizers.Tokenizer.from_file(path)).to_str())
        pre = kind["pre_tokenizer"] or {}
        self.splits = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not kind["normalizer"] \
            and not pre.get("add_prefix_space") and not any(" " in t["content"] or t["lstrip"] or t["rstrip"]
                                                            for t in kind["added_tokens"])
        self.size = tok.get_vocab_size()
        self.width = "<u2" if self.size <= 1 << 16 else "<u4"
        self.first, self.next = _Pieces(tok, self.width, ""), _Pieces(tok, self.width, " ")

    def encode(self, texts: pa.Array, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with ``end`` after it; how many ids each text has). Texts are not null."""
        n = len(texts)
        lists = pc.split_pattern(texts, " ")
        at = lists.offsets.to_numpy().astype(np.int64)
        at, flat = at - at[0], lists.flatten()
        start, size = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
        whole = np.ones(n, bool)
        if self.splits:
            found = flat.dictionary_encode()
            place, keys = found.indices.to_numpy(), found.dictionary.to_pylist()
            slot = self.next.slots(keys)[place]
            start, size = self.next.starts[slot], self.next.sizes[slot]
            heads, each = np.unique(place[at[:-1]], return_inverse=True)
            head = self.first.slots([keys[k] for k in heads])[each]
            slot[at[:-1]] = head
            start[at[:-1]], size[at[:-1]] = self.first.starts[head] + self.next.used, self.first.sizes[head]
            whole = np.logical_or.reduceat(slot < 0, at[:-1]) if n else whole
        # a text with a piece that cannot stand alone is encoded whole, in the place of its first piece
        own, used = [], self.next.used + self.first.used
        for k in np.flatnonzero(whole):
            ids = self.first.ids(texts[int(k)].as_py()) if len(texts[int(k)].as_py()) else np.zeros(0, self.width)
            size[at[k]:at[k + 1]] = 0
            start[at[k]], size[at[k]] = used, len(ids)
            own.append(ids)
            used += len(ids)
        pool = np.concatenate([self.next.pool[:self.next.used], self.first.pool[:self.first.used], *own,
                               np.array([end], self.width)])
        start, size = np.insert(start, at[1:], used), np.insert(size, at[1:], 1)
        done = np.cumsum(size)
        place = np.repeat(start - (done - size), size)
        place += np.arange(len(place))
        return pool[place], np.diff(done[at[1:] + np.arange(n)], prepend=0)


_encoders: dict[str, Encoder] = {}


def encoder_of(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def tokens(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (ids with the end id), ids (binary)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder_of(tokenizer_path)
        for b in batches:
            _, at = V.buffer(b.column(1))
            for i, j in slices(at, 8 << 20):
                ids, n = enc.encode(b.column(1).slice(i, j - i).fill_null(""), end_id)
                ends = np.concatenate([[0], np.cumsum(n) * ids.itemsize]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), pa.array(n, pa.int64()),
                     pa.Array.from_buffers(pa.binary(), len(n), [None, pa.py_buffer(ends), pa.py_buffer(ids)])],
                    names=["doc_id", "n", "ids"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id bigint, n bigint, ids binary")


def ranks(table: DataFrame, size: int, width: str) -> np.ndarray:
    """The ids of a vocabulary of ``size``, the most frequent in ``table`` first, ties by id."""
    def run(batches):  # counts whole batches; a bincount per text would cost the vocabulary each time
        count = np.zeros(size, np.int64)
        for b in batches:
            c = b.column(0)
            at = np.frombuffer(c.buffers()[1], np.int32)[c.offset:c.offset + len(c) + 1]
            if len(c) and at[-1] > at[0]:
                raw = np.frombuffer(c.buffers()[2], np.uint8)[at[0]:at[-1]]
                count += np.bincount(raw.view(width), minlength=size)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(count[some])], names=["id", "n"])

    got = table.select("ids").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")) \
        .toPandas()
    count = np.zeros(size, np.int64)
    count[got["id"]] = got["n"]
    return np.argsort(-count, kind="stable")


# control byte -> the byte lengths of its four values
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1


def pack(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    v = values.astype(np.uint32)
    size = 1 + (v > 0xFF).astype(np.uint8) + (v > 0xFFFF) + (v > 0xFFFFFF)
    code = np.zeros(-(-len(v) // 4) * 4, np.uint8)
    code[:len(v)] = size - 1
    control = (code.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1).astype(np.uint8)
    raw = v.astype("<u4").view(np.uint8).reshape(-1, 4)
    return control.tobytes(), raw[np.arange(4) < size[:, None]].tobytes()


def unpack(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values: lengths by table lookup, bytes gathered at their offsets."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    at = np.cumsum(size) - size
    raw = np.concatenate([np.frombuffer(data, np.uint8), np.zeros(4, np.uint8)]).astype(np.uint32)
    out = raw[at]
    for k in (1, 2, 3):
        more = np.flatnonzero(size > k)
        out[more] |= raw[at[more] + k] << np.uint32(8 * k)
    return out


BLOCK = "file int, block int, doc_ids array<bigint>, sizes array<bigint>, control binary, data binary"


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, id_col: str = "doc_id",
                      text_col: str = "text", file_ids: int = FILE_IDS) -> None:
    """Write ``path``/blocks and ``path``/ranks."""
    spark = docs.sparkSession
    enc = encoder_of(tokenizer_path)
    width, size = enc.width, max(enc.size, end_id + 1)
    temp = scratch_path(spark, "tokens")
    tokens(docs, tokenizer_path, end_id, id_col, text_col).write.option("compression", "zstd").parquet(temp)
    table = spark.read.schema("doc_id bigint, n bigint, ids binary").parquet(temp)
    by_rank = ranks(table, size, width)
    spark.createDataFrame([(r, int(i)) for r, i in enumerate(by_rank)], "rank int, id int").coalesce(1) \
        .write.parquet(f"{path}/ranks")
    rank_of = np.empty(size, np.uint32)
    rank_of[by_rank] = np.arange(size, dtype=np.uint32)
    shared = spark.sparkContext.broadcast(rank_of)
    files = max(1, -(-(table.agg(F.sum("n")).first()[0] or 0) // file_ids))

    def blocks(batches):
        rank_of = shared.value
        file, number, held, ids = TaskContext.get().partitionId(), 0, [], 0

        def block():
            control, data = pack(rank_of[np.frombuffer(b"".join(h[2] for h in held), width)])
            return pa.RecordBatch.from_arrays(
                [pa.array([file], pa.int32()), pa.array([number], pa.int32()),
                 pa.array([[h[0] for h in held]], pa.list_(pa.int64())),
                 pa.array([[h[1] for h in held]], pa.list_(pa.int64())),
                 pa.array([control], pa.binary()), pa.array([data], pa.binary())],
                names=["file", "block", "doc_ids", "sizes", "control", "data"])

        for b in batches:
            for doc, n, own in zip(*(b.column(k).to_pylist() for k in range(3)), strict=True):
                held.append((doc, n, own))
                ids += held[-1][1]
                if ids >= BLOCK_IDS:
                    yield block()
                    held, ids, number = [], 0, number + 1
        if held:
            yield block()

    # the range is sampled from ids and hashes alone; ranks and codes are made once, after the shuffle
    (table.select("doc_id", "n", "ids", F.xxhash64("ids").alias("tie"))
     .repartitionByRange(files, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
     .mapInArrow(blocks, BLOCK).write.option("compression", "zstd").parquet(f"{path}/blocks"))


def read_token_files(spark, path: str) -> DataFrame:
    """Per document, from the files: doc_id, start, n_tokens, ids (binary, little-endian 32-bit)."""
    by_rank = np.array([r["id"] for r in spark.read.parquet(f"{path}/ranks").orderBy("rank").collect()], np.uint32)
    shared = spark.sparkContext.broadcast(by_rank)
    found = spark.read.schema(BLOCK).parquet(f"{path}/blocks")

    def run(batches):
        by_rank = shared.value
        for b in batches:
            for file, number, docs, sizes, control, data in zip(*b.columns, strict=True):
                n = np.array(sizes.as_py(), np.int64)
                ids = by_rank[unpack(control.as_py(), data.as_py(), int(n.sum()))].astype("<u4").tobytes()
                end = np.cumsum(n)
                k = len(n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([file.as_py()] * k, pa.int32()), pa.array([number.as_py()] * k, pa.int32()),
                     docs.values.cast(pa.int64()), pa.array(end - n), pa.array(n),
                     pa.array([ids[4 * (e - m):4 * e] for e, m in zip(end, n, strict=True)], pa.binary())],
                    names=["file", "block", "doc_id", "inside", "n_tokens", "ids"])

    # ids before each block: a row per block of a million ids, and per file
    total = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x)
    own = written(found.select("file", "block", total.alias("n")), "token_blocks")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # one row per file of 16 million ids meets in one task here
    so_far = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    before = own.groupBy("file").agg(F.sum("n").alias("n")) \
        .select("file", F.coalesce(F.sum("n").over(so_far), F.lit(0)).alias("before"))
    first = own.withColumn("earlier", F.coalesce(F.sum("n").over(earlier), F.lit(0))).join(before, "file") \
        .select("file", "block", (F.col("before") + F.col("earlier")).alias("first"))
    docs = found.mapInArrow(run, "file int, block int, doc_id bigint, inside bigint, n_tokens bigint, ids binary")
    return docs.join(first, ["file", "block"]) \
        .select("doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", "ids")
