"""Ranked lexical search: the best documents of each item by summed term weights, with blocks that are skipped safely.

Items are taken in blocks of at most ITEM_TERMS terms (or one item), whose terms are the vocabulary of
an index over all documents. A document's vector holds an impact per term, which depends on its count and on the
document's length. Vectors go into shards of at most SHARD postings (or one document), rows of the written
index, so a list that many documents share is split over shards whatever its length. In a shard each
term's posting list is clustered by document similarity: sign sketches of the vectors, and as many pivots of the
list as it has blocks of BLOCK documents; every posting goes to its nearest pivot. A block keeps, for each
term that is with the list's term in some item, the largest impact of its documents.

A block's bound for an item is the sum of weight times largest impact over the item's terms: no document of
the block scores more. Blocks go by falling bound, and those below the threshold are skipped. The threshold is the tenth best
score known so far, first from the best blocks of PROBES shards, then in the shard itself; it
can never exceed the true tenth score, so results are exact whatever is probed. Documents of the other
blocks are scored from their vectors. All numbers are integers below 2**53, also inside matrix products.

Terms are named by 64-bit hashes. Defined cases: a null text, or one without terms, matches nothing, and is not counted;
each row is a document and each item row an item, also where ids repeat; a null id comes last among equal scores; an empty
table of documents or items gives no rows; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroframe.llm import vectext as V
from metroframe.llm.common import slices, written
from metroframe.session import scratch_path

# digits, letters and every byte of a character beyond ASCII
LETTERS = np.array([chr(b).isalnum() if b < 128 else True for b in range(256)])
ITEM_TERMS = 1 << 20
SHARD = 1 << 19
BLOCK = 64
FIRST = 8  # blocks an item looks at before it sets its own threshold
PROBES = 64
SKETCH = 32
VECTORS = "doc_id bigint, n bigint, terms binary, counts binary"
# one row per shard; all are little-endian arrays. ptr: where a document's postings start; block_ptr: where a
# block's members start; sum_ptr: where its summary starts
INDEX = ("doc_ids array<bigint>, ptr binary, terms binary, impacts binary, block_term binary, block_ptr binary, members binary, "
         "sum_ptr binary, sum_terms binary, sum_max binary")


def _terms(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(hash, row) of every term of a column of texts."""
    data, bounds = V.buffer(column)
    _, _, hash_, owner = V.words(data, bounds, lower=True, letters=LETTERS)
    return hash_, owner


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """item (a number per row), item_id, terms (distinct hashes), written."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hash_, owner = _terms(b.column(1))
            order = np.lexsort((hash_, owner))
            hash_, owner = hash_[order], owner[order]
            if len(hash_):
                first = np.concatenate([[True], (hash_[1:] != hash_[:-1]) | (owner[1:] != owner[:-1])])
                hash_, owner = hash_[first], owner[first]
            at = np.searchsorted(owner, np.arange(b.num_rows + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.ListArray.from_arrays(pa.array(at), pa.array(hash_.view(np.int64)))], names=["item_id", "terms"])

    rows = items.select(F.col(id_col).cast("bigint").alias("item_id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(run, "item_id bigint, terms array<bigint>")
                   .select(F.monotonically_increasing_id().alias("item"), "*").filter(F.size("terms") > 0), "search_items")


class Items:
    """A block of items: terms as places in a sorted vocabulary, both ways."""

    def __init__(self, rows: pa.Table):
        # by item, so that the same block has the same arrays each time
        rows = rows.sort_by("item").combine_chunks()
        self.key = rows.column("item").to_numpy()
        lists = rows.column("terms").combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        flat = lists.flatten().to_numpy().view(np.uint64)
        self.vocabulary, self.terms = np.unique(flat, return_inverse=True)
        self.ptr = lists.offsets.to_numpy().astype(np.int64)
        self.ptr -= self.ptr[0]
        owner = np.repeat(np.arange(len(self.key)), np.diff(self.ptr))
        by = np.argsort(self.terms, kind="stable")
        self.of_term = owner[by]  # the items of each term
        self.of_ptr = np.searchsorted(self.terms[by], np.arange(len(self.vocabulary) + 1))

    def items_of(self, term: int) -> np.ndarray:
        return self.of_term[self.of_ptr[term]:self.of_ptr[term + 1]]

    def beside(self, term: int) -> np.ndarray:
        """The terms of all items that hold ``term``."""
        return np.unique(np.concatenate([self.terms[self.ptr[i]:self.ptr[i + 1]] for i in self.items_of(term)]))


def vectors(docs: DataFrame, vocabulary: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n (terms with repeats), and places in the vocabulary with counts, of every row; written."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for b in batches:
            _, at = V.buffer(b.column(1))
            for i, j in slices(at):
                hash_, owner = _terms(b.column(1).slice(i, j - i))
                n = np.bincount(owner, minlength=j - i)
                place = np.minimum(np.searchsorted(known, hash_), len(known) - 1)
                hit = known[place] == hash_
                pairs, count = np.unique(owner[hit] * len(known) + place[hit], return_counts=True)
                row, term = np.divmod(pairs, len(known))
                to = np.searchsorted(row, np.arange(j - i + 1)) * 4
                columns = [pa.Array.from_buffers(pa.binary(), j - i, [None, pa.py_buffer(to.astype(np.int32)),
                                                                      pa.py_buffer(x.astype("<i4"))]) for x in (term, count)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), pa.array(n), *columns],
                                                 names=["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return written(rows.mapInArrow(run, VECTORS), "search_vectors")


def _ints(column: pa.Array, kind: str = "<i4") -> tuple[np.ndarray, np.ndarray]:
    """The numbers of a binary column, and where each row's start."""
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[at[0]:at[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw.view(kind), (at - at[0]) // np.dtype(kind).itemsize


def statistics(table: DataFrame, size: int) -> tuple[int, int, np.ndarray]:
    """N (documents with a term), L (all their terms), df of each place of the vocabulary."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(size, np.int64)
        for b in batches:
            df += np.bincount(_ints(b.column(0))[0], minlength=size)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "df"])

    counted = table.select("terms").mapInArrow(run, "term bigint, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    df = np.zeros(size, np.int64)
    df[counted.column("term").to_numpy()] = counted.column("df").to_numpy()
    n, length = table.filter("n > 0").agg(F.count("*"), F.sum("n")).first()
    return n, length or 0, df


def weights(n: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)


def _sketch(terms: np.ndarray, mass: np.ndarray, ptr: np.ndarray) -> np.ndarray:
    """A unit vector of SKETCH numbers per document: its masses with the signs of their terms' hashes."""
    out = np.zeros((len(ptr) - 1, SKETCH), np.float32)
    bit = np.arange(SKETCH, dtype=np.uint64)
    step = 1 << 16
    for k in range(0, len(terms), step):
        part = slice(k, k + step)
        signs = ((V.mix(terms[part].astype(np.uint64) + np.uint64(1))[:, None] >> bit) & np.uint64(1)).astype(np.float32) * 2 - 1
        owner = np.searchsorted(ptr, np.arange(k, k + len(signs)), side="right") - 1
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        out[owner[first]] += np.add.reduceat(signs * mass[part, None].astype(np.float32), first, axis=0)
    return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-9)


def _spread(ptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of the entries of ``rows``, which of ``rows`` each belongs to) for entries that start at ``ptr``."""
    size = ptr[rows + 1] - ptr[rows]
    place = np.repeat(ptr[rows] - (np.cumsum(size) - size), size)
    place += np.arange(len(place))
    return place, np.repeat(np.arange(len(rows)), size)


def _shard(ids: list, ptr: np.ndarray, terms: np.ndarray, impacts: np.ndarray, items: Items, weight: np.ndarray) -> pa.RecordBatch:
    """The index row of one shard."""
    docs = np.repeat(np.arange(len(ids)), np.diff(ptr))
    by = np.argsort(terms, kind="stable")
    listed, postings = terms[by], docs[by]
    starts = np.flatnonzero(np.diff(listed, prepend=-1))
    sketch = _sketch(terms, weight[terms] * impacts, ptr)
    column = np.full(len(weight), -1)
    block_term, sizes, members, sum_sizes, sum_terms, sum_max = [], [], [], [], [], []
    for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(listed)], strict=True):
        term, own = int(listed[lo]), postings[lo:hi]
        label = np.zeros(hi - lo, np.int64)
        if hi - lo > BLOCK:
            pivots = own[np.argsort(V.mix((own + 1).astype(np.uint64) * np.uint64(term + 1)))[:-(-(hi - lo) // BLOCK)]]
            label = np.unique(np.argmax(sketch[own] @ sketch[pivots].T, axis=1), return_inverse=True)[1]
            order = np.argsort(label, kind="stable")
            own, label = own[order], label[order]
        blocks = int(label[-1]) + 1
        beside = items.beside(term)
        column[beside] = np.arange(len(beside))
        place, row = _spread(ptr, own)
        col = column[terms[place]]
        keep = col >= 0
        table = np.zeros(blocks * len(beside), np.int64)
        np.maximum.at(table, label[row[keep]] * len(beside) + col[keep], impacts[place[keep]])
        column[beside] = -1
        some = np.flatnonzero(table)
        block, col = np.divmod(some, len(beside))
        block_term.append(np.full(blocks, term))
        sizes.append(np.bincount(label, minlength=blocks))
        members.append(own)
        sum_sizes.append(np.bincount(block, minlength=blocks))
        sum_terms.append(beside[col])
        sum_max.append(table[some])
    flat = lambda parts: np.concatenate([np.zeros(0, np.int64), *parts]).astype("<i4")
    until = lambda parts: np.concatenate([[0], np.cumsum(flat(parts))]).astype("<i8")
    values = [ptr.astype("<i8"), terms.astype("<i4"), impacts.astype("<i4"), flat(block_term), until(sizes), flat(members),
              until(sum_sizes), flat(sum_terms), flat(sum_max)]
    return pa.RecordBatch.from_arrays([pa.array([ids], pa.list_(pa.int64())), *[pa.array([v.tobytes()], pa.binary()) for v in values]],
                                      names=["doc_ids", "ptr", "terms", "impacts", "block_term", "block_ptr", "members", "sum_ptr",
                                             "sum_terms", "sum_max"])


def build_index(table: DataFrame, items: Items, n: int, length: int, weight: np.ndarray) -> DataFrame:
    """The index over ``vectors``, for a block of items, written: shard, and the arrays of INDEX."""
    shared = table.sparkSession.sparkContext.broadcast((items, weight))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight = shared.value
        held, size = [], 0
        for b in batches:
            (terms, at), (counts, _) = _ints(b.column(2)), _ints(b.column(3))
            words = b.column(1).to_numpy()
            m = 10 + (90 * words * n) // max(length, 1)
            impacts = (1_000_000_000 * counts.astype(np.int64)) // (1000 * counts + 8 * np.repeat(m, np.diff(at)))
            ids, i = b.column(0).to_pylist(), 0
            while i < len(ids):
                j = int(np.searchsorted(at, at[i] + SHARD - size, side="right")) - 1
                if j <= i and held:
                    yield _joined(held, items, weight)
                    held, size = [], 0
                    continue
                j = max(j, i + 1)
                part = slice(int(at[i]), int(at[j]))
                held.append((ids[i:j], np.diff(at[i:j + 1]), terms[part].copy(), impacts[part]))
                size += int(at[j] - at[i])
                i = j
        if held:
            yield _joined(held, items, weight)

    def _joined(held, items, weight):
        ids, sizes, terms, impacts = zip(*held, strict=True)
        ptr = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        return _shard([x for part in ids for x in part], ptr, np.concatenate(terms), np.concatenate(impacts), items, weight)

    path = scratch_path(table.sparkSession, "search_index")
    rows = (table.filter(F.octet_length("terms") > 0).mapInArrow(run, INDEX)
            .select(F.monotonically_increasing_id().alias("shard"), "*"))
    # a reader holds the rows of a file at once: two shards, whatever the size of the corpus
    rows.write.option("compression", "zstd").option("maxRecordsPerFile", 2).parquet(path)
    return table.sparkSession.read.schema(rows.schema).parquet(path)


class _Shard:
    """An index row, opened."""

    def __init__(self, b: pa.RecordBatch, row: int):
        one = {name: b.column(b.schema.get_field_index(name))[row] for name in b.schema.names}
        wide = {"ptr", "block_ptr", "sum_ptr"}
        for name in ("ptr", "terms", "impacts", "block_term", "block_ptr", "members", "sum_ptr", "sum_terms", "sum_max"):
            setattr(self, name, np.frombuffer(one[name].as_py(), "<i8" if name in wide else "<i4").astype(np.int64))
        self.ids = one["doc_ids"].values

    def bounds(self, items: Items, weight: np.ndarray) -> dict[int, list[tuple[np.ndarray, np.ndarray]]]:
        """For each item with a term here: (bounds, blocks) of each of its terms' lists."""
        out: dict[int, list] = {}
        starts = np.flatnonzero(np.diff(self.block_term, prepend=-1))
        column = np.full(len(weight), -1)
        for lo, hi in zip(starts.tolist(), [*starts[1:].tolist(), len(self.block_term)], strict=True):
            of = items.items_of(int(self.block_term[lo]))
            part = slice(int(self.sum_ptr[lo]), int(self.sum_ptr[hi]))
            terms = np.unique(self.sum_terms[part])
            column[terms] = np.arange(len(terms))
            table = np.zeros((hi - lo, len(terms)))
            table[np.repeat(np.arange(hi - lo), np.diff(self.sum_ptr[lo:hi + 1])), column[self.sum_terms[part]]] = self.sum_max[part]
            want = np.zeros((len(terms), len(of)))
            for k, i in enumerate(of.tolist()):
                own = items.terms[items.ptr[i]:items.ptr[i + 1]]
                own = own[column[own] >= 0]
                want[column[own], k] = weight[own]
            column[terms] = -1
            bound = table @ want
            for k, i in enumerate(of.tolist()):
                out.setdefault(i, []).append((bound[:, k].astype(np.int64), np.arange(lo, hi)))
        return out

    def scores(self, docs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of ``docs`` for the weights ``wanted`` (0 for terms that the item lacks)."""
        place, row = _spread(self.ptr, docs)
        value = wanted[self.terms[place]] * self.impacts[place]
        return np.add.reduceat(value, np.flatnonzero(np.diff(row, prepend=-1))) if len(row) else np.zeros(0, np.int64)

    def best(self, docs: np.ndarray, score: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
        ids = self.ids.take(pa.array(docs))
        order = np.lexsort((ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False), -score))[:top]
        return docs[order], score[order]


def _search(index: DataFrame, items: Items, weight: np.ndarray, threshold: np.ndarray, top: int, probe: bool = False) -> DataFrame:
    """item, doc_id, score: of every shard the ``top`` documents of each item that reach its threshold.

    With ``probe`` only the first blocks of each shard are looked at.
    """
    shared = index.sparkSession.sparkContext.broadcast((items, weight, threshold))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weight, threshold = shared.value
        wanted = np.zeros(len(weight), np.int64)
        for b in batches:
            for row in range(b.num_rows):
                shard, out = _Shard(b, row), []
                for i, parts in shard.bounds(items, weight).items():
                    bound, block = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
                    least = max(int(threshold[i]), 1)
                    order = np.argsort(-bound, kind="stable")
                    order = order[bound[order] >= least]
                    own = items.terms[items.ptr[i]:items.ptr[i + 1]]
                    wanted[own] = weight[own]
                    docs, score = np.zeros(0, np.int64), np.zeros(0, np.int64)
                    for part in (order[:FIRST], order[FIRST:]):
                        part = part[bound[part] >= least]
                        if not len(part):
                            break
                        fresh = np.setdiff1d(shard.members[_spread(shard.block_ptr, block[part])[0]], docs)
                        docs, score = np.concatenate([docs, fresh]), np.concatenate([score, shard.scores(fresh, wanted)])
                        if len(score) >= top:
                            least = max(least, int(np.partition(score, -top)[-top]))
                        if probe:
                            break
                    wanted[own] = 0
                    docs, score = docs[score >= least], score[score >= least]
                    docs, score = shard.best(docs, score, top)
                    if len(docs):
                        out.append((np.full(len(docs), items.key[i]), shard.ids.take(pa.array(docs)), score))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([o[0] for o in out])),
                                                      pa.concat_arrays([o[1] for o in out]),
                                                      pa.array(np.concatenate([o[2] for o in out]))], names=["item", "doc_id", "score"])

    return index.mapInArrow(run, "item bigint, doc_id bigint, score bigint")


def _ranked(hits: DataFrame, top: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    return hits.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)


def search(docs: DataFrame, items: DataFrame, top: int = 10, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", item_terms_limit: int = ITEM_TERMS) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the ``top`` documents of each item with a score above 0."""
    spark = docs.sparkSession
    asked = item_terms(items, item_col, item_text_col)
    total = asked.agg(F.sum(F.size("terms"))).first()[0] or 0
    parts = -(-total // item_terms_limit)
    out = spark.createDataFrame([], "item bigint, rank int, doc_id bigint, score bigint")
    for part in range(parts):
        own = asked.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
        block = Items(own.select("item", "terms").toArrow())
        if len(block.key):
            out = out.unionByName(_search_block(docs, block, top, id_col, text_col))
    return out.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _search_block(docs: DataFrame, items: Items, top: int, id_col: str, text_col: str) -> DataFrame:
    table = vectors(docs, items.vocabulary, id_col, text_col)
    n, length, df = statistics(table, len(items.vocabulary))
    weight = weights(n, df)
    index = build_index(table, items, n, length, weight)
    some = [r[0] for r in index.select("shard").orderBy(F.xxhash64("shard")).limit(PROBES).collect()]
    none = np.zeros(len(items.key), np.int64)
    probed = _ranked(_search(index.filter(F.col("shard").isin(some)), items, weight, none, top, probe=True), top)
    tenth = probed.filter(F.col("rank") == top).select("item", "score").toArrow()  # a row per item at most
    none[np.searchsorted(items.key, tenth.column("item").to_numpy())] = tenth.column("score").to_numpy()
    return _ranked(written(_search(index, items, weight, none, top), "search_hits"), top)
