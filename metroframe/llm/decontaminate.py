"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit distance.

Texts and items become lower-cased words of letters and digits. An item of L words
leaks into a document when some stretch of it is within L // 5 word edits (none
for items under 6 words). Items over ``PIECE`` words are cut into even pieces of
``PIECE`` words at most: of a match's edits some piece of m words has m // 5 or fewer,
so it is enough to find each piece at its own limit, whatever the item's length.
Pieces fall into length classes; a document's windows have the class's length and
start at every word. A piece has m - 2 rows of three words, and an edit changes three
of them at most, so a stretch that matches holds m - 2 - 3 (m // 5) of them; windows
that hold fewer rows of three words of any item, with a margin, are not embedded.

The CGK random walk copies the word under its pointer at each step and moves the
pointer on by a random bit of (walk, step, word): texts at a small edit distance
give strings at a small Hamming distance. Each of ``WALKS`` walks is sampled
``SAMPLES`` times at ``TAKEN`` places; a window and a piece that agree in one sample
are a candidate. Recall at the limit of edits is aimed at 0.99 for every length and kind of edit
(tests hold it). Candidates are verified by the exact edit distance of the whole item to the best
stretch of the text around the window.

Items whose words or samples fit nothing cost nothing; their samples go through a bit
filter of a fixed size to the windows, then through a join, so neither side need be
small.

Defined cases: null or empty texts have no words and match nothing, nor do items under
five words; equal rows give equal results (one row per doc_id and item_id, the best); rows
without an id are not reported; other columns are not read.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroframe.llm import vectext as V
from metroframe.llm.common import bit_filter, may_hold, slices, written

GRAM = 3
MIN_WORDS = 5
GROWTH = 1.15  # from one length class to the next
PIECE = 24  # words in a piece of an item at most
WALKS = 8
SAMPLES = 16
TAKEN = 4
SEED = 7
U = np.uint64
LETTERS = np.zeros(256, bool)
LETTERS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
ITEM = "item_id bigint, class int, offset int, length int, item array<bigint>, keys array<bigint>, grams array<bigint>"
REGION = ("region bigint, doc_id bigint, first bigint, words array<bigint>, class array<int>, start array<bigint>, "
          "key array<bigint>")


def edits_of(length: int) -> int:
    return 0 if length < 6 else length // 5


def class_of(length: int) -> int:
    """The length class: its longest items have ``class_length`` words."""
    k, top = 0, MIN_WORDS
    while top < length:
        k, top = k + 1, max(top + 1, int(top * GROWTH))
    return k


def class_length(k: int) -> int:
    top = MIN_WORDS
    for _ in range(k):
        top = max(top + 1, int(top * GROWTH))
    return top


def pieces(length: int) -> list[tuple[int, int]]:
    """(offset, words) of the even pieces of an item, of ``PIECE`` words at most."""
    n = -(-length // PIECE)
    at = [i * length // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(at, at[1:])]


SLACK = class_length(class_of(PIECE))  # words a window may be off the place of its piece


def least_grams(k: int) -> int:
    """Rows of ``GRAM`` words that any match of a piece of class ``k`` leaves unchanged."""
    lengths = range(class_length(k - 1) + 1 if k else MIN_WORDS, class_length(k) + 1)
    return min(n - GRAM + 1 - GRAM * edits_of(n) for n in lengths)


def places(k: int) -> np.ndarray:
    """The sampled steps, [walk, sample, taken], the same for all texts of a class."""
    shortest = class_length(k - 1) + 1 if k else MIN_WORDS
    # after s steps the pointer stands near s / 2: the steps of a shortest piece
    return np.random.default_rng([SEED, k]).integers(0, 2 * shortest - 2, (WALKS, SAMPLES, TAKEN))


@functools.cache
def _turns(steps: int) -> np.ndarray:
    """An odd number per [step, walk, 1]; the top bit of its product with a word moves the pointer."""
    return V.mix(np.arange(1, steps * WALKS + 1, dtype=U)).reshape(steps, WALKS, 1) | U(1)


def signatures(words: np.ndarray, start: np.ndarray, size: np.ndarray, k: int) -> np.ndarray:
    """Sample names, [window, walk * SAMPLES + sample], of the windows of ``size`` words at ``start``."""
    chosen = np.sort(places(k), axis=2)
    steps = int(chosen.max()) + 1
    padded, n = np.concatenate([words, np.zeros(1, U)]), len(start)
    at = np.broadcast_to(start, (WALKS, n)).copy()
    end = start + size
    seen = np.empty((steps, WALKS, n), U)
    turns = _turns(steps)
    for step in range(steps):
        word = padded[np.where(at < end, at, len(words))]
        seen[step] = word
        at += ((word * turns[step]) >> U(63)).astype(np.int64)
    name = (np.arange(1, WALKS * SAMPLES + 1, dtype=U) + U(k * WALKS * SAMPLES)).reshape(WALKS, SAMPLES, 1)
    for t in range(TAKEN):
        name = V.mix(name) + seen[chosen[:, :, t], np.arange(WALKS)[:, None]]
    return V.mix(name).reshape(WALKS * SAMPLES, n).T


def tokens(column):
    """(word hashes, first word of each text and the end, offset) per slice of a string column."""
    data, at = V.buffer(column)
    for i, j in slices(at):
        _, _, hash_, owner = V.words(data[at[i]:at[j]], at[i:j + 1] - at[i], lower=True, letters=LETTERS)
        yield i, hash_, np.searchsorted(owner, np.arange(j - i + 1))


def best_edits(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """(least edits of ``item`` to a stretch of ``text``, end of that stretch)."""
    row = np.zeros(len(text) + 1, np.int64)
    rising = np.arange(len(text) + 1)
    for n, word in enumerate(item, 1):
        new = np.empty_like(row)
        new[0] = n
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != word))
        row = np.minimum.accumulate(new - rising) + rising
    end = int(np.argmin(row))
    return int(row[end]), end


def _items(batches):
    for b in batches:
        for i, words, first in tokens(b.column(1)):
            for d in range(len(first) - 1):
                own = words[first[d]:first[d + 1]]
                if len(own) < MIN_WORDS:
                    continue
                grams = np.unique(V.shingles(own, GRAM)).astype(np.int64)
                item_id = b.column(0)[i + d].as_py()
                for offset, size in pieces(len(own)):
                    k = class_of(size)
                    keys = np.unique(signatures(own, np.array([offset]), np.array([size]), k)).astype(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([item_id], pa.int64()),
                         *(pa.array([x], pa.int32()) for x in (k, offset, len(own))),
                         # the item's words travel with its first piece only
                         *(pa.array([x], pa.list_(pa.int64())) for x in (
                             None if offset else own.astype(np.int64), keys, None if offset else grams))],
                        names=["item_id", "class", "offset", "length", "item", "keys", "grams"])


def _candidates(grams: np.ndarray, keys: np.ndarray, reach: dict[int, tuple[int, int]]):
    """Stretches of the documents around windows that may hold a piece, with these windows' samples.

    ``reach`` has the words that an item may take before and after the start of a window, for each class.
    """
    def run(batches):
        for b in batches:
            ids = b.column(0)
            for i, words, first in tokens(b.column(1)):
                hit = np.zeros(len(words), np.int64)
                rolled = V.shingles(words, GRAM)
                hit[:len(rolled)] = may_hold(grams, rolled)
                before = np.concatenate([[0], np.cumsum(hit)])
                found = [part for k in reach for part in _of_class(words, first, before, keys, k)]
                if found:
                    yield _regions(ids, i, words, first, reach, *map(np.concatenate, zip(*found, strict=True)))
    return run


def _of_class(words, first, before, keys, k):
    """(class, start, key) of windows of class ``k`` that hold enough rows of words of items, of samples that may be a piece's."""
    size, enough = class_length(k), least_grams(k)
    some = np.flatnonzero(before[first[1:]] - before[first[:-1]] >= enough)
    count = first[some + 1] - first[some]
    start = np.repeat(first[some], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    # a match that starts beside the window, with its insertions
    low = np.maximum(start - 1, np.repeat(first[some], count))
    high = np.minimum(start + 1 + size + edits_of(size), np.repeat(first[some + 1], count))
    start = start[before[high] - before[low] >= enough]
    for a in range(0, len(start), 10_000):
        part = start[a:a + 10_000]
        end = np.minimum(part + size, first[np.searchsorted(first, part, side="right")])
        names = signatures(words, part, end - part, k)
        row, col = np.nonzero(may_hold(keys, names.reshape(-1)).reshape(names.shape))
        if len(row):
            yield np.full(len(row), k, np.int32), part[row], names[row, col].astype(np.int64)


def _regions(ids, i, words, first, reach, class_, start, key):
    """One row for each run of words in reach of windows; overlapping reaches are one run."""
    order = np.lexsort((class_, start))
    class_, start, key = class_[order], start[order], key[order]
    own = np.searchsorted(first, start, side="right") - 1
    back, on = (np.array([reach.get(k, (0, 0))[side] for k in range(max(reach) + 1)]) for side in (0, 1))
    low = np.maximum(start - back[class_], first[own])
    high = np.maximum.accumulate(np.minimum(start + on[class_], first[own + 1]))
    # windows reach back by their class, so a run begins where no later window reaches into the one before
    low = np.minimum.accumulate(low[::-1])[::-1]
    begin = np.concatenate([[0], np.flatnonzero((low[1:] >= high[:-1]) | (own[1:] != own[:-1])) + 1])
    stop = np.concatenate([begin[1:], [len(start)]])
    at, to, doc = np.maximum(low[begin], first[own[begin]]), np.minimum(high[stop - 1], first[own[begin] + 1]), own[begin]
    doc_id = ids.take(pa.array(i + doc)).cast(pa.int64())
    place = at - first[doc]
    name = [V.mix(V.mix(words[a:b] + np.arange(b - a, dtype=U)).sum(keepdims=True) + U(p) + V.mix(
        np.array([d], np.int64).view(U)))[0] for a, b, p, d in zip(at, to, place, doc_id.to_pylist(), strict=True)]
    lists = lambda x: pa.array([x[a:b] for a, b in zip(begin, stop, strict=True)],
                               pa.list_(pa.from_numpy_dtype(x.dtype)))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array(name, U).view(np.int64)), doc_id, pa.array(place),
         pa.array([words[a:b].astype(np.int64) for a, b in zip(at, to, strict=True)], pa.list_(pa.int64())),
         lists(class_), lists(start - first[own]), lists(key)],
        names=["region", "doc_id", "first", "words", "class", "start", "key"])


def _verify(batches):
    for b in batches:
        doc, item, edits, end = [], [], [], []
        for d, i, words, own, start in zip(*b.columns, strict=True):
            own = np.array(own.as_py(), np.int64)
            n, e = best_edits(own, np.array(words.as_py(), np.int64))
            if n <= edits_of(len(own)):
                doc.append(d.as_py())
                item.append(i.as_py())
                edits.append(n)
                end.append(start.as_py() + e)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, item, edits, end)],
                                         names=["doc_id", "item_id", "edits", "end_word"])


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, edits, end_word): benchmark items found in documents, the best stretch of each."""
    pick = lambda df, i, t: df.select(F.col(i).cast("bigint").alias("id"), F.col(t).cast("string").alias("text"))
    cut = written(pick(benchmark, item_col, item_text_col).filter("id is not null and text is not null")
                  .mapInArrow(_items, ITEM), "leak_items")
    items = cut.filter("item is not null").select("item_id", "length", "item")
    keyed = cut.select("item_id", "class", "offset", "length", F.explode("keys").alias("key"))
    grams = bit_filter(cut.select(F.explode("grams").alias("g")), "g")
    keys = bit_filter(keyed, "key")
    length = F.col("length")
    edits = F.when(length < 6, 0).otherwise(F.floor(length / 5))
    # pieces have some twenty classes, whatever the length of their items
    reach = {r[0]: (r[1], r[2]) for r in cut.groupBy("class").agg(
        F.max(F.col("offset") + edits + SLACK), F.max(length - F.col("offset") + 2 * edits + SLACK)).orderBy("class").collect()}
    found = written(pick(docs, id_col, text_col).filter("id is not null")
                    .mapInArrow(_candidates(grams, keys, reach), REGION), "leak_regions")
    # a window tells where its item would start; starts in one cell are verified together
    cell = F.greatest(length, F.lit(SLACK))
    near = (found.select("region", F.explode(F.arrays_zip("class", "start", "key")).alias("w")).select("region", "w.*")
            .join(keyed, ["class", "key"])
            .select("region", "item_id", "length", F.floor((F.col("start") - F.col("offset")) / cell).alias("cell")).distinct())
    regions = found.groupBy("region").agg(*[F.first(c).alias(c) for c in ("doc_id", "first", "words")])
    start = F.greatest(F.col("cell") * cell - edits - SLACK, F.col("first"))
    end = (F.col("cell") + 1) * cell + length + 2 * edits + SLACK
    checked = (near.join(regions, "region")
               .select("doc_id", "item_id", "length", start.alias("start"),
                       F.slice("words", (start - F.col("first") + 1).cast("int"),
                               F.greatest(end - start, F.lit(0)).cast("int")).alias("words"))
               .join(items, ["item_id", "length"]).select("doc_id", "item_id", "words", "item", "start")
               .mapInArrow(_verify, "doc_id bigint, item_id bigint, edits bigint, end_word bigint"))
    best = Window.partitionBy("doc_id", "item_id").orderBy("edits", "end_word")
    return checked.withColumn("n", F.row_number().over(best)).filter("n = 1").drop("n")
