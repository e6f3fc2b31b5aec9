"""Alignment of two tokenizers over the same bytes, and counts of the id pairs that overlap.

A byte-level vocabulary (A) encodes a space and the text, a piece vocabulary (B), which puts the space
itself, the text. Both give ends, as byte offsets; where two ends coincide both can be cut. The
cuts are found by divide and conquer: from the middle A end of an interval, bisection steps from the ends of one
side to the next ends of the other until two are equal, first to the right, then to the left; then both
halves go on alike. An interval without a cut is one group. What a walk has passed without finding a cut
is left out of the halves, so each end is passed a bounded number of times. All intervals of a
level, over all texts of a step, are halved at once in numpy.

Both sides cut before a single space between two other characters, so there a word with the space before it
is aligned on its own: a task aligns each different word once, remembers a bounded number of them, and joins
their results to those of a text. A text with another word (empty, with white space at an end, with U+2581,
very long, or not given back by the bytes of both sides) is aligned whole.

A link is a pair of an A and a B token whose byte ranges overlap: one for each stretch between
neighbouring ends of either side. Pairs of ids are counted per task, then over the corpus. The FREQUENT
commonest pairs (of a fixed number, 9 MB) go to every task with their counts; a document's other pairs are joined with the table
of counts by a shuffle, in which no pair can have more than one link in FREQUENT of the corpus.

Defined cases: a text that is null, empty, or not given back by the bytes of both sides (the piece side writes
U+2581 as a space) has no tokens; equal rows get equal results, each counted; rows without an id
are treated like others; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroframe.llm import vectext as V
from metroframe.llm.common import slices
from metroframe.llm.token_files import NEW, _Pieces
from metroframe.session import scratch_path

FREQUENT = 1 << 19
COMPACT = 4_000_000  # pairs a task holds before it merges equal ones
EMIT = 1_000_000
WORDS = 700_000  # words a worker remembers
WORD_LENGTH = 256  # a text with a longer one is aligned whole


def byte_letters() -> dict[str, int]:
    """The byte for each character of a byte-level vocabulary: printable ones are themselves, the others follow U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class _Table:
    """Strings of bytes by id, joined by numpy."""

    def __init__(self, raw: list[bytes]):
        self.size = np.array([len(r) for r in raw], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.pool = np.frombuffer(b"".join(raw), np.uint8)

    def joined(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        place = np.repeat(self.start[ids] - (np.cumsum(size) - size), size)
        place += np.arange(len(place))
        return self.pool[place].tobytes()


class TokenizerPair:
    """A byte-level tokenizers file (A) and a sentencepiece model with byte fallback (B)."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import json

        import sentencepiece
        import tokenizers

        self.tok = tokenizers.Tokenizer.from_file(byte_path)
        self.tok.encode_special_tokens = True  # their strings are plain text
        kind = json.loads(self.tok.to_str())
        pre = kind["pre_tokenizer"] or {}
        # the byte-level pattern always cuts before a single space between two other characters
        self.cuts = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not kind["normalizer"] and not pre.get("add_prefix_space")
        self.model = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        letters = byte_letters()
        vocabulary = {i: t for t, i in self.tok.get_vocab().items()}
        a = [bytes(letters[c] for c in t) if all(c in letters for c in t) else t.encode()
             for t in (vocabulary.get(i, "") for i in range(max(vocabulary) + 1))]
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        b = [bytes([int(p[1:-1], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.a, self.b = _Table(a), _Table(b)
        self.width_a, self.width_b = ("<u2" if len(x) <= 1 << 16 else "<u4" for x in (a, b))
        self.pieces = _Pieces(self.tok, self.width_a, " ")
        # no piece goes on after a space, and none is broken at one
        self.words = _Words(self) if self.cuts and not any("▁" in p.lstrip("▁") for p in pieces) else None
        decimal = [str(i).encode() for i in range(max(len(a), len(b)))]
        wide = max(map(len, decimal)) + 1
        self.decimal = np.frombuffer(b"".join(d.ljust(wide) for d in decimal), np.uint8).reshape(-1, wide)
        self.digits = np.array([len(d) for d in decimal])

    def encode_a(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of a space and each text, how many ids each has)."""
        lists = pc.split_pattern(texts, " ")
        at = lists.offsets.to_numpy().astype(np.int64)
        at, flat = at - at[0], lists.flatten()
        if self.cuts:
            found = flat.dictionary_encode()
            slot = self.pieces.slots(found.dictionary.to_pylist())[found.indices.to_numpy()]
            start, size = self.pieces.starts[slot], self.pieces.sizes[slot]
            whole = np.logical_or.reduceat(slot < 0, at[:-1])
        else:
            start, size, whole = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64), np.ones(len(texts), bool)
        own, used = [], self.pieces.used
        odd = np.flatnonzero(whole).tolist()
        for k, ids in zip(odd, self.pieces.each([" " + texts[k].as_py() for k in odd]) if odd else [], strict=True):
            size[at[k]:at[k + 1]] = 0
            start[at[k]], size[at[k]] = used, len(ids)
            own.append(ids)
            used += len(ids)
        pool = np.concatenate([self.pieces.pool[:self.pieces.used], *own])
        done = np.cumsum(size)
        place = np.repeat(start - (done - size), size)
        place += np.arange(len(place))
        return pool[place], np.add.reduceat(size, at[:-1])

    def encode_b(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode(texts.to_pylist(), num_threads=1)
        n = np.fromiter(map(len, found), np.int64, len(found))
        return np.fromiter(chain.from_iterable(found), self.width_b, int(n.sum())), n


class _Words:
    """Aligned words, each with a space before it: the columns of :func:`_whole`, a row per word, in buffers that grow."""

    def __init__(self, pair: TokenizerPair):
        self.pair = pair
        self.forget()

    def forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.known = 0
        self.data = [np.zeros(1 << 16, np.uint8) for _ in range(4)]
        self.ends = [np.zeros(1 << 12, np.int32) for _ in range(4)]

    def slots(self, keys: list[str]) -> np.ndarray:
        """The row of each word (all different), -1 for one that cannot stand alone; new ones are aligned together."""
        got = np.fromiter(map(self.slot.get, keys, repeat(NEW)), np.int64, len(keys))
        new = np.flatnonzero(got == NEW).tolist()
        if new and len(self.slot) + len(new) > WORDS:
            self.forget()
            new = range(len(keys))
        if new:
            got[new] = self._learn([keys[i] for i in new])
        return got

    def _learn(self, words: list[str]) -> np.ndarray:
        got = np.full(len(words), -1)
        alone = [k for k, w in enumerate(words) if w and len(w) <= WORD_LENGTH and w == w.strip() and "▁" not in w]
        if alone:
            columns = _whole(self.pair, pa.array([words[k] for k in alone], pa.string()))
            same = np.diff(_binary(columns[0])[1]) > 0
            got[np.array(alone)[same]] = np.arange(self.known, self.known + int(same.sum()))
            for c, column in enumerate(columns):
                self._add(c, *_binary(column.filter(pa.array(same))))
            self.known += int(same.sum())
        self.slot.update(zip(words, got.tolist(), strict=True))
        return got

    def _add(self, c: int, raw: np.ndarray, at: np.ndarray) -> None:
        used, end = int(self.ends[c][self.known]), self.known + len(at)
        if used + len(raw) > len(self.data[c]):
            self.data[c] = np.concatenate([self.data[c][:used], np.zeros(used + 2 * len(raw), np.uint8)])
        if end > len(self.ends[c]):
            self.ends[c] = np.concatenate([self.ends[c], np.zeros(end, np.int32)])
        self.data[c][used:used + len(raw)] = raw
        self.ends[c][self.known:end] = used + at

    def column(self, c: int) -> pa.Array:
        ends = self.ends[c][:self.known + 1]
        return pa.Array.from_buffers(pa.binary(), self.known, [None, pa.py_buffer(ends), pa.py_buffer(self.data[c][:ends[-1]])])


_pairs: dict[tuple[str, str], TokenizerPair] = {}


def pair_of(byte_path: str, piece_path: str) -> TokenizerPair:
    key = byte_path, piece_path
    if key not in _pairs:
        _pairs[key] = TokenizerPair(*key)
    return _pairs[key]


def common_cuts(ea: np.ndarray, eb: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places in ``ea`` of the ends that ``eb`` has too, by halving the ranges ``first`` to ``last`` of places.

    The end at ``last`` (the range's own) is in both and is not looked at; it is not in the result.
    """
    found = []
    lo, hi = first, last
    while len(lo := lo[keep := lo < hi]):
        hi = hi[keep]
        mid = (lo + hi - 1) // 2
        cut = np.full(len(lo), -1)
        walk, at = np.arange(len(lo)), mid.copy()
        while len(walk):  # to the right: the next end of one side, then of the other, until two are equal
            other = eb[np.searchsorted(eb, ea[at])]
            equal = other == ea[at]
            cut[walk[equal]] = at[equal]
            walk, at = walk[~equal], np.searchsorted(ea, other[~equal])
            inside = at < hi[walk]
            walk, at = walk[inside], at[inside]
        right = cut >= 0
        walk = np.flatnonzero(~right)
        at = mid[walk]
        while len(walk):  # to the left
            j = np.searchsorted(eb, ea[at], side="right") - 1
            walk, j = walk[j >= 0], j[j >= 0]
            at = np.searchsorted(ea, eb[j], side="right") - 1
            inside = at >= lo[walk]
            walk, j, at = walk[inside], j[inside], at[inside]
            equal = ea[at] == eb[j]
            cut[walk[equal]] = at[equal]
            walk, at = walk[~equal], at[~equal]
        some = cut >= 0
        found.append(cut[some])
        # nothing lies between the middle and a cut to its right, nor between a cut to its left and the range's end
        lo, hi = (np.concatenate([lo[some], cut[right] + 1]), np.concatenate([np.minimum(mid, cut)[some], hi[right]]))
    return np.sort(np.concatenate(found)) if found else np.zeros(0, np.int64)


def _aligned(pair: TokenizerPair, texts: pa.Array) -> list[pa.Array]:
    """:func:`_whole` for texts that are neither null nor empty, by their words where these can stand alone."""
    if pair.words is None:
        return _whole(pair, texts)
    lists = pc.split_pattern(texts, " ")
    at = lists.offsets.to_numpy().astype(np.int64)
    at, found = at - at[0], lists.flatten().dictionary_encode()
    slot = pair.words.slots(found.dictionary.to_pylist())[found.indices.to_numpy()]
    odd = np.logical_or.reduceat(slot < 0, at[:-1])
    rest = _whole(pair, texts.filter(pa.array(odd))) if odd.any() else None
    plain = pa.array(slot[~np.repeat(odd, np.diff(at))])
    to = np.concatenate([[0], np.cumsum(np.diff(at)[~odd])])
    out = []
    for c in range(4):
        raw, ends = _binary(pair.words.column(c).take(plain))
        column = _column(raw, ends[to])
        if rest is not None:
            order = np.empty(len(texts), np.int64)
            order[np.concatenate([np.flatnonzero(~odd), np.flatnonzero(odd)])] = np.arange(len(texts))
            column = pa.concat_arrays([column, rest[c]]).take(pa.array(order))
        out.append(column)
    return out


def _column(raw, ends) -> pa.Array:
    """A binary column of the bytes between the ends (from 0)."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(raw)])


def _whole(pair: TokenizerPair, texts: pa.Array) -> list[pa.Array]:
    """a_ids, b_ids and sizes of :func:`align`, and the written groups with a ``;`` at the end, for texts that are neither null nor
    empty; nothing for texts that are not given back."""
    ids_a, n_a = pair.encode_a(texts)
    ids_b, n_b = pair.encode_b(texts)
    pair.pieces.forget()  # words are remembered aligned
    end_a, end_b = np.cumsum(pair.a.size[ids_a]), np.cumsum(pair.b.size[ids_b])
    last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
    data, at = V.buffer(texts)
    same = np.zeros(len(texts), bool)
    raw, join_a, join_b = data.tobytes(), pair.a.joined(ids_a), pair.b.joined(ids_b)
    pos_a = pos_b = 0
    for k in range(len(texts)):
        to_a = int(end_a[last_a[k] - 1]) if n_a[k] else pos_a
        to_b = int(end_b[last_b[k] - 1]) if n_b[k] else pos_b
        text = b" " + raw[at[k]:at[k + 1]]
        same[k] = join_a[pos_a:to_a] == text and join_b[pos_b:to_b] == text
        pos_a, pos_b = to_a, to_b
    ids_a, ids_b, n_a, n_b = ids_a[np.repeat(same, n_a)], ids_b[np.repeat(same, n_b)], n_a * same, n_b * same
    end_a, end_b = np.cumsum(pair.a.size[ids_a]), np.cumsum(pair.b.size[ids_b])
    last_a, last_b = np.cumsum(n_a), np.cumsum(n_b)
    some = n_a > 0
    ends = last_a[some] - 1
    inner = common_cuts(end_a, end_b, last_a[some] - n_a[some], ends)
    cut_a = np.sort(np.concatenate([inner, ends]))  # the last A token of each group
    cut_b = np.searchsorted(end_b, end_a[cut_a])
    size_a, size_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
    until = np.searchsorted(cut_a, last_a - 1, side="right")  # groups up to the end of each text
    # the written form: tokens in order of groups, A before B, each with the mark that follows it
    order = np.empty(len(ids_a) + len(ids_b), np.int64)
    mark = np.full(len(order), ord(","), np.uint8)
    group = np.arange(len(cut_a))
    place_a = np.arange(len(ids_a)) + np.repeat(cut_b - size_b + 1, size_a)
    place_b = np.arange(len(ids_b)) + np.repeat(cut_a + 1, size_b)
    order[place_a], order[place_b] = ids_a, ids_b
    mark[cut_a + (cut_b - size_b + 1)[group]] = ord("|")
    mark[place_b[cut_b]] = ord(";")
    rows, digits = pair.decimal[order], pair.digits[order]
    rows[np.arange(len(order)), digits] = mark
    written = digits + 1
    text = rows[np.arange(rows.shape[1]) < written[:, None]]
    done = np.concatenate([[0], np.cumsum(written)])[np.concatenate([[0], last_a + last_b])]
    sizes = np.stack([size_a, size_b], axis=1).astype("<u4")
    ends = lambda last, wide: np.concatenate([[0], last]) * wide
    return [_column(ids_a, ends(last_a, ids_a.itemsize)), _column(ids_b, ends(last_b, ids_b.itemsize)),
            _column(sizes, ends(until, 8)), _column(text, done)]


ALIGNED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, a_ids binary, b_ids binary, "
           "sizes binary")


def align(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: ids of both sides (little-endian, two bytes where the vocabulary allows), and how many of
    each every group holds (pairs of four-byte numbers), with counts and the digest of the written groups.

    The files must be readable on every executor. The result is written, with a row_key, and read again.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(byte_path, piece_path)
        size_a, size_b = np.dtype(pair.width_a).itemsize, np.dtype(pair.width_b).itemsize
        for b in batches:
            _, at = V.buffer(b.column(1))
            for i, j in slices(at):
                texts = b.column(1).slice(i, j - i).fill_null("")
                full = np.diff(at[i:j + 1]) > 0
                if full.any():
                    place = pa.array(np.cumsum(full) - 1, mask=~full)
                    columns = [c.take(place).fill_null(b"") for c in _aligned(pair, texts.filter(pa.array(full)))]
                else:
                    columns = [pa.array([b""] * (j - i), pa.binary())] * 4
                a_ids, b_ids, sizes, (raw, to) = *columns[:3], _binary(columns[3])
                counts = [np.diff(_binary(c)[1]) // w for c, w in ((a_ids, size_a), (b_ids, size_b), (sizes, 8))]
                # the last mark of a text is not written
                digest = [hashlib.sha256(raw[x:y - 1]).hexdigest() if y > x else "" for x, y in zip(to.tolist(), to[1:].tolist(), strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(i, j - i), *map(pa.array, counts), pa.array(digest, pa.string()), a_ids, b_ids, sizes],
                    names=["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "a_ids", "b_ids", "sizes"])

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return _kept(rows.mapInArrow(run, ALIGNED).select(F.monotonically_increasing_id().alias("row_key"), "*"), "aligned")


def _kept(df: DataFrame, name: str) -> DataFrame:
    """Written in the shared folder, packed more tightly than by default: ids compress well."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _links(b: pa.RecordBatch, pair: TokenizerPair) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Steps of rows [i, j) with the pair (A id times the size of B, plus B id) and the row of each link; columns a_ids, b_ids last."""
    (raw_a, at_a), (raw_b, at_b) = (_binary(b.column(b.num_columns - 2 + k)) for k in (0, 1))
    for i, j in slices(at_a, 1 << 20):
        ids_a, ids_b = raw_a[at_a[i]:at_a[j]].view(pair.width_a), raw_b[at_b[i]:at_b[j]].view(pair.width_b)
        end_a, end_b = np.cumsum(pair.a.size[ids_a]), np.cumsum(pair.b.size[ids_b])
        ends = np.sort(np.concatenate([end_a, end_b]), kind="stable")
        ends = ends[np.diff(ends, prepend=-1) > 0]
        own_a = np.searchsorted(end_a, ends)
        key = ids_a[own_a].astype(np.int64) * len(pair.b.size) + ids_b[np.searchsorted(end_b, ends)]
        row = np.searchsorted((at_a[i + 1:j + 1] - at_a[i]) // ids_a.itemsize, own_a, side="right")
        yield i, j, key, row


def _binary(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, counts = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[first], np.add.reduceat(counts, first) if len(first) else counts


def link_counts(aligned: DataFrame, byte_path: str, piece_path: str) -> DataFrame:
    """pair (A id times the size of B, plus B id), b_id, n (links of the corpus), best (no pair of its B id has more); written."""
    size_b = len(pair_of(byte_path, piece_path).b.size)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = pair_of(byte_path, piece_path)
        parts, held = [], 0
        for b in batches:
            for _, _, key, _ in _links(b, pair):
                if len(key):
                    parts.append(np.unique(key, return_counts=True))
                    held += len(parts[-1][0])
                if held > COMPACT:
                    parts = [_merged(parts)]
                    held = len(parts[0][0])
                    if held > COMPACT // 2:  # mostly different ones: hand them on, Spark adds them up
                        yield from _rows(parts.pop())
                        held = 0
        if parts:
            yield from _rows(_merged(parts))

    def _rows(part):
        for k in range(0, len(part[0]), EMIT):
            yield pa.RecordBatch.from_arrays([pa.array(x[k:k + EMIT]) for x in part], names=["pair", "n"])

    counts = _kept(aligned.select("a_ids", "b_ids").mapInArrow(run, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
                   .withColumn("b_id", F.col("pair") % size_b), "link_counts")
    most = counts.groupBy("b_id").agg(F.max("n").alias("most"))  # a row per id of B at most
    return _kept(counts.join(F.broadcast(most), "b_id").select("pair", "b_id", "n", (F.col("n") == F.col("most")).alias("best")), "link_best")


def link_statistics(aligned: DataFrame, counts: DataFrame, byte_path: str, piece_path: str, frequent: int = FREQUENT) -> DataFrame:
    """row_key, n_links, n_best and count_sum of every row of ``aligned``."""
    top = counts.orderBy(F.col("n").desc(), "pair").limit(frequent).select("pair", "n", "best").toArrow().combine_chunks()
    known = {c: top.column(c).to_numpy() for c in ("pair", "n", "best")}
    by = np.argsort(known["pair"])
    shared = aligned.sparkSession.sparkContext.broadcast({k: v[by] for k, v in known.items()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair, own = pair_of(byte_path, piece_path), shared.value
        for b in batches:
            for i, j, key, row in _links(b, pair):
                at = np.minimum(np.searchsorted(own["pair"], key), max(len(own["pair"]) - 1, 0))
                hit = own["pair"][at] == key if len(own["pair"]) else np.zeros(len(key), bool)
                n = np.zeros((3, j - i), np.int64)
                n[0] = np.bincount(row, minlength=j - i)
                at, of = at[hit], row[hit]
                n[1] = np.bincount(of, own["best"][at], minlength=j - i)
                starts = np.searchsorted(of, np.arange(j - i + 1))
                total = np.concatenate([[0], np.cumsum(own["n"][at])])
                n[2] = total[starts[1:]] - total[starts[:-1]]
                rare, of = key[~hit], row[~hit]
                by = np.lexsort((rare, of))
                rare, of = rare[by], of[by]
                first = np.flatnonzero((np.diff(rare, prepend=-1) != 0) | (np.diff(of, prepend=-1) != 0))
                ends = np.searchsorted(of[first], np.arange(j - i + 1)).astype(np.int32)
                times = np.diff(first, append=len(rare))
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int64))) for x in (rare[first], times)]
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, j - i), *map(pa.array, n), *lists],
                                                 names=["row_key", "n_links", "n_best", "count_sum", "rare", "times"])

    part = _kept(aligned.select("row_key", "a_ids", "b_ids").mapInArrow(
        run, "row_key bigint, n_links bigint, n_best bigint, count_sum bigint, rare array<bigint>, times array<bigint>"), "link_parts")
    one = part.select("row_key", F.explode(F.arrays_zip("rare", "times")).alias("z")).select(
        "row_key", F.col("z.rare").alias("pair"), F.col("z.times").alias("times"))
    rest = one.join(counts, "pair").groupBy("row_key").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"), F.sum(F.col("times") * F.col("n")).alias("more_sum"))
    return part.join(rest, "row_key", "left").select(
        "row_key", "n_links", (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"))


def align_tokens(docs: DataFrame, byte_path: str, piece_path: str, id_col: str = "doc_id", text_col: str = "text",
                 frequent: int = FREQUENT) -> DataFrame:
    """:func:`align` with n_links, n_best (links whose pair is the commonest of its B id) and count_sum."""
    aligned = align(docs, byte_path, piece_path, id_col, text_col)
    counts = link_counts(aligned, byte_path, piece_path)
    return aligned.join(link_statistics(aligned, counts, byte_path, piece_path, frequent), "row_key")
