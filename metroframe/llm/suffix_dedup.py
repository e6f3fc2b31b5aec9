"""Removal of long repeated byte strings by distributed prefix doubling.

Each byte covered by a string of ``width`` bytes that also starts elsewhere goes.
Ranking every byte position would shuffle many times the text, so positions are
kept as runs: the window of ``width`` bytes at a position has an anchor, its
least 32-byte string by hash (the leftmost of equals), and neighbouring windows with one anchor are one
run. Equal windows have equal anchors at the same offset, so no match is lost.

Round 0 ranks anchors by their 32 bytes; unique ones are done. Runs whose whole
reach occurs twice are repeated throughout. Of what remains, one run of each
content stands for the rest, in blocks of 32 windows: the bytes that a block's windows share are
ranked at growing lengths (128, then all 369), each rank being the pair of the rank
before and that of the bytes next to it, and a block goes as soon as its rank is
unique. Blocks that agree in all their bytes, past the threshold, are repeated. Where blocks
agree only in what their windows share, single windows are ranked by their whole bytes.

Ranks are 64-bit names (hashes of the bytes) with which Spark groups and joins;
two different strings share one with a probability of about 2**-60.

Defined cases: a null text is empty; texts shorter than ``width`` bytes lose
nothing; equal rows count as separate occurrences and are all returned; matches never
cross rows; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroframe.llm import vectext as V
from metroframe.llm.common import bit_filter, may_hold, slices, written

WIDTH = 400
ANCHOR = 32
BLOCK = 32
STEP = 1 << 18  # windows looked at together: each array of them is 2 MB
HELD = 1 << 16  # rows of blocks or windows held before they go out
PLACE = np.uint64((1 << 24) - 1)
U = np.uint64
_BACK = U(pow(int(V._STEP), -1, 1 << 64))
_inverse = np.ones(1, U)
RUN = "rid bigint, at bigint, o1 int, o2 int, anchor bigint, span bigint"


def _inverses(n: int) -> np.ndarray:
    global _inverse
    if len(_inverse) < n:
        _inverse = np.cumprod(np.concatenate([np.ones(1, U), np.full(n - 1, _BACK, U)]), dtype=U)
    return _inverse[:n]


class Rolling:
    """Names of any substrings of ``data`` from prefix sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, U)
        np.cumsum(V.CODE[data] * V.powers(len(data)), out=self.sums[1:], dtype=U)

    def raw(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return (self.sums[end] - self.sums[start]) * _inverses(len(self.sums))[start]

    def names(self, start, end) -> np.ndarray:
        return V.mix(self.raw(start, end))


def least(v: np.ndarray, w: int) -> np.ndarray:
    """Minimum of every ``w`` neighbours, from running minima of blocks of ``w``."""
    n = len(v) - w + 1
    full = np.full(-(-len(v) // w) * w, np.iinfo(np.uint64).max, U)
    full[:len(v)] = v
    rows = full.reshape(-1, w)
    ahead = np.minimum.accumulate(rows, axis=1).reshape(-1)
    back = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return np.minimum(back[:n], ahead[w - 1:w - 1 + n])


def runs(data: np.ndarray, bounds: np.ndarray, width: int = WIDTH):
    """(text index, first window, last window, anchor place, anchor name, name of the reach) of every run."""
    none = [np.zeros(0, np.int64)] * 4 + [np.zeros(0, U)] * 2
    if len(data) < width:
        return none
    roll = Rolling(data)
    n = len(data)
    place = np.arange(n - ANCHOR + 1)
    mixed = roll.names(place, place + ANCHOR)
    least_at = least((mixed & ~PLACE) | place.astype(U), width - ANCHOR + 1)
    open_ = np.zeros(n + 1, np.int32)
    size = np.diff(bounds)
    has = size >= width
    np.add.at(open_, bounds[:-1][has], 1)
    np.add.at(open_, bounds[1:][has] - width + 1, -1)
    window = np.flatnonzero(np.cumsum(open_[:n - width + 1]) > 0)
    if not len(window):
        return none
    at = (least_at[window] & PLACE).astype(np.int64)
    cut = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (window[1:] != window[:-1] + 1)]))
    lo, hi, at = window[cut], window[np.append(cut[1:], len(window)) - 1], at[cut]
    owner = np.searchsorted(bounds, lo, side="right") - 1
    reach = roll.raw(lo, hi + width) + (at - lo).astype(U) * U(0x9E3779B97F4A7C15) + V.mix((hi - lo).astype(U) + U(1))
    return owner, lo, hi, at, mixed[at], V.mix(reach)


def _pieces(data, at):
    """(first text, bytes, bounds, offset of the bytes in a long text) so that windows are all seen once."""
    for i, j in slices(at, STEP):
        if j - i == 1 and at[j] - at[i] > STEP + WIDTH:
            for s in range(0, int(at[j] - at[i]) - WIDTH + 1, STEP):
                part = data[at[i] + s:min(at[j], at[i] + s + STEP + WIDTH - 1)]
                yield i, part, np.array([0, len(part)]), s
        else:
            yield i, data[at[i]:at[j]], at[i:j + 1] - at[i], 0


def _runs(batches):
    for b in batches:
        rid = b.column(0).to_numpy()
        data, at = V.buffer(b.column(1))
        for i, part, bounds, skip in _pieces(data, at):
            owner, lo, hi, place, anchor, span = runs(part, bounds)
            if len(owner):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[i + owner]), pa.array(place - bounds[owner] + skip),
                     pa.array((place - hi).astype(np.int32)), pa.array((place - lo).astype(np.int32)),
                     pa.array(anchor.astype(np.int64)), pa.array(span.astype(np.int64))],
                    names=["rid", "at", "o1", "o2", "anchor", "span"])


# bytes that all windows of a block share, and the lengths at which they are ranked
CORE = WIDTH - BLOCK + 1
REACH = [128, CORE]


BLOCK_NAMES = ["anchor", "span", "block", "near", "far", "whole", "r0", "r1"]
WINDOW_NAMES = ["anchor", "span", "o", "name"]


def _batch(parts: list, names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*parts, strict=True)], names=names)


def _each(found: pa.ListScalar, step: int = 1000):
    """The structs of a list, some at a time."""
    for k in range(0, len(found.values), step):
        yield from found.values.slice(k, step).to_pylist()


def _blocks(batches):
    """Per class and block of 32 windows: names of the parts of what they share, and of all their bytes."""
    for b in batches:
        out, held = [], 0
        for text, found in zip(b.column(0), b.column(1), strict=True):
            text = text.as_buffer()
            for c in _each(found):
                start, end = c["at"] - c["o2"], c["at"] - c["o1"] + WIDTH
                roll = Rolling(np.frombuffer(text, np.uint8, end - start, start))
                block = np.arange(c["o1"] // BLOCK, c["o2"] // BLOCK + 1)
                p = c["at"] - BLOCK * block - start
                parts = [roll.names(p + x, p + y).astype(np.int64) for x, y in zip([0, *REACH], REACH)]
                near = np.maximum(BLOCK * block, c["o1"])
                far = np.minimum(BLOCK * block + BLOCK - 1, c["o2"])
                whole = roll.raw(c["at"] - far - start, c["at"] - near + WIDTH - start)
                whole = V.mix(whole + V.mix((near * WIDTH + far).astype(U)))
                k = len(block)
                out.append([np.full(k, c["anchor"]), np.full(k, c["span"]), block, near, far, whole.astype(np.int64), *parts])
                held += k
                if held >= HELD:
                    yield _batch(out, BLOCK_NAMES)
                    out, held = [], 0
        if out:
            yield _batch(out, BLOCK_NAMES)


def _windows(batches):
    """Each window of the blocks that are still alike: its offset from the anchor and the name of its bytes."""
    for b in batches:
        out, held = [], 0
        for text, found in zip(b.column(0), b.column(1), strict=True):
            text = text.as_buffer()
            for c in _each(found):
                o = np.arange(c["near"], c["far"] + 1)
                start, end = c["at"] - int(o[-1]), c["at"] - int(o[0]) + WIDTH
                roll = Rolling(np.frombuffer(text, np.uint8, end - start, start))
                p = c["at"] - o - start
                k = len(o)
                out.append([np.full(k, c["anchor"]), np.full(k, c["span"]), o,
                            roll.names(p, p + WIDTH).astype(np.int64)])
                held += k
                if held >= HELD:
                    yield _batch(out, WINDOW_NAMES)
                    out, held = [], 0
        if out:
            yield _batch(out, WINDOW_NAMES)


def _shared(df: DataFrame, *key: str) -> DataFrame:
    """Rows whose ``key`` occurs with two spans or more."""
    twice = df.groupBy(*key).agg(F.min("span").alias("lo"), F.max("span").alias("hi")).filter("lo <> hi")
    return df.join(twice.select(*key), list(key), "left_semi")


def repeated_intervals(rows: DataFrame) -> DataFrame:
    """(rid, start, end): byte intervals of ``rows`` (rid, text) to remove; they may overlap."""
    found = written(rows.mapInArrow(_runs, RUN), "suffix_runs")
    often = found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    found = written(found.join(often, "anchor", "left_semi"), "suffix_repeated")
    classes = written(found.groupBy("anchor", "span").agg(
        F.count("*").alias("n"), F.min(F.struct("rid", "at", "o1", "o2")).alias("own")), "suffix_classes")
    whole = found.join(classes.filter("n > 1").select("anchor", "span"), ["anchor", "span"], "left_semi") \
        .select("rid", (F.col("at") - F.col("o2")).alias("start"), (F.col("at") - F.col("o1") + WIDTH).alias("end"))
    some = written(_shared(classes, "anchor").select("anchor", "span", "n", "own.*"), "suffix_some")

    def with_texts(df: DataFrame, *cols: str) -> DataFrame:
        per_text = written(df.groupBy("rid").agg(F.collect_list(F.struct(*cols)).alias("found")), "suffix_lists")
        return _where(rows, bit_filter(per_text, "rid")).join(per_text, "rid") \
            .select(F.col("text").cast("binary").alias("text"), "found")

    left = with_texts(some, "anchor", "span", "at", "o1", "o2").mapInArrow(
        _blocks, ", ".join(f"{c} bigint" for c in BLOCK_NAMES))
    left = _shared(written(left.withColumn("rank", F.col("r0")), "suffix_ranks"), "anchor", "block", "rank")
    left = _shared(written(left.withColumn("rank", F.xxhash64("rank", "r1")), "suffix_ranks"), "anchor", "block", "rank")
    left = written(left.select("anchor", "span", "block", "near", "far", "whole", "rank"), "suffix_blocks")
    # blocks alike in all bytes are repeated; one of them stands for them beside other blocks of its rank
    alike = left.groupBy("anchor", "block", "rank", "whole") \
        .agg(F.min("span").alias("span"), F.max("span").alias("last"), F.first("near").alias("near"), F.first("far").alias("far"))
    settled = left.join(alike.filter("span <> last").select("anchor", "block", "rank", "whole"),
                        ["anchor", "block", "rank", "whole"], "left_semi").select("anchor", "span", "near", "far")
    open_ = _shared(alike, "anchor", "block", "rank").select("anchor", "span", "near", "far") \
        .join(some.select("anchor", "span", "rid", "at"), ["anchor", "span"])
    windows = written(with_texts(open_, "anchor", "span", "at", "near", "far").mapInArrow(
        _windows, "anchor bigint, span bigint, o bigint, name bigint"), "suffix_windows")
    # all windows of a run hold its anchor, so what they cover together is one interval
    single = _shared(windows, "anchor", "o", "name").select("anchor", "span", F.col("o").alias("near"), F.col("o").alias("far"))
    reach = settled.union(single).groupBy("anchor", "span").agg(F.min("near").alias("near"), F.max("far").alias("far"))
    parts = some.filter("n = 1").join(reach, ["anchor", "span"]) \
        .select("rid", (F.col("at") - F.col("far")).alias("start"), (F.col("at") - F.col("near") + WIDTH).alias("end"))
    return whole.union(parts)


def _where(rows: DataFrame, bits: np.ndarray) -> DataFrame:
    """Rows whose rid may be in the filter."""
    def run(batches):
        for b in batches:
            yield b.filter(pa.array(may_hold(bits, b.column(0).to_numpy())))
    return rows.mapInArrow(run, rows.schema)


def remove_intervals(text: bytes, start: np.ndarray, end: np.ndarray) -> tuple[bytes, int, int]:
    """(kept bytes, removed bytes, maximal removed runs); intervals that touch are one run."""
    if not len(start):
        return text, 0, 0
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    cut = np.flatnonzero(start[1:] > reach[:-1]) + 1
    a, b = start[np.append(0, cut)], reach[np.append(cut - 1, len(reach) - 1)]
    kept = b"".join(text[i:j] for i, j in zip([0, *b.tolist()], [*a.tolist(), len(text)], strict=True))
    return kept, int((b - a).sum()), len(a)


def _cut(batches):
    for whole in batches:
        for k in range(0, len(whole), 500):
            b = whole.slice(k, 500)
            kept, removed, spans, size = [], [], [], []
            for text, found in zip(b.column(1), b.column(2), strict=True):
                text = text.as_py() or b""
                lists = found.values if found.is_valid else None
                ends = [np.zeros(0, np.int64)] * 2 if lists is None else [lists.field(x).to_numpy() for x in ("start", "end")]
                r = remove_intervals(text, *ends)
                kept.append(r[0])
                removed.append(r[1])
                spans.append(r[2])
                size.append(len(text))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(size, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
                 pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept (binary: the remaining bytes)."""
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("rid", F.xxhash64("doc_id", "text")).select("rid", "text", "doc_id")
    spans = written(repeated_intervals(rows.select("rid", "text")), "suffix_spans")
    bits = bit_filter(spans, "rid")
    merged = spans.distinct().groupBy("rid").agg(F.collect_list(F.struct("start", "end")).alias("found"))
    raw = F.col("text").cast("binary").alias("text")
    hit = _where(rows, bits).join(merged, "rid", "left").select("doc_id", raw, "found")

    def untouched(batches):
        for b in batches:
            b = b.filter(pa.array(~may_hold(bits, b.column(0).to_numpy())))
            size = pc.binary_length(b.column(1)).cast(pa.int64())
            none = pa.array(np.zeros(len(b), np.int64))
            yield pa.RecordBatch.from_arrays([b.column(2), size, none, none, b.column(1).cast(pa.binary())],
                                             names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary"
    return hit.mapInArrow(_cut, schema).union(rows.mapInArrow(untouched, schema))
