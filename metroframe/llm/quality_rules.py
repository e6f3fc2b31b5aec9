"""Quality rules: a hashed n-gram log-likelihood ratio, beside plain counts.

Words and word pairs are hashed into 2**18 bins. The bin counts of every
document (the raw corpus) and of the trusted documents (the target) make two
smoothed multinomials; a document's score is the mean of log p_target(bin) -
log p_raw(bin) over its words and pairs, so length does not matter. A document is
kept when its score is at or above a fixed threshold and the base rules pass.

The smoothing adds the same counts to the target and to what the target would hold if it were
like the raw corpus. A bin unseen in a small target so scores near 0, and a score does not
change when the raw corpus grows with all its parts alike.

Corpus counts cover all rows. The target is a bounded, documented sample:
at most ``TRUSTED_ROWS`` ids labelled good, chosen by hash. The model on the
driver has two numbers per bin, whatever the size of the input.

Defined cases: a null or empty text has no words, fails the base rules and is not
kept; without trusted documents the target equals the raw corpus, every score is
0 and the base rules decide; repeated rows are judged alike and all returned; a
row without an id is judged as raw; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroframe.llm import vectext as V
from metroframe.llm.common import slices

BITS = 18
TRUSTED_ROWS = 20_000
SMOOTH = 3.0  # added to each bin's target count and to the count expected of the raw corpus, so a rare bin says little
THRESHOLD = -0.2  # mean log ratio per word or pair below which a document goes
MIN_WORDS = 10
WINDOW = 5
MAX_REPEATED = 20  # percent of the words
U = np.uint64
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
LEAD = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point
STATS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _bins(words: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bins of all words and of all pairs within a text, with the text of each."""
    pair = V.shingles(words, 2)
    same = owner[1:] == owner[:-1] if len(owner) > 1 else np.zeros(0, bool)
    bins = np.concatenate([words, pair[same]]) >> U(64 - BITS)
    return bins.astype(np.int64), np.concatenate([owner, owner[:-1][same]]) if len(owner) else owner


def _per_text(owner: np.ndarray, n: int, weights=None) -> np.ndarray:
    return np.bincount(owner, weights=weights, minlength=n)


def repeats(rolled: np.ndarray, n_words: int, width: int) -> int:
    """Words in windows that occur twice or more, of one text's window hashes."""
    order = np.argsort(rolled, kind="stable")
    same = rolled[order[1:]] == rolled[order[:-1]]
    if not same.any():
        return 0
    twice = np.zeros(len(rolled), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    step = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(step, at, 1)
    np.add.at(step, at + width, -1)
    return int((np.cumsum(step)[:-1] > 0).sum())


def counts(data: np.ndarray, bounds: np.ndarray):
    """(the five base counts as columns, bins, text of each bin) of the texts in ``data``."""
    n = len(bounds) - 1
    starts, _, hash_, owner = V.words(data, bounds)
    inside = ~V.SPACE[data]
    cum = lambda mask: np.concatenate([[0], np.cumsum(mask)])
    chars, symbols = cum(inside & LEAD[data]), cum(SYMBOLS[data])
    out = np.zeros((5, n), np.int64)
    out[0] = _per_text(owner, n)
    out[1], out[2] = np.diff(chars[bounds]), np.diff(symbols[bounds])
    line, of, a, b = V.lines(data, bounds)
    if len(line):
        word_at = cum(inside)
        real = word_at[b] > word_at[a]  # lines with a word
        line, of = line[real], of[real]
    first = np.searchsorted(owner, np.arange(n + 1))
    line_first = np.searchsorted(of, np.arange(n + 1))
    rolled = V.shingles(hash_, WINDOW)
    for d in range(n):
        own = line[line_first[d]:line_first[d + 1]]
        if len(own) > 1:
            out[3, d] = len(own) - len(np.unique(own))
        size = first[d + 1] - first[d]
        if size > WINDOW:
            out[4, d] = repeats(rolled[first[d]:first[d + 1] - WINDOW + 1], size, WINDOW)
    return out, *_bins(hash_, owner)


def _corpus(batches):
    raw, target = np.zeros(1 << BITS, np.int64), np.zeros(1 << BITS, np.int64)
    for b in batches:
        trusted = np.asarray(b.column(1).to_numpy(zero_copy_only=False), bool)
        data, at = V.buffer(b.column(0))
        for i, j in slices(at):
            bounds = at[i:j + 1] - at[i]
            _, _, hash_, owner = V.words(data[at[i]:at[j]], bounds)
            bins, of = _bins(hash_, owner)
            raw += np.bincount(bins, minlength=1 << BITS)
            target += np.bincount(bins[trusted[i:j][of]], minlength=1 << BITS)
    some = np.flatnonzero(raw)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(raw[some]), pa.array(target[some])],
                                     names=["bin", "raw", "target"])


def log_ratios(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               trusted_rows: int = TRUSTED_ROWS) -> np.ndarray:
    """log p_target - log p_raw for each bin; ``trusted`` holds the ids of good documents."""
    ids = trusted.select(F.col(id_col).alias("id")).filter("id is not null").distinct() \
        .orderBy(F.xxhash64("id"), "id").limit(trusted_rows)
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(ids.withColumn("good", F.lit(True))), "id", "left")
            .select("text", F.coalesce("good", F.lit(False)).alias("good")))
    sums = (rows.mapInArrow(_corpus, "bin bigint, raw bigint, target bigint").groupBy("bin")
            .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))).toPandas()
    raw, target = np.zeros(1 << BITS), np.zeros(1 << BITS)
    raw[sums["bin"]], target[sums["bin"]] = sums["raw"], sums["target"]
    if not target.any():
        target = raw
    part = target.sum() / raw.sum() if raw.any() else 1.0
    return np.log((target + SMOOTH) / (raw * part + SMOOTH))


def _judge(texts, ratio: np.ndarray, threshold: float):
    """(five counts, base_failed, score, kept) of an Arrow string column."""
    data, at = V.buffer(texts)
    stats, scores = [np.zeros((5, 0), np.int64)], [np.zeros(0)]
    for i, j in slices(at):
        found, bins, of = counts(data[at[i]:at[j]], at[i:j + 1] - at[i])
        size = _per_text(of, j - i)
        total = _per_text(of, j - i, ratio[bins])
        stats.append(found)
        scores.append(np.divide(total, size, out=np.full(j - i, np.nan), where=size > 0))
    s, score = np.concatenate(stats, axis=1), np.concatenate(scores)
    failed = (s[0] < MIN_WORDS) | (100 * s[4] > MAX_REPEATED * s[0])
    return s, failed, score, ~failed & (np.nan_to_num(score, nan=-np.inf) >= threshold)


def quality(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            threshold: float = THRESHOLD, trusted_rows: int = TRUSTED_ROWS) -> DataFrame:
    """Per row: the id, the five counts, base_failed, score (null without words), kept."""
    ratio = log_ratios(docs, trusted, id_col, text_col, trusted_rows)
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    spread = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        for b in batches:
            s, failed, score, kept = _judge(b.column(1), spread.value, threshold)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *map(pa.array, s), pa.array(failed), pa.array(score, mask=np.isnan(score)), pa.array(kept)],
                names=["doc_id", *STATS, "base_failed", "score", "kept"])

    return rows.mapInArrow(run, "doc_id bigint, " + ", ".join(f"{c} bigint" for c in STATS)
                           + ", base_failed boolean, score double, kept boolean")


def quality_filter(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   threshold: float = THRESHOLD, trusted_rows: int = TRUSTED_ROWS) -> DataFrame:
    """The rows of ``docs``, all columns, that :func:`quality` keeps."""
    spread = docs.sparkSession.sparkContext.broadcast(log_ratios(docs, trusted, id_col, text_col, trusted_rows))
    at = docs.columns.index(text_col)

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(_judge(b.column(at), spread.value, threshold)[3]))

    return docs.mapInArrow(run, docs.schema)
