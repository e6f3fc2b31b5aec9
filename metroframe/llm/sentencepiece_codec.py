"""SentencePiece (BPE) encoding by a merge-type prefix table, and decoding.

The encoding of every prefix of a text ends in exactly one token, and a row of
tokens is an encoding if and only if each pair of neighbours is the encoding of
its own string. So one pass fills a table with the last token of each prefix:
an automaton lists the pieces that end there, and the one fits that is
compatible with the last token of the prefix before it (or, at the start, that
encodes to itself). The ids are recovered from the table backwards, in time
linear in the text however long a run without spaces is.

No piece holds the space mark after another character, and a character that is
no piece (it becomes its bytes) takes part in no merge, so a text is cut before
each run of space marks and at line feeds; the ids of segments met twice and
the pairs tested are kept in a bounded memory per Python worker.

For models with identity normalisation, a dummy prefix and byte fallback; a
model that encodes probe strings otherwise is refused.

Defined cases: a null text counts as empty; an empty text gives the begin and
end ids only and decodes to the empty string; repeated rows are kept; other
columns pass through unless they have the name of an output column.
"""

from __future__ import annotations

import codecs
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MARK = "▁"
SEGMENTS = 1 << 17  # a worker remembers so many segments and pairs used last, and up to as many from before
PAIRS = 1 << 18
MARKS = 1 << 20  # bytes that tell which segments were met once: one is remembered when it comes again
KEPT_LENGTH = 48  # longer segments are not remembered
YIELD_BYTES = 2 << 20
PROBES = ["", " ", "a", "  a  b ", "\n\nx\t y", "a▁b", "ﬁ é", "<s>a</s>", "　\U0001f600", "0123   45"]

codecs.register_error("each_byte", lambda e: ("�", e.start + 1))


class SentencePieceTable:
    """Encoder and decoder of one model."""

    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.text: list[str] = []
        self.raw: list[bytes] = []
        self.byte_id = [0] * 256
        self.bos, self.eos = model.bos_id(), model.eos_id()
        self.automaton = ahocorasick.Automaton()
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.text.append(piece)
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte_id[value] = i
                self.raw.append(bytes([value]))
            elif model.is_control(i):
                self.raw.append(b"")
            elif model.is_unknown(i):
                self.raw.append(" ⁇ ".encode())  # what the library writes for it
            else:
                self.raw.append(piece.replace(MARK, " ").encode())
                self.rank[piece] = -model.get_score(i)
                self.id[piece] = i
                self.automaton.add_word(piece, (i, len(piece)))
                if MARK in piece.lstrip(MARK):
                    raise ValueError("a piece holds a space mark after another character")
        self.automaton.make_automaton()
        self.starts = [self._merged(p) == [p] if p in self.id else False for p in self.text]
        self.pairs = _Recent(PAIRS, self._fit)
        self.segments = _Segments(self)
        for probe in PROBES:
            ids = self.encode(probe)
            if ids.tolist() != model.encode(probe) or self.decode(ids) != model.decode(ids.tolist()).encode():
                raise ValueError("the model needs a normalisation that this operator does not have")

    def _merged(self, text: str) -> list[str]:
        """The pieces of a short string by merging the best pair again and again (the definition)."""
        parts, rank = list(text), self.rank
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _fit(self, pair: int) -> bool:
        """Whether two tokens (the first times 2**32, plus the second) are the encoding of their joined string."""
        a, b = self.text[pair >> 32], self.text[pair & 0xFFFFFFFF]
        return self._merged(a + b) == [a, b]

    def segment(self, text: str) -> list[int]:
        """Ids of a segment (with space marks), by the prefix table."""
        last, size = [-1] * (len(text) + 1), [1] * (len(text) + 1)
        starts, pairs = self.starts, self.pairs
        for end, (token, length) in self.automaton.iter(text):
            end += 1
            if last[end] < 0:
                before = end - length
                # -1: the start, or a character that is no piece
                if starts[token] if before == 0 or last[before] < 0 else pairs[last[before] << 32 | token]:
                    last[end], size[end] = token, length
        ids, end = [], len(text)
        while end:
            if last[end] >= 0:
                ids.append(last[end])
            else:
                ids += [self.byte_id[b] for b in reversed(text[end - 1].encode())]
            end -= size[end]
        ids.reverse()
        return ids

    def encode(self, text: str) -> np.ndarray:
        """uint32 ids without begin and end ids."""
        return np.frombuffer(self.encode_bytes(text), "<u4")

    def encode_bytes(self, text: str) -> bytes:
        if not text:
            return b""
        parts = text.replace(MARK, " ").split(" ")
        if "" not in parts:
            return b"".join(map(self.segments.__getitem__, parts))
        out, marks = [], 0
        for p in parts:  # a run of spaces belongs to the word after it
            if p:
                out.append(self.segments[" " * marks + p])
                marks = 0
            else:
                marks += 1
        if marks:
            out.append(self.segments[" " * (marks - 1)])
        return b"".join(out)

    def decode(self, ids: np.ndarray) -> bytes:
        """The text as UTF-8; the dummy prefix is dropped, a byte that is no character becomes U+FFFD."""
        raw = self.raw
        out = b"".join([raw[i] for i in ids.tolist()])
        if out[:1] == b" ":
            out = out[1:]
        try:
            out.decode()
            return out
        except UnicodeDecodeError:
            return out.decode("utf-8", "each_byte").encode()


class _Recent(dict):
    """Values of ``make``: the last ``size`` keys, and those of the ``size`` before that are still asked for.

    With ``marks`` a key counts when it comes again, so that keys met once push none out.
    """

    def __init__(self, size: int, make, marks: int = 0):
        self.size, self.make, self.before = size, make, {}
        self.marks = bytearray(marks)

    def __missing__(self, key):
        value = self.before.get(key)
        if value is None:
            value = self.make(key)
            if self.marks:
                at = hash(key) % len(self.marks)
                if not self.marks[at]:
                    self.marks[at] = 1
                    return value
        if len(self) >= self.size:
            self.before = dict(self)
            self.clear()
            self.marks = bytearray(len(self.marks))
        self[key] = value
        return value


class _Segments(_Recent):
    """Ids, as bytes, of the segment made of one space mark (after a line feed: ``bare``, none) and the key."""

    def __init__(self, table: SentencePieceTable, mark: str = MARK):
        super().__init__(SEGMENTS if mark else (SEGMENTS + 1) // 2, self._ids, MARKS)
        self.table, self.mark = table, mark
        self.bare = _Segments(table, "") if mark else self

    def _ids(self, key: str) -> bytes:
        return np.array(self.table.segment(self.mark + key.replace(" ", MARK)), "<u4").tobytes()

    def __missing__(self, key: str) -> bytes:
        if "\n" in key and "\n" not in self.table.id:
            head, *rest = key.split("\n")
            feed = np.array([self.table.byte_id[10]], "<u4").tobytes()
            return feed.join([self[head], *[self.bare[r] for r in rest]])
        return super().__missing__(key) if len(key) <= KEPT_LENGTH else self._ids(key)


_tables: dict[str, SentencePieceTable] = {}


def table_of(path: str) -> SentencePieceTable:
    if path not in _tables:
        _tables[path] = SentencePieceTable(path)
    return _tables[path]


def encode_decode(df: DataFrame, model_path: str, text_col: str = "text", ids_col: str = "token_ids",
                  decoded_col: str = "decoded", begin_end: bool = True) -> DataFrame:
    """``df`` with the ids of the text (binary, little-endian unsigned 32-bit) and the text decoded from them.

    ``model_path`` must be readable on every executor.
    """
    keep = [c for c in df.columns if c not in (ids_col, decoded_col) and c != text_col]
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text_col}`").cast("string").alias(text_col))
    schema = T.StructType([*rows.schema.fields, T.StructField(ids_col, T.BinaryType()),
                           T.StructField(decoded_col, T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = table_of(model_path)
        begin = np.array([table.bos], "<u4").tobytes() if begin_end else b""
        end = np.array([table.eos], "<u4").tobytes() if begin_end else b""
        for b in batches:
            ids, texts, size, at = [], [], 0, 0
            for n, text in enumerate(b.column(b.num_columns - 1)):
                own = begin + table.encode_bytes(text.as_py() or "") + end
                ids.append(own)
                texts.append(table.decode(np.frombuffer(own, "<u4")))
                size += len(own) + len(texts[-1])
                if size >= YIELD_BYTES or n + 1 == b.num_rows:
                    part = b.slice(at, len(ids))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns, pa.array(ids, pa.binary()), pa.array(texts, pa.binary()).cast(pa.string())],
                        names=[f.name for f in schema.fields])
                    ids, texts, size, at = [], [], 0, n + 1
        table.segments = _Segments(table)  # a worker lives on for other stages; the pairs are few and stay

    return rows.mapInArrow(run, schema)
