"""Words, lines and shingles of whole Arrow batches in numpy, as 64-bit hashes.

A word is a run of bytes other than space and \\t to \\r (in UTF-8 these bytes
never occur inside a character). Its hash is a polynomial over random 64-bit
byte codes, mixed; equal words have equal hashes, and two different ones share
a hash with a probability of about 2**-64.
"""

from __future__ import annotations

import numpy as np

U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_BASE, _STEP = U(0x9E3779B97F4A7C15), U(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


CODE = mix(np.arange(1, 257, dtype=U) * _BASE)
_powers = np.ones(1, U)


def powers(n: int) -> np.ndarray:
    """_STEP ** 0 .. n-1 modulo 2**64, kept between calls."""
    global _powers
    if len(_powers) < n:
        _powers = np.cumprod(np.concatenate([np.ones(1, U), np.full(max(n, 256) - 1, _STEP, U)]), dtype=U)
    return _powers[:n]


def buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its texts; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    offsets, data = column.buffers()[1:]
    at = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]] if len(at) else raw[:0], (at - at[0]) if len(at) else np.zeros(1, np.int64)


def _runs(data: np.ndarray, solid: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1] | edge[1:-1]
    last[:-1] &= ~solid[1:] | edge[1:-1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def hashes(data: np.ndarray, solid: np.ndarray, starts: np.ndarray, ends: np.ndarray,
           limit: int = 1 << 18) -> np.ndarray:
    """A hash for each run [start, end), which together are the ``solid`` bytes; in steps of ``limit`` bytes."""
    out = np.empty(len(starts), U)
    done = np.concatenate([[0], np.cumsum(ends - starts)])
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(done, done[i] + limit, side="right")) - 1)
        own = data[starts[i]:ends[j - 1]][solid[starts[i]:ends[j - 1]]]
        at = done[i:j] - done[i]
        size = ends[i:j] - starts[i:j]
        place = np.arange(len(own)) - np.repeat(at, size)
        code = CODE[own] * powers(int(size.max()))[place]
        out[i:j] = mix(np.add.reduceat(code, at) + size.astype(U) * _BASE)
        i = j
    return out


def words(data: np.ndarray, bounds: np.ndarray, lower: bool = False, letters: np.ndarray = ~SPACE):
    """(starts, ends, hash, text index) of every word; ``bounds`` are the texts' offsets in ``data``.

    ``letters`` says which of the 256 bytes are part of a word.
    """
    if lower:
        data = LOWER[data]
    solid = letters[data]
    starts, ends = _runs(data, solid, bounds)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    return starts, ends, hashes(data, solid, starts, ends), owner


def lines(data: np.ndarray, bounds: np.ndarray):
    """(hash, text index, start, end) of every non-empty line (between line feeds)."""
    solid = data != 10
    starts, ends = _runs(data, solid, bounds)
    owner = np.searchsorted(bounds, starts, side="right") - 1
    return hashes(data, solid, starts, ends), owner, starts, ends


def shingles(hash_: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive words (len - k + 1 of them, across texts: filter by owner)."""
    n = len(hash_) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    acc = hash_[:n].copy()
    for j in range(1, k):
        acc = (acc ^ (acc >> U(29))) * _STEP + hash_[j:j + n]
    return mix(acc)
