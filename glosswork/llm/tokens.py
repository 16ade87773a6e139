"""Vectorised words and shingles over Arrow string batches.

A word is a maximal run of bytes outside ``[\\x20\\x09-\\x0D]`` with A-Z
lower-cased. Words are hashed to 64 bits straight from the UTF-8 buffer, so no
Python string is built per word. Two different words (or shingles) of one corpus
share a hash with probability 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are handled in runs of about so many bytes, which bounds the temporaries.
RUN_BYTES = 1 << 20

_U = np.uint64
_M = 0x9E3779B97F4A7C15
_MINV = pow(_M, -1, 1 << 64)
_K = _U(0xD6E8FEB86659FD93)
_powers: dict[str, np.ndarray] = {}

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
_byte = np.random.default_rng(20240607).integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_byte[65:91] = _byte[97:123]


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of splitmix: a bijection that spreads every bit."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _power(name: str, base: int, n: int) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        full = np.full(max(n, RUN_BYTES + 1), _U(base), np.uint64)
        full[0] = _U(1)
        have = _powers[name] = np.cumprod(full, dtype=np.uint64)
    return have


def runs(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows. Null texts have no bytes."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_large_string(column.type):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return
    _, where, data = column.buffers()
    offsets = np.frombuffer(where, np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + RUN_BYTES, "right")) - 1)
        last = min(last, n)
        base = offsets[first]
        yield first, data[base : offsets[last]], offsets[first : last + 1] - base
        first = last


def word_bounds(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words in a run, and for each text the index of its first word."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    black = ~space[data]
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = black[:-1]
    inner = offsets[(offsets > 0) & (offsets < n)]
    before[inner] = False
    starts = np.flatnonzero(black & ~before)
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = black[1:]
    after[inner - 1] = False
    ends = np.flatnonzero(black & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def hash_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    n = len(data)
    if not len(starts):
        return np.zeros(0, np.uint64)
    total = np.empty(n + 1, np.uint64)
    total[0] = 0
    np.cumsum(_byte[data] * _power("up", _M, n)[:n], out=total[1:])
    return mix((total[ends] - total[starts]) * _power("down", _MINV, n + 1)[starts])


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive words (also across texts; the caller drops those)."""
    if len(h) < n:
        return np.zeros(0, np.uint64)
    total = h[: len(h) - n + 1].copy()
    for k in range(1, n):
        total *= _K
        total += h[k : len(h) - n + 1 + k]
    return mix(total)


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each text, in order.

    A text of fewer than ``n`` words has its whole sequence as one shingle; a
    text without words, or null, has none.
    """
    for first, data, offsets in runs(column):
        starts, ends, word_of = word_bounds(data, offsets)
        h = hash_words(data, starts, ends)
        grams = windows(h, n)
        for k in range(len(offsets) - 1):
            a, b = word_of[k], word_of[k + 1]
            if b - a >= n:
                own = np.sort(grams[a : b - n + 1])
                keep = np.empty(len(own), bool)
                keep[0] = True
                np.not_equal(own[1:], own[:-1], out=keep[1:])
                yield first + k, own[keep]
            elif b > a:
                short = _U(b - a)
                for x in h[a:b].tolist():
                    short = _U((int(short) * int(_K) + x) & 0xFFFFFFFFFFFFFFFF)
                yield first + k, mix(np.array([short], np.uint64))
            else:
                yield first + k, np.zeros(0, np.uint64)
