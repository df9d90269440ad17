"""Vectorised views of a batch of texts: bytes, words and word hashes.

White space and A-Z are single bytes in UTF-8, so words are cut on the bytes.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes handled at once; a longer text is handled alone.
SLICE = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit (the splitmix64 finisher)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def slices(column: pa.Array, most: int = SLICE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes and row offsets of slices of about ``most`` bytes; nulls are empty."""
    column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(column.buffers()[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] else np.zeros(0, np.uint8)
    i = 0
    while i < len(column):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, side="right")) - 1)
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        i = j


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words, and the row of each."""
    n = len(data)
    space = IS_SPACE[data]
    before, after = np.empty(n, bool), np.empty(n, bool)
    if n:
        before[0], before[1:] = True, space[:-1]
        after[-1], after[:-1] = True, space[1:]
        inner = offsets[(offsets > 0) & (offsets < n)]
        before[inner] = True
        after[inner - 1] = True
    starts = np.flatnonzero(before & ~space)
    ends = np.flatnonzero(after & ~space) + 1
    return starts, ends, np.searchsorted(offsets, starts, side="right") - 1


@functools.lru_cache(maxsize=2)
def _byte_codes(lower: bool) -> np.ndarray:
    codes = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    if lower:
        codes[65:91] = codes[97:123]
    return codes


_powers: list[np.ndarray] = []


def power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    if not _powers or len(_powers[0]) < n:
        odd = 0x9E3779B97F4A7C15
        m = max(n, SLICE + 1)
        _powers[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(m - 1, r, np.uint64)])) for r in (odd, pow(odd, -1, 1 << 64))]
    return _powers[0], _powers[1]


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each word's bytes, A-Z as a-z if asked."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = power_tables(len(data) + 1)
    run = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_byte_codes(lower)[data] * up[: len(data)])])
    return mixed((run[ends] - run[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """Per row the sorted distinct hashes of its windows of ``width`` words (of all its words, if fewer)."""
    starts, ends, row = word_bounds(data, offsets)
    h = word_hashes(data, starts, ends)
    first = np.searchsorted(row, np.arange(len(offsets)))
    factors = mixed(np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)) | np.uint64(1)
    m = max(0, len(h) - width + 1)
    total = np.zeros(m, np.uint64)
    for j in range(width):
        total += h[j : j + m] * factors[j]
    total = mixed(total)
    out = []
    for i in range(len(offsets) - 1):
        a, b = first[i], first[i + 1]
        if b - a >= width:
            out.append(np.unique(total[a : b - width + 1]))
        elif b > a:
            out.append(mixed(np.array([np.sum(h[a:b] * factors[: b - a], dtype=np.uint64) ^ np.uint64(b - a)], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
