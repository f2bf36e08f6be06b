"""Vectorised 64-bit hashing of UTF-8 text held in Arrow buffers.

A polynomial prefix hash modulo 2**64 with a random value for each byte gives
the digest of any byte range from two look-ups; a finaliser spreads its bits.
Digests stand for the byte strings: two different strings inside one document
pair share one with a chance of about 2**-64.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240607)
BYTE_VALUES = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 2**64))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class PrefixHash:
    """Range digests over byte buffers; keeps its tables of powers."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def load(self, data: np.ndarray) -> None:
        if len(data) >= len(self.up):
            n = max(len(data), 1 << 16) + 1
            self.up, self.down = powers(BASE, n), powers(BASE_INVERSE, n)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * self.up[:len(data)], out=self.sums[1:])

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])


def string_buffers(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column; a null is an empty text."""
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    large = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, where, data = column.buffers()
    kind = np.int64 if large else np.int32
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, kind)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, most: int):
    """Runs (i, j) of whole texts of about ``most`` bytes; a longer text is a run of its own."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word (a run without ASCII white space) and its text's number."""
    ink = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before = np.concatenate(([False], ink[:-1])) if len(ink) else ink
    after = np.concatenate((ink[1:], [False])) if len(ink) else ink
    start = np.flatnonzero(ink & (~before | edge[:-1]))
    end = np.flatnonzero(ink & (~after | edge[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def shingle_sets(column, width: int, hasher: PrefixHash, most: int = 1_000_000):
    """Yield (row, sorted distinct shingle digests) for every text of the column.

    Words are lower-cased by A-Z.  A text of fewer than ``width`` words has one
    shingle, its whole sequence; one without words has none.
    """
    data, offsets = string_buffers(column)
    factors = mix(np.arange(1, width + 1, dtype=np.uint64) * BASE) | np.uint64(1)
    for i, j in slices(offsets, most):
        part = LOWER[data[offsets[i]:offsets[j]]]
        at = offsets[i:j + 1] - offsets[i]
        hasher.load(part)
        start, end, text = words(part, at)
        word = hasher.ranges(start, end)
        first = np.searchsorted(text, np.arange(j - i + 1))
        full = max(0, len(word) - width + 1)
        rolled = np.zeros(full, np.uint64)
        for k in range(width):
            rolled += word[k:k + full] * factors[k]
        rolled = mix(rolled)
        for r in range(j - i):
            a, b = first[r], first[r + 1]
            if b - a >= width:
                yield i + r, np.unique(rolled[a:b - width + 1])
            elif b > a:
                short = (word[a:b] * factors[:b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
                yield i + r, mix(np.array([short], np.uint64))
            else:
                yield i + r, np.zeros(0, np.uint64)
