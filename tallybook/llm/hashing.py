"""Vectorised splitting and hashing of the texts of an Arrow batch.

Everything works on the bytes of many texts laid end to end, so that short texts cost
no Python loop. A hash of ``units[s:e]`` is a polynomial over 64-bit integers, taken
from prefix sums; ``mix`` spreads it over all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Texts are processed in runs of about this many bytes; a longer text makes a run of its own.
CHUNK_BYTES = 1 << 20

BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}

#: Word separators: space and the characters from tab to carriage return.
GAP = np.zeros(256, dtype=bool)
GAP[[0x20, *range(0x09, 0x0E)]] = True

IDENTITY = np.arange(256, dtype=np.uint8)
#: A-Z to a-z, all other bytes as they are.
LOWER = IDENTITY.copy()
LOWER[ord("A") : ord("Z") + 1] += 32


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column without nulls, and the row offsets."""
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    bounds = np.frombuffer(offsets, np.int64 if wide else np.int32)
    bounds = bounds[column.offset : column.offset + len(column) + 1].astype(np.int64)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[bounds[0] : bounds[-1]], bounds - bounds[0]


def chunks(bounds: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about ``limit`` bytes each."""
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + limit, side="right")) - 1)
        yield row, min(end, rows)
        row = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers whose output bits all depend on all input bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _power(base: int, size: int) -> np.ndarray:
    known = _powers.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, CHUNK_BYTES + 1), base, np.uint64)
        known[0] = 1
        known = np.multiply.accumulate(known)
        if size <= 4 * CHUNK_BYTES:  # one very long text must not hold its memory
            _powers[base] = known
    return known


class Hasher:
    """Hashes of any ranges of one array of 64-bit units."""

    def __init__(self, units: np.ndarray):
        size = len(units)
        self.sums = np.zeros(size + 1, np.uint64)
        np.cumsum(units * _power(BASE, size + 1)[:size], out=self.sums[1:])
        self.inverse = _power(_INVERSE, size + 1)

    def ranges(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))

    def windows(self, length: int) -> np.ndarray:
        """The hash of ``units[p : p + length]`` for every p."""
        if len(self.sums) <= length:
            return np.zeros(0, np.uint64)
        rows = len(self.sums) - length
        return mix((self.sums[length:] - self.sums[:rows]) * self.inverse[:rows] + np.uint64(length))


def byte_units(data: np.ndarray) -> np.ndarray:
    return data.astype(np.uint64) + np.uint64(1)


def word_spans(data: np.ndarray, bounds: np.ndarray, gap: np.ndarray = GAP):
    """Start and end of every word, and the first word of every row (one more at the end)."""
    inside = ~gap[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


def joined_slices(data: np.ndarray, starts: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The slices that start there, end to end."""
    before = np.cumsum(length) - length
    return data[np.arange(int(length.sum())) + np.repeat(starts - before, length)]


def distinct_slices(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every slice the number of its content, and for every number one slice that has it."""
    return distinct_hashed(data, starts, ends)[:2]


def distinct_hashed(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``distinct_slices``, with a hash of every number's slice.

    Slices are sorted by a hash; their bytes are then compared, so a clash of hashes cannot
    pass for equality.
    """
    hashes = Hasher(byte_units(data)).ranges(starts, ends)
    _, heads, numbers = np.unique(hashes, return_index=True, return_inverse=True)
    length = ends - starts
    same = length == length[heads][numbers]
    if same.all():
        same = joined_slices(data, starts, length) == joined_slices(data, starts[heads][numbers], length)
    if not same.all():
        whole = data.tobytes()
        known: dict[bytes, int] = {}
        numbers = np.array([known.setdefault(whole[a:b], len(known)) for a, b in zip(starts, ends, strict=True)])
        _, heads = np.unique(numbers, return_index=True)
    return numbers, heads, hashes[heads]


def words(data: np.ndarray, bounds: np.ndarray, fold: np.ndarray = IDENTITY, gap: np.ndarray = GAP):
    """Hash, start and end of every word, and the first word of every row."""
    folded = fold[data] if fold is not IDENTITY else data
    starts, ends, first = word_spans(folded, bounds, gap)
    return Hasher(byte_units(folded)).ranges(starts, ends), starts, ends, first


def shingles(hashes: np.ndarray, first: np.ndarray, size: int):
    """Hashes of ``size`` consecutive words and their row; a shorter row gives all its words as one."""
    hasher = Hasher(hashes)
    length = np.diff(first)
    row = np.repeat(np.arange(len(length)), length)
    start = np.arange(len(hashes))
    whole = start + size <= first[row + 1]
    short = np.flatnonzero((length > 0) & (length < size))
    found = np.concatenate(
        [
            hasher.ranges(start[whole], start[whole] + size),
            hasher.ranges(first[short], first[short + 1]),
        ]
    )
    return found, np.concatenate([row[whole], short])


def distinct_sets(hashes: np.ndarray, row: np.ndarray, rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Each row's distinct hashes, ascending, laid end to end, and the row offsets."""
    order = np.lexsort((hashes, row))
    hashes, row = hashes[order], row[order]
    keep = np.ones(len(hashes), bool)
    keep[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[keep], np.searchsorted(row[keep], np.arange(rows + 1))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)
