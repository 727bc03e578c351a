"""Text of Arrow batches as numpy arrays: bounded slices, words as byte stretches, 64-bit polynomial hashes.

Everything here works on one slice of a batch, so that the memory of a task depends on SLICE_BYTES and the longest single text, not on the
number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))

_powers: dict[int, np.ndarray] = {}


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row bounds of a string column; NULL is empty text."""
    column = pc.fill_null(column, "") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, bounds, data = column.buffers()
    bounds = np.frombuffer(bounds, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), bounds


def row_slices(bounds: np.ndarray, budget: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Stretches of rows with about `budget` bytes of text each; a longer text is a stretch of its own."""
    row, rows = 0, len(bounds) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(bounds, bounds[row] + budget, side="right")) - 1)
        yield row, min(end, rows)
        row = min(end, rows)


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    have = _powers.get(int(base))
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.cumprod(have, dtype=np.uint64)
        if size <= 4 * SLICE_BYTES:
            _powers[int(base)] = have
    return have[:n]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values whose every output bit depends on every input bit."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


BYTE_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * BASE)


class Rolling:
    """Hashes of any stretch of a sequence of 64-bit units, from one running sum."""

    def __init__(self, units: np.ndarray, salt: int = 0):
        self.base = BASE if not salt else np.uint64((int(BASE) + 2 * 0x632BE59BD9B4E019 * salt) % (1 << 64) | 1)
        inverse = INVERSE if not salt else np.uint64(pow(int(self.base), -1, 1 << 64))
        self.sums = np.zeros(len(units) + 1, np.uint64)
        np.cumsum(units * powers(self.base, len(units)), out=self.sums[1:])
        self.down = powers(inverse, len(units) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64))


def stretches(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each maximal run of True that lies within one row."""
    if not len(inside):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    edges = bounds[1:-1][(bounds[1:-1] > 0) & (bounds[1:-1] < len(inside))]
    starts[edges] |= inside[edges]
    ends[edges - 1] |= inside[edges - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def rows_of(positions: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The row that each position lies in, for ascending positions."""
    counts = np.diff(np.searchsorted(positions, bounds))
    return np.repeat(np.arange(len(bounds) - 1), counts)


def joined_ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every range, one range after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    steps = np.ones(total, np.int64)
    keep = lengths > 0
    s, n = starts[keep], lengths[keep]
    at = np.cumsum(n)[:-1]
    steps[0] = s[0]
    steps[at] = s[1:] - (s[:-1] + n[:-1] - 1)
    return np.cumsum(steps)


def union_length(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping or touching ranges as maximal ones."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    new = np.ones(len(starts), bool)
    new[1:] = starts[1:] > reach[:-1]
    last = np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)
    return starts[new], reach[last]


#: Words are lower-cased letters and digits; every character beyond ASCII belongs to a word.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
WORD_BYTE = np.ones(256, bool)
WORD_BYTE[0x00:0x30] = WORD_BYTE[0x3A:0x61] = WORD_BYTE[0x7B:0x80] = False


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end byte of every word, and the bounds of the rows counted in words."""
    lower = LOWER[data]
    starts, ends = stretches(WORD_BYTE[lower], bounds)
    hashes = Rolling(BYTE_VALUES[lower]).of(starts, ends)
    return hashes, starts, ends, np.searchsorted(starts, bounds)
