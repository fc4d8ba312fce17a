"""Columns of texts as flat byte arrays: words, lines and their hashes without a loop over texts.

Many texts lie in one array with a separator before, between and after them, so no word spans two.
A hash of a span comes from one running sum: with S[i] the sum of v[b_j] * p**j over j < i, in
arithmetic modulo 2**64, (S[end] - S[start]) * p**-start depends on nothing but the span's bytes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa

NEWLINE = 10
# An odd multiplier, so it has an inverse modulo 2**64.
STEP = 0x9E3779B97F4A7C15
STEP_BACK = pow(STEP, -1, 1 << 64)
# A value per byte from a fixed seed.
BYTE_VALUES = np.random.default_rng(20260712).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table that is true for the bytes in the given inclusive ranges."""
    table = np.zeros(256, bool)
    for first, last in ranges:
        table[first : last + 1] = True
    return table


# Bytes of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]`, after lower-casing, and of `[^\x20\x09-\x0D]`.
ALNUM = byte_class((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))
VISIBLE = ~byte_class((0x20, 0x20), (0x09, 0x0D))


def flatten(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each; null counts as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    width = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    offsets = np.frombuffer(offsets, width)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


class Texts:
    """Texts in one array: text i lies in [begin[i], end[i]), with `gap` newlines before and after it."""

    def __init__(self, column: pa.Array, lower: bool = False, gap: int = 1):
        data, offsets = flatten(column)
        self.n = len(offsets) - 1
        place = gap * np.arange(self.n + 1)
        self.begin, self.end = offsets[:-1] + place[:-1] + gap, offsets[1:] + place[1:]
        inside = np.ones(len(data) + gap * (self.n + 1), bool)
        for i in range(gap):
            inside[offsets + place + i] = False
        self.data = np.full(len(inside), NEWLINE, np.uint8)
        self.data[inside] = LOWER[data] if lower else data

    def spans(self, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of the longest runs of bytes in a class that has no newline."""
        marks = table[self.data].view(np.int8)
        steps = np.diff(marks)
        return np.flatnonzero(steps > 0) + 1, np.flatnonzero(steps < 0) + 1

    def first_of(self, starts: np.ndarray) -> np.ndarray:
        """Index of each text's first span, and behind them the number of spans."""
        return np.append(np.searchsorted(starts, self.begin), len(starts)).astype(np.int64)

    def total(self, table: np.ndarray) -> np.ndarray:
        """Number of each text's bytes in a class."""
        sums = np.concatenate(([0], np.cumsum(table[self.data], dtype=np.int64)))
        return sums[self.end] - sums[self.begin]


@lru_cache(maxsize=4)
def _powers(step: int, size: int) -> np.ndarray:
    out = np.full(size, np.uint64(step))
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def powers(step: int, size: int) -> np.ndarray:
    return _powers(step, 1 << max(16, (size - 1).bit_length()))[:size]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers(STEP, len(data)), out=sums[1:])
    return mix((sums[ends] - sums[starts]) * powers(STEP_BACK, len(data))[starts] + (ends - starts).astype(np.uint64))


def numbered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, int]:
    """A number per span, the same for equal bytes and for no others, and how many numbers there are."""
    raw, seen = data.tobytes(), {}
    spans = (raw[i:j] for i, j in zip(starts.tolist(), ends.tolist(), strict=True))
    numbers = np.fromiter((seen.setdefault(span, len(seen)) for span in spans), np.int64, len(starts))
    return numbers, len(seen)


def paired(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A number per pair of numbers, the same for equal pairs and for no others; below the number of pairs."""
    if not len(a):
        return np.zeros(0, np.int64)
    return np.unique(a * (b.max() + 1) + b, return_inverse=True)[1].astype(np.int64)


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[i]:first[i + 1]]."""
    sums = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    return sums[first[1:]] - sums[first[:-1]]
