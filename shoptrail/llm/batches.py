"""Helpers for functions that Spark runs on Arrow batches: text as bytes, words and word hashes as numpy arrays.

Words are runs of bytes outside space, tab, line feed, vertical tab, form feed and carriage return, A-Z lower-cased. Work is
done in pieces of about a megabyte, so that memory follows the longest text and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame

PIECE_BYTES = 1 << 20


class Shipped:
    """An object of this package for Python workers, by value: they need no copy of the package to read it."""

    def __init__(self, df: DataFrame, value: object) -> None:
        self.bytes = df.sparkSession.sparkContext.broadcast(cloudpickle.dumps(value))

    def load(self):
        return cloudpickle.loads(self.bytes.value)


_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """A fixed bijection of 64-bit numbers that spreads every bit over all others."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offsets of each text in them; null counts as empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data, offsets


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, bytes, offsets from 0): rows that together hold about ``limit`` bytes, or one long row."""
    data, offsets = text_bytes(column)
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


class Powers:
    """Powers of an odd base modulo 2^64 and their inverses, as far as they are needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if n > len(self.up):
            n = max(n, PIECE_BYTES + 1)
            self.up = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE))])
            self.down = np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, _BASE_INVERSE))])


def lowered(data: np.ndarray) -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[65:91] += 32
    return table[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; no word crosses a row."""
    space = np.zeros(256, bool)
    space[[9, 10, 11, 12, 13, 32]] = True
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets[:-1]] = True
    edge[0] = True
    begins = inside[:-1].copy()
    begins[1:] &= ~inside[:-2] | edge[1:-1]
    closes = inside[:-1] & (~inside[1:] | edge[1:])
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    rows = np.searchsorted(offsets, starts, "right") - 1
    return starts, ends, rows


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, equal wherever the bytes are equal."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    powers.reach(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers.up[:len(data)], out=total[1:])
    return mix((total[ends] - total[starts]) * powers.down[starts])
