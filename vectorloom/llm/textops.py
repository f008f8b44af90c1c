"""Byte-level text helpers over Arrow columns, without a loop per word."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

# Bytes that one pass of the vectorized helpers handles; a longer text is a pass of its own.
PASS_BYTES = 512 << 10
# Text that one Arrow batch is cut down to where a whole batch is held at once.
SLICE_BYTES = 8 << 20

_RANDOM = np.random.default_rng(20240229)
_BYTE_CODES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_STEP = 0x9E3779B97F4A7C15 | 1
_STEP_BACK = pow(_STEP, -1, 1 << 64)

SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def text_passes(column: pa.Array, limit: int = PASS_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) for runs of rows of about ``limit`` bytes; null counts as empty."""
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    if len(column) == 0:
        return
    column = column.cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1
        end = min(max(end, row + 1), len(column))
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def byte_slices(batch: pa.RecordBatch, column: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Runs of rows with about ``limit`` bytes in a text column; a longer text is a run of its own."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, row = np.cumsum(sizes, dtype=np.int64), 0
    while row < batch.num_rows:
        before = int(ends[row - 1]) if row else 0
        end = max(int(np.searchsorted(ends, before + limit, "right")), row + 1)
        yield batch.slice(row, end - row)
        row = end


def give_back() -> None:
    """Return freed memory to the system: a Python worker outlives its task, and the next one may be of another kind."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def lean(function: Callable) -> Callable:
    """``function`` on a group, or on a pair of them, giving memory back once its own values are gone."""

    def one(key: tuple, rows: pa.Table) -> pa.Table:
        try:
            return function(key, rows)
        finally:
            give_back()

    def two(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        try:
            return function(key, left, right)
        finally:
            give_back()

    return one if function.__code__.co_argcount == 2 else two


def small_batches(spark: SparkSession) -> None:
    """Let Arrow batches hold a few megabytes of text; the setting stays with the session."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(SLICE_BYTES))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class _Powers:
    """Powers of the hash step and of its inverse, as many as were needed so far."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            steps = np.full(size, _STEP, np.uint64)
            back = np.full(size, _STEP_BACK, np.uint64)
            steps[0] = back[0] = 1
            self.up, self.down = np.cumprod(steps), np.cumprod(back)
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


class SpanHashes:
    """64-bit hashes of any byte spans of a buffer, from one running sum."""

    def __init__(self, data: np.ndarray) -> None:
        up, self.down = _POWERS.get(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data] * up[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.down[starts])


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the index of each row's first word (one entry more than rows)."""
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = ~SEPARATOR[data]
    begins = inside[1:] & ~inside[:-1]  # at i: a word begins at byte i
    ends = inside[:-1] & ~inside[1:]  # at i: a word ends before byte i
    # rows meet without a separator between them
    cuts = offsets[1:-1]
    cuts = cuts[(cuts > 0) & (cuts < len(data))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    begins[cuts] = True
    ends[cuts] = True
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends)
    return starts, stops, np.searchsorted(starts, offsets, "left")


def as_texts(column: pa.Array) -> list[bytes]:
    """The values as UTF-8 bytes; null counts as empty."""
    return [b"" if v is None else v for v in column.cast(pa.large_binary()).to_pylist()]
