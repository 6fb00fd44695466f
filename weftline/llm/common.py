"""Helpers for Arrow batches of text: bounded slices, bytes, words and 64-bit hashes."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from weftline import session

#: Bytes of text that are worked on at a time; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

U64 = np.uint64

_GOLDEN = U64(0x9E3779B97F4A7C15)

# Space, tab, line feed, vertical tab, form feed, carriage return.
IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Lower case of the bytes A-Z, all others as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


def share(spark: SparkSession, value):
    """Broadcast a value of bounded size to tasks that get their rows in batches of bounded size."""
    session.bound_batches(spark)
    return session.share(spark, value)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have in any letter case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and the offsets of each; a null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if not len(texts):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    content = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return content[bounds[0] : bounds[-1]], bounds - bounds[0]


def give_back() -> None:
    """Return freed memory of this worker to the system: workers live on between tasks and stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it
    if trim is not None:
        trim(0)


def text_slices(batches: Iterator[pa.RecordBatch], name: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of all batches, in pieces of about `limit` bytes of text and one row at least; gives memory back at the end."""
    for batch in batches:
        column = batch.schema.get_field_index(name)
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        ends = np.cumsum(lengths, dtype=np.int64)
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(first, last - first)
            first = last
    give_back()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers (a bijection); the input is not changed."""
    x = x + _GOLDEN
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def numbers(count: int, seed: int) -> np.ndarray:
    """Fixed pseudo-random 64-bit numbers."""
    return mix(np.arange(count, dtype=U64) * _GOLDEN + U64(seed))


_BYTE_VALUES = numbers(256, 11)
_BASE = 0x2545F4914F6CDD1D
_powers: list[np.ndarray] = []


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base modulo 2^64, and of its inverse."""
    if not _powers or len(_powers[0]) < length:
        size = max(length, 1 << 16)
        forward = np.full(size, _BASE, U64)
        backward = np.full(size, pow(_BASE, -1, 1 << 64), U64)
        forward[0] = backward[0] = 1
        _powers[:] = [np.multiply.accumulate(forward), np.multiply.accumulate(backward)]
    return _powers[0][:length], _powers[1][:length]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs without white space, and the first word of each text (and the word count)."""
    inside = ~IS_SPACE[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends[:-1] &= ~inside[1:] | first[1:-1]
    begin = np.flatnonzero(starts)
    return begin, np.flatnonzero(ends) + 1, np.searchsorted(begin, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, block: int = SLICE_BYTES) -> np.ndarray:
    """A 64-bit hash of each span of bytes; spans are in order and don't overlap."""
    out = np.empty(len(starts), U64)
    low = 0
    while low < len(starts):
        base = starts[low]
        high = max(low + 1, int(np.searchsorted(ends, base + block, side="right")))
        piece = data[base : ends[high - 1]]
        forward, backward = _power_tables(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, U64)
        np.cumsum(_BYTE_VALUES[piece] * forward[:-1], out=sums[1:])
        begin, end = starts[low:high] - base, ends[low:high] - base
        out[low:high] = (sums[end] - sums[begin]) * backward[begin] + (end - begin).astype(U64)
        low = high
    return mix(out)


def record_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema, strict=True)],
        schema=schema,
    )
