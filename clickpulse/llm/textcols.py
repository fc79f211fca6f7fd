"""Column-at-a-time views of text for numpy code inside Spark tasks.

A task gets Arrow string arrays; these helpers expose them as one byte buffer
with offsets, cut into slices of bounded size, so that the operators work on
whole columns and their temporaries do not grow with the batch.
A null text is the empty text throughout.
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

SLICE_BYTES = 1 << 20
#: Rows sent to a Python worker at a time.
BATCH_ROWS = 1000

#: ASCII white space: 0x20 and 0x09-0x0D.
WHITE = np.zeros(256, dtype=bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: A-Z to a-z, every other byte as it is.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python workers in small Arrow batches: the session's default of 10,000 rows is far too
    many for documents (a smaller setting is left as it is)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(key))
    if not 0 < now <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def trim() -> None:
    """Give memory that the allocators hold back to the system: workers live on between stages."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


@dataclass
class Slice:
    """Rows ``lo`` to ``hi`` of an array: their bytes, back to back, and ``hi - lo + 1`` offsets."""

    lo: int
    hi: int
    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return self.hi - self.lo

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many of the per-byte ``flags`` are set in each row."""
        return per_segment(flags, self.offsets)


def per_segment(values: np.ndarray, offsets: np.ndarray, kind: type = np.int64) -> np.ndarray:
    """Sum of ``values`` in each segment between neighbouring offsets (each segment's own sum, if not of integers)."""
    if kind is not np.int64:
        out = np.zeros(len(offsets) - 1, dtype=kind)
        full = np.flatnonzero(np.diff(offsets))
        if len(full):
            out[full] = np.add.reduceat(values, offsets[:-1][full])
        return out
    run = np.zeros(len(values) + 1, dtype=np.int64)
    np.cumsum(values, out=run[1:])
    return run[offsets[1:]] - run[offsets[:-1]]


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets of a string or binary array; nulls are empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offs, data = texts.buffers()
    offsets = np.frombuffer(offs, dtype=np.int64, count=len(texts) + 1, offset=8 * texts.offset) if len(texts) else np.zeros(1, np.int64)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[Slice]:
    """Consecutive rows of about ``size`` bytes together (a longer text is a slice of its own)."""
    data, offsets = flat(texts)
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield Slice(lo, hi, data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
        lo = hi


def some_rows(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[pa.Array]:
    """The array again, in slices of about ``size`` bytes, for code that makes Python objects of the rows."""
    offsets = np.concatenate([[0], np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)])
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + size, side="right")) - 1)
        yield texts.slice(lo, hi - lo)
        lo = hi


@dataclass
class Words:
    """Maximal runs of bytes outside ``WHITE``; a word never crosses a row."""

    starts: np.ndarray
    ends: np.ndarray
    row_offsets: np.ndarray  # words before each row, then all

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.row_offsets) - 1), np.diff(self.row_offsets))


def words(part: Slice) -> Words:
    ink = ~WHITE[part.data]
    n = len(ink)
    first = np.zeros(n + 1, dtype=bool)
    first[part.offsets[:-1]] = True
    begin = ink.copy()
    begin[1:] &= ~ink[:-1] | first[1:n]
    last = np.zeros(n + 1, dtype=bool)
    last[part.offsets[1:]] = True
    end = ink.copy()
    end[:-1] &= ~ink[1:] | last[1:n]
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end) + 1
    return Words(starts, ends, np.searchsorted(starts, part.offsets))


def ragged(starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of all elements of the segments, back to back, and the segments' new offsets."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    index = np.arange(offsets[-1], dtype=np.int64)
    index += np.repeat(starts - offsets[:-1], lengths)
    return index, offsets


def binary(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """A binary array over the given bytes (no copy of the bytes if they are contiguous)."""
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(offsets) - 1, [None, pa.py_buffer(np.ascontiguousarray(offsets, dtype=np.int64)), pa.py_buffer(np.ascontiguousarray(data))])


def gather(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, part: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """The segments' elements, back to back, and their offsets; indices are made for some elements at a time."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int64)
    np.cumsum(lengths, out=offsets[1:])
    out = np.empty(offsets[-1], dtype=data.dtype)
    lo = 0
    while lo < len(lengths):
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + part, side="right")) - 1)
        if hi == lo + 1:
            out[offsets[lo]:offsets[hi]] = data[starts[lo]:starts[lo] + lengths[lo]]
        else:
            out[offsets[lo]:offsets[hi]] = data[ragged(starts[lo:hi], lengths[lo:hi])[0]]
        lo = hi
    return out, offsets


def segment_codes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Equal codes exactly for equal byte segments."""
    return binary(*gather(data, starts, ends - starts)).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (multiply and shift, all arithmetic modulo 2**64)."""
    x = x.astype(np.uint64)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self, base: int = 0x9E3779B97F4A7C15):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, self.base, dtype=np.uint64)], dtype=np.uint64)
            self.down = np.cumprod(np.r_[np.uint64(1), np.full(size - 1, self.inverse, dtype=np.uint64)], dtype=np.uint64)
        return self.up[:n], self.down[:n]


POWERS = Powers()


class Rolling:
    """Rolling polynomial hashes of every window of a sequence of 64-bit symbols."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        up, self.down = POWERS.upto(max(n, 1))
        self.run = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(symbols * up[:n], dtype=np.uint64, out=self.run[1:])
        self.n = n

    def windows(self, width: int) -> np.ndarray:
        """The hash of the ``width`` symbols from each start."""
        m = max(0, self.n - width + 1)
        return (self.run[width:width + m] - self.run[:m]) * self.down[:m]
