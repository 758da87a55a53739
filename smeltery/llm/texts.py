"""Whole texts inside tasks: Arrow columns as flat bytes, words as hashes.

Words are ``[^\\x20\\x09-\\x0D]+``. A null text has no bytes and no words.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

#: Texts are handled in groups of about so many bytes; a longer text is a group of its own.
GROUP_BYTES = 1 << 20

_RANDOM = np.random.default_rng(20_240_607)
BYTE_CODES = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) | np.uint64(1)
FACTOR = np.uint64(0x9E3779B97F4A7C15)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with as many underscores behind it as make it differ from all columns."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one byte array, and the offset of each (one more at the end)."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    first = int(bounds[0])
    return np.frombuffer(data, np.uint8)[first : int(bounds[-1])], bounds - first


def groups(batch: pa.RecordBatch, text: str, most: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch that hold about ``most`` bytes of text each."""
    column = batch.column(text)
    sizes = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < len(column):
        before = sizes[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(sizes, before + most, "right")))
        yield batch.slice(start, end - start)
        start = end


def word_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and for each text the index of its first word (one more at the end)."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = ~space
    begins = inside[:-1].copy()
    begins[1:] &= space[:-1]
    edges = bounds[:-1][bounds[:-1] < len(data)]
    begins[edges] |= ~space[edges]
    starts = np.flatnonzero(begins)
    last = ~space
    last[:-1] &= space[1:]
    inner = bounds[1:-1]
    inner = inner[(inner > 0)] - 1
    last[inner] |= ~space[inner]
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, bounds)


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the factor and of its inverse modulo 2^64."""
    both = []
    for base in (int(FACTOR), pow(int(FACTOR), -1, 2**64)):
        out = np.full(n, base, np.uint64)
        out[0] = 1
        both.append(np.multiply.accumulate(out))
    return both[0], both[1]


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of 64-bit numbers stirred, so that any of them serve as a bucket or a rank."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def span_sums(codes: np.ndarray) -> np.ndarray:
    """Sums of code * factor^position over prefixes, for ``sum_hashes``."""
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum(codes * _tables(len(codes))[0][: len(codes)], out=sums[1:])
    return sums


def sum_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each span, equal for equal codes wherever they stand.

    A difference of sums, shifted to position 0, is a polynomial of the span alone, modulo 2^64.
    """
    inverse = _tables(len(sums) - 1)[1]
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def span_hashes(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return sum_hashes(span_sums(codes), starts, ends)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, equal for equal words wherever they stand."""
    return span_hashes(BYTE_CODES[data], starts, ends)


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(1 << max(20, (n - 1).bit_length()))


def rolling(values: np.ndarray, width: int) -> np.ndarray:
    """A hash of each run of ``width`` values; empty when there are fewer."""
    n = len(values) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    done, power = 0, values * np.uint64(1)
    # Doubling: hashes of 1, 2, 4, ... values, put together by the bits of width.
    size = 1
    while width - done:
        if width & size:
            part = power[done : done + n]
            out = out * _step(size) + part
            done += size
        if done < width:
            power = power[:-size] * _step(size) + power[size:] if len(power) > size else power[:0]
            size *= 2
    return mixed(out)


def _step(size: int) -> np.uint64:
    return np.uint64(pow(int(FACTOR), size, 2**64))
