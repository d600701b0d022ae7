"""Texts of Arrow batches as byte blocks, and the hashed words and shingles in them.

Everything here works on whole texts. Blocks only bound the memory of a task: rows are gathered
until a block holds ``BLOCK_BYTES``; a longer text is a block of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

BLOCK_BYTES = 1 << 21
SHINGLE_WORDS = 5
#: Rows in one Arrow batch between Spark and Python, so that long texts do not pile up.
BATCH_ROWS = 256

_random = np.random.default_rng(20240801)
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _random.integers(1, 1 << 63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

#: Everything but ASCII letters and bytes beyond ASCII.
NO_LETTER = np.ones(256, bool)
NO_LETTER[128:] = False
NO_LETTER[65:91] = False
NO_LETTER[97:123] = False

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Let Arrow batches of this session hold at most ``rows`` rows."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2^64, for positions below ``n``."""
    if len(_powers[0]) < n:
        size = max(n, BLOCK_BYTES + 1)
        for at, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[at] = np.cumprod(steps)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread each 64-bit number over all its bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_column(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column, and the bounds of its rows; null is empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    held = column.buffers()[2]
    return np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8), offsets


def text_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks of rows: number of the first row, bytes, bounds of the rows within the bytes."""
    data, offsets = byte_column(column)
    lo, rows = 0, len(column)
    while lo < rows:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        hi = min(hi, rows)
        yield lo, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
        lo = hi


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the polynomial hash; ``span_hash`` takes the hash of a part from them."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(len(data) + 1)[0][: len(data)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of the bytes from ``start`` to ``end``, the same wherever they stand."""
    return (sums[end] - sums[start]) * powers(len(sums))[1][start]


def word_spans(
    data: np.ndarray, bounds: np.ndarray, outside: np.ndarray = _SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word of a block, and the bounds of the rows in words.

    Words are runs of bytes other than those marked in ``outside``: by default space and the
    control characters 9 to 13. No word goes beyond a row.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(bounds), np.int64)
    inside = ~outside[data]
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    edges = bounds[:-1][bounds[:-1] < bounds[1:]]
    first[edges] = inside[edges]
    edges = bounds[1:][bounds[:-1] < bounds[1:]] - 1
    last[edges] = inside[edges]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, bounds)


def lower_hashes(data: np.ndarray) -> np.ndarray:
    """``prefix_hashes`` with A to Z as lower case."""
    return prefix_hashes(_LOWER[data])


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """For each row the sorted distinct 64-bit hashes of its shingles of five words.

    A text of fewer words has its whole word sequence as its one shingle, one without words none.
    """
    k = SHINGLE_WORDS
    for _, data, bounds in text_blocks(column):
        start, end, at = word_spans(data, bounds)
        words = mix(span_hash(lower_hashes(data), start, end))
        n = max(0, len(words) - k + 1)
        rolled = np.zeros(n, np.uint64)
        for j in range(k):
            rolled += words[j : j + n] * _PLACE[j]
        rolled = mix(rolled)
        for lo, hi in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
            if hi - lo >= k:
                yield np.unique(rolled[lo : hi - k + 1])
            elif hi > lo:
                yield mix((words[lo:hi] * _PLACE[k : k + hi - lo]).sum(dtype=np.uint64, keepdims=True) + np.uint64(hi - lo))
            else:
                yield rolled[:0]
