"""Words and hashes of whole texts as numpy arrays, for use inside Arrow tasks.

A word is a maximal run of bytes other than space and 0x09-0x0D. In UTF-8 those bytes only occur as themselves, so
splitting bytes equals splitting characters. Work goes through slices of bounded size; a text longer than a slice is a
slice of its own. Null texts count as empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Invertible scrambling of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, kept between calls for slices of the usual size."""
    known = _powers.get(base)
    if known is not None and len(known) >= n:
        return known[:n]
    made = np.full(max(n, SLICE_BYTES + 1), base, np.uint64)
    made[0] = 1
    np.multiply.accumulate(made, out=made)
    if len(made) <= 4 * SLICE_BYTES:
        _powers[base] = made
    return made[:n]


@dataclass
class Texts:
    """Texts of one slice: their bytes, and where each begins and ends."""

    data: np.ndarray
    offsets: np.ndarray

    def __len__(self) -> int:
        return len(self.offsets) - 1


@dataclass
class Words:
    """Words of a slice, text by text: byte ranges, and the first word of every text."""

    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def small_batches(spark) -> None:
    """Let Spark hand texts to Python in batches of a few MB instead of 10,000 rows: this bounds the memory of both sides,
    whatever the length of texts. Applies to the session from here on."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def texts_of(column: pa.Array) -> Texts:
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    if column.null_count:
        column = column.fill_null("")
    ends = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0]:ends[-1]] if data is not None and len(ends) else np.zeros(0, np.uint8)
    return Texts(raw, ends - ends[0])


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """Batches cut where their texts reach ``limit`` bytes."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.diff(texts_of(batch.column(column)).offsets)
        at, total = 0, np.cumsum(sizes)
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
            part = batch.slice(at, end - at)
            yield part, texts_of(part.column(column))
            at = end


def words_of(texts: Texts) -> Words:
    n = len(texts.data)
    inside = np.zeros(n + 2, bool)
    np.logical_not(_SPACE[texts.data], out=inside[1:n + 1])
    begins = inside[1:n + 1] & ~inside[:n]
    closes = inside[1:n + 1] & ~inside[2:]
    edges = texts.offsets[1:-1]
    edges = edges[(edges > 0) & (edges < n)]
    begins[edges] |= inside[1 + edges]
    closes[edges - 1] |= inside[edges]
    starts = np.flatnonzero(begins)
    return Words(starts, np.flatnonzero(closes) + 1, np.searchsorted(starts, texts.offsets))


def hashes(texts: Texts, words: Words, lower: bool = False) -> np.ndarray:
    """64-bit hash of every word."""
    n = len(texts.data)
    data = _LOWER[texts.data] if lower else texts.data
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * powers(_BASE, n), out=sums[1:])
    return mix((sums[words.ends] - sums[words.starts]) * powers(_INVERSE, n + 1)[words.starts])


def grams(hashed: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words of one text, and the number of them in every text."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    n = max(len(hashed) - size + 1, 0)
    if not n:
        return np.zeros(0, np.uint64), counts
    rolled = hashed[:n].copy()
    for j in range(1, size):
        rolled *= np.uint64(0xD1342543DE82EF95)
        rolled += hashed[j:n + j]
    return mix(rolled[spans(first[:-1], counts)]), counts


def spans(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The indices starts[i] .. starts[i] + counts[i] - 1 of all i, one after the other."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.cumsum(counts) - counts
    return np.arange(total) + np.repeat(starts - shift, counts)


def offsets_of(counts: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(counts)])


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column with ``counts[i]`` values in row i."""
    return pa.ListArray.from_arrays(pa.array(offsets_of(counts), pa.int32()), pa.array(values, kind))


def blobs(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema
    )
