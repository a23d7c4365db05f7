"""Arrow batches of texts as byte arrays: slices of bounded size, words and their hashes."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# Bytes of text worked on at once. A longer text is a slice of its own.
SLICE_BYTES = 1 << 20

_MULTIPLIER = 0x9E3779B97F4A7C15
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20011)).integers(
    0, 2**64, 256, dtype=np.uint64) | np.uint64(1)


class Texts:
    """Consecutive rows of a batch: the bytes of one text column without gaps.

    `offsets` has one more entry than there are rows. A null text has no bytes.
    """

    def __init__(self, batch: pa.RecordBatch, column: str, data: np.ndarray, offsets: np.ndarray):
        self.batch, self.column, self.data, self.offsets = batch, column, data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def values(self, column: str) -> pa.Array:
        return self.batch.column(self.batch.schema.get_field_index(column))

    def strings(self) -> list[str | None]:
        return self.values(self.column).to_pylist()

    def row_of(self, positions: np.ndarray) -> np.ndarray:
        """The row that holds each byte position."""
        return np.searchsorted(self.offsets, positions, side="right") - 1

    def row_sums(self, values: np.ndarray, rows: np.ndarray) -> np.ndarray:
        return np.bincount(rows, weights=values, minlength=len(self)).astype(np.int64)


def texts_of(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[Texts]:
    """Cut a batch into runs of rows with at most `limit` bytes of text, or one row."""
    text = batch.column(batch.schema.get_field_index(column))
    filled = pc.fill_null(text, "") if text.null_count else text
    filled = filled.cast(pa.large_binary())
    _, offsets, data = filled.buffers()
    ends = np.frombuffer(offsets, np.int64)[filled.offset:filled.offset + len(filled) + 1]
    content = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(
        0, np.uint8)
    low = 0
    while low < len(batch):
        high = int(np.searchsorted(ends, ends[low] + limit, side="right")) - 1
        high = min(max(high, low + 1), len(batch))
        part = content[ends[low]:ends[high]]
        yield Texts(batch.slice(low, high - low), column, part, ends[low:high + 1] - ends[low])
        low = high


def map_texts(df: DataFrame, column: str, schema: str,
              work: Callable[[Iterator[Texts]], Iterator[pa.RecordBatch]],
              limit: int = SLICE_BYTES) -> DataFrame:
    """Run `work` over the slices of each partition."""
    def run(batches):
        yield from work(t for b in batches if len(b) for t in texts_of(b, column, limit))

    return df.mapInArrow(run, schema)


SPACE = np.zeros(256, bool)
SPACE[[0x20, 9, 10, 11, 12, 13]] = True

# A-Z become a-z, all other bytes stay.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def free_name(df: DataFrame, name: str) -> str:
    """A column name that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


class Words:
    """Maximal runs of bytes that are no separator, never across rows."""

    def __init__(self, texts: Texts, separator: np.ndarray = SPACE):
        inside = ~separator[texts.data]
        first, last = inside.copy(), inside.copy()
        if len(inside):
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            filled = texts.offsets[1:] > texts.offsets[:-1]
            at = texts.offsets[:-1][filled]
            first[at] = inside[at]
            at = texts.offsets[1:][filled] - 1
            last[at] = inside[at]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        # bounds[r]:bounds[r + 1] are the words of row r.
        self.bounds = np.searchsorted(self.starts, texts.offsets)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64."""
    if len(_powers[0]) <= n:
        for i, base in enumerate((_MULTIPLIER, pow(_MULTIPLIER, -1, 2**64))):
            steps = np.full(max(n + 1, 1 << 16), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.multiply.accumulate(steps)
    return _powers[0], _powers[1]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(data: np.ndarray, words: Words) -> np.ndarray:
    """A 64-bit hash of the bytes of each word, the same wherever the word stands."""
    power, inverse = _powers_to(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * power[:len(data)], out=sums[1:])
    own = (sums[words.ends] - sums[words.starts]) * inverse[words.starts]
    return mix(own + (words.ends - words.starts).astype(np.uint64))


def run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of each run of n consecutive words, by its first word (rows not regarded)."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    out = np.zeros(len(hashes) - n + 1, np.uint64)
    for k in range(n):
        out *= np.uint64(_MULTIPLIER)
        out += hashes[k:k + len(out)]
    return mix(out)


def long_run_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """As run_hashes, with work that does not grow with n."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    power, inverse = _powers_to(len(hashes))
    sums = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * power[:len(hashes)], out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * inverse[:len(hashes) - n + 1])
