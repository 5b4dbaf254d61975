"""Arrow batches to numpy: texts in bounded chunks, words, polynomial hashes, integer vectors.

Everything here runs inside Spark tasks on the rows of one batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa

# Text bytes that one numpy pass handles; a longer text is a chunk of its own.
CHUNK_BYTES = 1 << 20

# Space and 0x09 to 0x0D: all that separates words.
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_MASK = (1 << 64) - 1


def column_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each row; null is empty."""
    if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    else:
        column = column.cast(pa.binary())
    return [value or b"" for value in column.to_pylist()]


def text_chunks(texts: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges ``[first, last)`` with at most ``limit`` bytes, or a single row."""
    first, size = 0, 0
    for row, text in enumerate(texts):
        if row > first and size + len(text) > limit:
            yield first, row
            first, size = row, 0
        size += len(text) + 1
    if texts:
        yield first, len(texts)


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def signed(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x).view(np.int64)


class Polynomial:
    """Hashes of any slices of a sequence from one prefix sum, modulo 2**64."""

    def __init__(self, seed: int):
        random = np.random.default_rng(seed)
        self.base = int(random.integers(1, 1 << 62)) * 4 + 1
        self.inverse = pow(self.base, -1, 1 << 64)
        self.table = random.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _powers(self, base: int, n: int) -> np.ndarray:
        powers = np.empty(n, dtype=np.uint64)
        powers[0] = 1
        have = 1
        while have < n:
            step = np.uint64(pow(base, have, 1 << 64))
            take = min(have, n - have)
            powers[have : have + take] = powers[:take] * step
            have += take
        return powers

    def prefix(self, symbols: np.ndarray) -> np.ndarray:
        """Prefix sums over bytes (through a random table) or 64-bit symbols."""
        n = len(symbols)
        if len(self.up) < n + 1:
            size = max(n + 1, 2 * len(self.up))
            self.up = self._powers(self.base, size)
            self.down = self._powers(self.inverse, size)
        values = self.table[symbols] if symbols.dtype == np.uint8 else symbols
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(values * self.up[:n], out=sums[1:])
        return sums

    def slices(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        lengths = (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix((sums[end] - sums[start]) * self.down[start] + lengths)

    def windows(self, sums: np.ndarray, width: int) -> np.ndarray:
        """Hash of every ``width`` consecutive symbols."""
        n = len(sums) - width
        if n <= 0:
            return np.zeros(0, dtype=np.uint64)
        return mix((sums[width:] - sums[:n]) * self.down[:n])


class Words:
    """Words of a chunk of texts: byte spans, documents and 64-bit hashes."""

    def __init__(
        self,
        texts: list[bytes],
        polynomial: Polynomial | None = None,
        lower: bool = False,
        spaces: np.ndarray = SPACES,
    ):
        joined = b" ".join(texts) + b" "
        if lower:
            joined = joined.lower()
        self.joined = joined
        data = np.frombuffer(joined, dtype=np.uint8)
        space = spaces[data]
        before = np.empty_like(space)
        before[0] = True
        before[1:] = space[:-1]
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(space & ~before)
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        self.text_end = np.cumsum(lengths)
        self.text_start = self.text_end - lengths
        # Words of text d are first[d] to first[d + 1].
        self.first = np.searchsorted(self.start, np.append(self.text_start, len(data)))
        self.hash = None
        if polynomial is not None:
            self.hash = polynomial.slices(polynomial.prefix(data), self.start, self.end)

    def __len__(self) -> int:
        return len(self.start)

    def document(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))

    def words(self, first: int, last: int) -> list[bytes]:
        if last <= first:
            return []
        return self.joined[self.start[first] : self.end[last - 1]].split()


# Entries of exact sums, by row and column of a matrix.
ENTRY = "i int, j int, s decimal(38,0)"


def integer_vectors(column: pa.Array, scale: int, largest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Vectors as ``floor(scale * x)``: rows that are kept, their lengths, all their entries.

    A row stays if it is not null and all its entries are finite numbers with a
    result of at most ``largest``.
    """
    lengths = np.asarray(column.value_lengths().fill_null(0), dtype=np.int64)
    flat = column.flatten()
    known = np.asarray(flat.is_valid())
    values = np.asarray(flat.cast(pa.float64()).fill_null(0), dtype=np.float64)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(values * scale)
        good = known & np.isfinite(scaled) & (np.abs(scaled) <= largest)
    bad = np.concatenate(([0], np.cumsum(~good)))
    ends = np.cumsum(lengths)
    kept = np.asarray(column.is_valid()) & (bad[ends] == bad[ends - lengths])
    entries = np.repeat(kept, lengths)
    return np.flatnonzero(kept), lengths[kept], scaled[entries].astype(np.int64)


def entry_batch(i: np.ndarray, j: np.ndarray, sums: np.ndarray) -> pa.RecordBatch:
    """Exact sums as rows of ``ENTRY``."""
    values = pa.array([Decimal(int(x)) for x in sums.tolist()], pa.decimal128(38, 0))
    return pa.RecordBatch.from_arrays(
        [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), values], names=["i", "j", "s"]
    )
