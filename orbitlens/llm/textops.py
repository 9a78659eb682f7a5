"""Words and rolling hashes over whole Arrow string columns, vectorised with numpy.

A column is worked on in slices of a few megabytes of whole documents, so a task's memory
does not depend on the batch size; a single longer document makes a longer slice.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20

_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: everything but digits, letters and bytes above 0x7F separates words of the benchmark rule
_NOT_ALNUM = np.zeros(256, bool)
_NOT_ALNUM[:0x30] = True
_NOT_ALNUM[0x3A:0x61] = True
_NOT_ALNUM[0x7B:0x80] = True


def signed(values: np.ndarray) -> np.ndarray:
    """uint64 hashes as the longs of Spark."""
    return values.view(np.int64)


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of uint64 values (multiply and xor-shift rounds)."""
    x = values ^ (values >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """n odd uint64 multipliers."""
    return np.random.default_rng(seed).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE = constants(256, 11)
_STEP = int(constants(1, 12)[0])


def _powers(step: int, size: int) -> np.ndarray:
    """step**i for i < size, modulo 2**64, as products of two short tables."""
    low, high = np.full(1 << 12, step, np.uint64), np.full((size >> 12) + 1, pow(step, 1 << 12, 1 << 64), np.uint64)
    low[0] = high[0] = 1
    return np.multiply.outer(np.multiply.accumulate(high), np.multiply.accumulate(low)).reshape(-1)[:size]


@dataclass
class Words:
    """The words of a slice of documents: byte ranges in ``data`` and word ranges of documents."""

    data: np.ndarray  # bytes, upper case A-Z lowered on request
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # of each document and one more: number of its first word

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owners(self) -> np.ndarray:
        """The document number of each word."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of each word."""
        n = len(self.data)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[self.data] * _powers(_STEP, n), out=total[1:])
        back = _powers(pow(_STEP, -1, 1 << 64), n + 1)[self.starts]
        return mix((total[self.ends] - total[self.starts]) * back + (self.ends - self.starts).astype(np.uint64))

    def windows(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all windows of k words inside one document, and their documents."""
        owner = self.owners()
        if len(owner) < k:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        at = np.flatnonzero(owner[: len(owner) - k + 1] == owner[k - 1 :])
        return at, owner[at]


def window_hashes(word_hashes: np.ndarray, at: np.ndarray, k: int, seed: int) -> np.ndarray:
    """The hash of the k words from each position on."""
    if not len(at):
        return np.empty(0, np.uint64)
    n = len(word_hashes) - k + 1
    total = np.zeros(n, np.uint64)
    for j, c in enumerate(constants(k, seed)):
        total += word_hashes[j : j + n] * c
    return mix(total[at])


def slices(column: pa.Array | pa.ChunkedArray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, document bounds) of consecutive runs of about ``limit`` bytes; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    bounds = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    buffer = column.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.empty(0, np.uint8)
    lo = 0
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(bounds, bounds[lo] + limit, "right")) - 1)
        yield lo, hi, data[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
        lo = hi


def find_words(data: np.ndarray, bounds: np.ndarray, lower: bool = False, alnum: bool = False) -> Words:
    """Words parted by space, tab, newline, vertical tab, form feed, return; ``alnum``: by all ASCII but digits and letters."""
    if lower or alnum:
        data = _LOWER[data]
    word = ~(_NOT_ALNUM if alnum else _SPACES)[data]
    n = len(data)
    if not n:
        return Words(data, np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(bounds), np.int64))
    begin, end = word.copy(), word.copy()
    begin[1:] &= ~word[:-1]
    end[:-1] &= ~word[1:]
    edge = bounds[(bounds > 0) & (bounds < n)]
    begin[edge] |= word[edge]
    end[edge - 1] |= word[edge - 1]
    starts = np.flatnonzero(begin)
    return Words(data, starts, np.flatnonzero(end) + 1, np.searchsorted(starts, bounds))


def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums over the ranges that follow each other in ``bounds``; empty ranges give 0."""
    total = np.zeros(len(values) + 1, values.dtype if values.dtype != bool else np.int64)
    np.cumsum(values, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
