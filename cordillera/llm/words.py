"""Words of many texts at once, as arrays.

A word is a run of bytes other than U+0020 and U+0009-U+000D.  Each word gets a
64-bit hash from prefix sums of a polynomial in an odd base modulo 2**64, whose
inverse powers exist, so a word of any length costs as much as any other; sequences
of words are hashed the same way over the words' hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .bpe import buffers
from .common import FORGET

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
#: Texts of about so many bytes are cut into words at once.
BATCH_BYTES = 1_000_000

_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers_to(n: int) -> list[np.ndarray]:
    if len(_powers[0]) <= n:
        size = max(n + 1, BATCH_BYTES + 1)
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            row = np.full(size, base, np.uint64)
            row[0] = 1
            _powers[k] = np.multiply.accumulate(row)
    return _powers


def _forget_powers() -> None:
    _powers[:] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


FORGET.append(_forget_powers)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))
#: For lower-casing A-Z only.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[32, *range(9, 14)]] = True


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of values[starts[i]:ends[i]] for each i, as a sequence."""
    powers, inverse = _powers_to(len(values))
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], out=prefix[1:])
    return mix((prefix[ends] - prefix[starts]) * inverse[starts])


@dataclass
class Words:
    """The words of a batch of texts: text i has words bounds[i] to bounds[i + 1]."""

    body: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray
    hashes: np.ndarray

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words of all runs of ``size`` words within one text, and the text of each."""
        counts = np.maximum(np.diff(self.bounds) - size + 1, 0)
        first = np.arange(counts.sum()) + np.repeat(self.bounds[:-1] - (np.cumsum(counts) - counts), counts)
        return first, np.repeat(np.arange(len(counts)), counts)

    def sequence_hashes(self, first: np.ndarray, size: int | np.ndarray) -> np.ndarray:
        return spans_hash(self.hashes, first, first + size)


def words_of(texts: pa.Array, lower: bool = False) -> Words:
    """Null texts have no words."""
    offsets, body = buffers(texts.cast(pa.large_string()).fill_null(""))
    if lower:
        body = LOWER[body]
    space = _IS_SPACE[body]
    gap = np.ones(len(body) + 1, bool)  # a text's end parts words as space does
    gap[:-1] = space
    begin = np.zeros(len(body) + 1, bool)
    begin[0] = True
    begin[1:] = gap[:-1]
    begin[offsets] = True
    starts = np.flatnonzero(begin[:-1] & ~space)
    stop = np.zeros(len(body) + 1, bool)
    stop[offsets] = True
    last = ~space & (gap[1:] | stop[1:])
    ends = np.flatnonzero(last) + 1
    bounds = np.searchsorted(starts, offsets)
    hashes = spans_hash(_BYTES[body], starts, ends)
    return Words(body, offsets, starts, ends, bounds, hashes)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", most: int = BATCH_BYTES) -> Iterator[pa.RecordBatch]:
    """The batches' rows in slices of about so many bytes of text; a longer text comes alone."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(sizes, (sizes[at - 1] if at else 0) + most, "right")))
            yield batch.slice(at, end - at)
            at = end
