"""Words, shingles and their hashes for whole Arrow batches of text, without a Python loop over words.

A batch is handled in slices of bounded bytes, so memory follows the slice and
the longest single text, never the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20

_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BYTE_VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


def fold_ascii(data: np.ndarray) -> np.ndarray:
    """Bytes with A-Z as a-z."""
    return _LOWER[data]


def blanks(data: np.ndarray) -> np.ndarray:
    """Where bytes are blank."""
    return _BLANK[data]


class _Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, SLICE_BYTES + 1)
            self.up, self.down = (
                np.cumprod(np.concatenate([[np.uint64(1)], np.full(size - 1, base, np.uint64)]), dtype=np.uint64)
                for base in (_ODD, pow(_ODD, -1, 1 << 64))
            )
        return self.up, self.down


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes so that every bit depends on every other."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets of a text column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    raw = column.buffers()
    if len(column) == 0 or raw[1] is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    offsets = np.frombuffer(raw[1], kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.zeros(0, np.uint8)
    return data, offsets


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes each; a longer text makes a range of its own."""
    start, rows = 0, len(offsets) - 1
    while start < rows:
        stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
        stop = min(max(stop, start + 1), rows)
        yield start, stop
        start = stop


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each span of bytes."""
    n = len(data)
    up, down = _POWERS.upto(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[data] * up[:n], out=total[1:])
    return mix((total[end] - total[start]) * down[start])


@dataclass
class Words:
    """Words of some texts: byte span, hash, and where each text's words begin."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # text i has words first[i] to first[i + 1]

    @property
    def text(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def words(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = _BLANK, fold: np.ndarray = _LOWER) -> Words:
    """Maximal runs of bytes outside ``separator``; A-Z count as a-z in the hash."""
    low, high = int(offsets[0]), int(offsets[-1])
    chars = fold[data[low:high]]
    own = offsets - low
    n = len(chars)
    inside = np.empty(n + 2, bool)
    inside[0] = inside[-1] = False
    np.logical_not(separator[chars], out=inside[1:-1])
    begins = inside[1:-1] & ~inside[:-2]
    ends = np.zeros(n + 1, bool)
    ends[1:] = inside[1:-1] & ~inside[2:]
    edges = own[(own > 0) & (own < n)]
    if len(edges):  # a word never crosses from one text into the next
        begins[edges] = inside[edges + 1]
        ends[edges] |= inside[edges]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    return Words(start + low, end + low, span_hashes(chars, start, end), np.searchsorted(start, own))


def shingles(found: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every run of ``k`` words, in text order, and the offsets by text.

    A text with fewer words, but some, has its whole sequence as its only shingle.
    """
    counts = np.diff(found.first)
    have = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    first = np.concatenate([[0], np.cumsum(have)])
    h = found.hash
    n = len(h)
    rolled = np.zeros(n, np.uint64)
    for j in range(min(k, n)):  # positions past the end are cut off below
        rolled[: n - j] = rolled[: n - j] * np.uint64(_ODD) + h[j:]
    at = np.repeat(found.first[:-1] - first[:-1], have) + np.arange(first[-1])
    out = mix(rolled[at])
    for i in np.flatnonzero((counts > 0) & (counts < k)):
        value = int(counts[i])
        for x in h[found.first[i] : found.first[i + 1]]:
            value = (value * 0xD6E8FEB86659FD93 + int(x)) & _MASK
        out[first[i]] = mix(np.array([value], np.uint64))[0]
    return out, first
