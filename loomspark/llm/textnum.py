"""Vectorised text arithmetic on Arrow string columns: words, rolling fingerprints, window minima."""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_BASE = 0x9E3779B97F4A7C15 | 1
_BASE_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20260101).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Bytes or tokens handled at once.
PIECE = 2 << 20


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every bit (splitmix64)."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    def of(base: int) -> np.ndarray:
        out = np.full(n + 1, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    return of(_BASE), of(_BASE_INVERSE)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, for at least n positions."""
    size = PIECE
    while size < n:
        size *= 2
    return _powers(size)


class Rolling:
    """Fingerprints of any span of a byte or token array in constant time per span."""

    def __init__(self, values: np.ndarray, bytes_in: bool = True):
        n = len(values)
        up, self.down = powers(n)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((_TABLE[values] if bytes_in else values) * up[:n], out=self.sums[1:])

    def spans(self, start, end) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start])

    def grams(self, k: int) -> np.ndarray:
        """Of the k values from each position that has k."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[k:] - self.sums[:n]) * self.down[:n])


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string or binary column; null reads as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return (data[offsets[0] : offsets[-1]], offsets - offsets[0]) if len(offsets) else (data, np.zeros(1, np.int64))


def slices(offsets: np.ndarray, limit: int = PIECE):
    """Runs (lo, hi) of rows holding about limit bytes, one row at least."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = hi


def word_spans(data: np.ndarray, offsets: np.ndarray, gap: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end (bytes) of each word of consecutive rows; first[i]:first[i + 1] are the words of row i. gap: which bytes part words."""
    solid = ~gap[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[:1] = False
    before[1:] = solid[:-1]
    starts = np.flatnonzero(solid & (~before | edge[:n]))
    after = np.empty(n, bool)
    after[-1:] = False
    after[:-1] = solid[1:]
    ends = np.flatnonzero(solid & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """As word_spans, with the fingerprint of each word in front.

    Blocks of eight bytes are mixed, each with its number, before they are summed: sums of powers alone agree on words of a certain build
    (Thue-Morse sequences), whatever the base. Fingerprints name and part; what is decided on them is compared word by word first.
    """
    starts, ends, first = word_spans(data, offsets)
    hashes = np.empty(len(starts), np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(data) + 1, "<u8", padded, strides=(1,))  # the eight bytes from each place on
    at = 0
    while at < len(starts):  # a very long row is fingerprinted in pieces, so that the temporary arrays stay small
        to = max(at + 1, int(np.searchsorted(starts, starts[at] + PIECE)))
        size = ends[at:to] - starts[at:to]
        blocks = (size + 7) >> 3
        number = ranges(np.zeros(to - at, np.int64), blocks)
        left = np.repeat(size, blocks) - 8 * number
        part = eight[np.repeat(starts[at:to], blocks) + 8 * number]
        part &= np.uint64(0xFFFFFFFFFFFFFFFF) >> (8 * np.maximum(8 - left, 0)).astype(np.uint64)
        part = mix(part + (number + 1).astype(np.uint64) * np.uint64(_BASE))
        hashes[at:to] = mix(np.add.reduceat(part, starts_of(blocks)[:-1]) + size.astype(np.uint64))
        at = to
    return hashes, starts, ends, first


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number from 1 on for each word, equal for equal words alone, within this call."""
    size = ends - starts
    solid = np.ascontiguousarray(data[ranges(starts, size)])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(starts_of(size)), pa.py_buffer(solid)])
    return words.dictionary_encode().indices.to_numpy().astype(np.uint64) + np.uint64(1)


def joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words with one space behind each, and where each begins."""
    size = ends - starts
    place = starts_of(size + 1)
    blob = np.full(place[-1], 0x20, np.uint8)
    blob[ranges(place[:-1], size)] = data[ranges(starts, size)]
    return blob, place


def window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each run of width values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[: len(out) - step], out[step:])
        have += step
    return out


def starts_of(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Concatenated start, start + 1, ... of every run."""
    total = starts_of(lengths)
    return np.repeat(starts - total[:-1], lengths) + np.arange(total[-1])
