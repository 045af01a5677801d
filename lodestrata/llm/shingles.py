"""Word and shingle hashes of whole texts, for a batch of texts at a time.

A word's hash is a polynomial over its bytes with the powers of a fixed odd
number modulo 2**64, so that all words of a batch come from one running sum.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_FULL = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_STEP = np.uint64(0x9FB21C651E98DF25)
# Bytes of text worked on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20

BLANK = np.zeros(256, bool)
BLANK[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    values = values ^ (values >> np.uint64(33))
    values *= np.uint64(0xFF51AFD7ED558CCD)
    values ^= values >> np.uint64(33)
    values *= np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64)) | np.uint64(1)
_FOLDED = _BYTE[_LOWER]


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0], done = 1, 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out


class _Powers:
    """Powers of the base and of its inverse, as many as the longest slice needs."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        if len(self.up) <= n:
            size = max(n + 1, SLICE_BYTES + 1)
            self.up, self.down = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)


_POWERS = _Powers()


def slices(texts: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first, last + 1, bytes, offsets) of consecutive texts with up to ``most`` bytes; nulls are empty."""
    texts = texts.cast(pa.large_string())
    if not len(texts):
        return
    buffers = texts.buffers()
    offsets = np.frombuffer(buffers[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(buffers[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


def words(data: np.ndarray, offsets: np.ndarray, folded: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, lengths, first word of each text and the end) of all words; ASCII case is folded."""
    n = len(data)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    solid = ~BLANK[data]
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    before, after = np.zeros(n, bool), np.zeros(n, bool)
    before[1:], after[:-1] = solid[:-1], solid[1:]
    starts = np.flatnonzero(solid & (~before | cut[:n]))
    ends = np.flatnonzero(solid & (~after | cut[1:])) + 1
    _POWERS.reach(n)
    sums = (_FOLDED if folded else _BYTE)[data]
    sums *= _POWERS.up[:n]
    np.cumsum(sums, out=sums)
    first = np.where(starts > 0, sums[starts - 1], np.uint64(0))
    hashes = mix((sums[ends - 1] - first) * _POWERS.down[starts])
    return hashes, ends - starts, np.searchsorted(starts, offsets)


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """The hash of the ``n`` words from each word on; the last ``n - 1`` words have none."""
    if len(hashes) < n:
        return hashes[:0]
    out = hashes[: len(hashes) - n + 1].copy()
    for k in range(1, n):
        out = mix(out + _STEP) + hashes[k : len(hashes) - n + 1 + k]
    return mix(out)


def shingle_sets(texts: pa.Array, n: int = 5) -> Iterator[np.ndarray]:
    """For each text the sorted distinct hashes of its ``n``-word shingles.

    A text with fewer words has one shingle, all its words; a text without words has none.
    """
    for first, last, data, offsets in slices(texts):
        hashes, _, starts = words(data, offsets)
        runs = grams(hashes, n)
        for k in range(last - first):
            a, b = int(starts[k]), int(starts[k + 1])
            if b - a >= n:
                yield np.unique(runs[a : b - n + 1])
            elif b > a:
                yield grams(hashes[a:b], b - a) ^ np.uint64(b - a)
            else:
                yield hashes[:0]
