"""Words of whole texts as numbers, for use inside Arrow batches.

A word is a run of bytes other than space and the control characters 9 to 13. Words and word sequences become 64-bit
hashes by polynomial sums, so the work per byte is a handful of array operations whatever the words look like. Texts
are taken in slices of a bounded number of bytes; a single longer text forms a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 21

_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit numbers over all bits (one to one)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=4)
def _byte_values(lower: bool, one_digit: bool) -> np.ndarray:
    codes = np.arange(256, dtype=np.uint64)
    if lower:
        codes[65:91] += np.uint64(32)
    if one_digit:
        codes[48:58] = 48
    return mix((codes + np.uint64(1)) * _BASE)


_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64, at least ``n`` of them."""
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SLICE_BYTES + 2)
        base = int(_BASE)
        inverse = pow(base, -1, 1 << 64)
        _POWERS[:] = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(size, b, np.uint64)]))
                      for b in (np.uint64(base), np.uint64(inverse))]
    return _POWERS[0], _POWERS[1]


_SPACE = np.zeros(256, bool)
_SPACE[[32, 9, 10, 11, 12, 13]] = True


class Words:
    """Words of some texts: ``hashes``, first and last byte (``starts``, ``ends``), and ``first[i]:first[i+1]`` of text i.

    ``lower`` takes A-Z for a-z, ``one_digit`` every digit for 0.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool, one_digit: bool = False):
        n = len(data)
        space = _SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        gap = np.ones(n + 2, bool)
        gap[1:-1] = space
        inside = ~space
        self.starts = np.flatnonzero(inside & (gap[:-2] | edge[:-1]))
        self.ends = np.flatnonzero(inside & (gap[2:] | edge[1:])) + 1
        power, back = _powers(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_byte_values(lower, one_digit)[data] * power[:n], out=sums[1:])
        length = (self.ends - self.starts).astype(np.uint64)
        self.hashes = mix((sums[self.ends] - sums[self.starts]) * back[self.starts] + length * _M2)
        self.first = np.searchsorted(self.starts, offsets)
        self.data, self._bytes = data, sums
        self._sums: np.ndarray | None = None

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def windows(self, size: int, at: np.ndarray | None = None) -> np.ndarray:
        """Hash of the ``size`` words that start at each word number in ``at`` (default: wherever as many follow)."""
        if at is None:
            at = np.arange(max(0, len(self.hashes) - size + 1))
        return self.runs(at, at + size)

    def runs(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the words from number ``first`` up to, not including, ``last``."""
        if self._sums is None:
            power, _ = _powers(len(self.hashes) + 1)
            self._sums = np.zeros(len(self.hashes) + 1, np.uint64)
            np.cumsum(self.hashes * power[:len(self.hashes)], out=self._sums[1:])
        back = _powers(len(self.hashes) + 1)[1]
        return mix((self._sums[last] - self._sums[first]) * back[first] + (last - first).astype(np.uint64) * _M1)

    def spans(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Hash of the bytes from ``first`` up to, not including, ``last``."""
        back = _powers(len(self.data) + 1)[1]
        return mix((self._bytes[last] - self._bytes[first]) * back[first] + (last - first).astype(np.uint64) * _M2)


def _raw(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array; a null is an empty text."""
    if texts.null_count:
        texts = texts.fill_null("")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(texts: pa.Array, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of at most ``size`` bytes in all, or one longer text: first, past the last, bytes, offsets."""
    data, offsets = _raw(texts)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + size, "right")) - 1)
        yield at, to, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def word_slices(texts: pa.Array, lower: bool = False, size: int = SLICE_BYTES) -> Iterator[tuple[int, int, Words]]:
    for at, to, data, offsets in slices(texts, size):
        yield at, to, Words(data, offsets, lower)
