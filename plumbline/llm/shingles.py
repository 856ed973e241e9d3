"""Sets of word shingles as 64-bit hashes, and their circulant MinHash."""

from __future__ import annotations

import numpy as np

from plumbline.llm.arrow import chunks
from plumbline.llm.tokens import Powers, hashes, mixed, parts

WORDS = 5

# Odd factors, one for each place in a shingle.
_PLACES = mixed(np.arange(1, WORDS + 1, dtype=np.uint64)) | np.uint64(1)


def _distinct(x: np.ndarray) -> np.ndarray:
    x = np.sort(x)
    return x[np.concatenate(([True], x[1:] != x[:-1]))] if len(x) > 1 else x


def shingle_sets(texts: list[bytes | None], powers: Powers) -> list[np.ndarray]:
    """The sorted distinct shingles of each text.

    A text of fewer than five words is one shingle, a text without words the empty set.
    """
    out = []
    for a, b in parts(texts):
        h, first = hashes(texts[a:b], powers)
        last = max(0, len(h) - WORDS + 1)
        windows = h[:last] * _PLACES[0]
        for i in range(1, WORDS):
            windows += h[i : last + i] * _PLACES[i]
        windows = mixed(windows)
        for start, end in zip(first[:-1].tolist(), first[1:].tolist()):
            if end - start >= WORDS:
                out.append(_distinct(windows[start : end - WORDS + 1]))
            else:
                short = h[start:end] * _PLACES[: end - start]
                whole = short.sum(keepdims=True, dtype=np.uint64) + np.uint64(end - start)
                out.append(mixed(whole) if end > start else h[:0])
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small):
        return 0
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    return int((large[at] == small).sum())


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the sets' similarity reaches the limit; two empty sets are not linked."""
    small, large = sorted((len(a), len(b)))
    if 100 * small < percent * large:
        return False
    shared = overlap(a, b)
    return shared > 0 and 100 * shared >= percent * (len(a) + len(b) - shared)


class Circulant:
    """Signatures from two permutations of the 32-bit numbers.

    The first permutation scatters a set once. Coordinate ``k`` is the minimum of the second
    permutation after a circular shift of the scattered set by ``k``, so no coordinate needs a
    permutation of its own.
    """

    STEP = 1 << 15

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows = bands, rows

    @staticmethod
    def _first(x: np.ndarray) -> np.ndarray:
        y = (x ^ (x >> np.uint64(32))).astype(np.uint32)
        y = (y ^ (y >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
        y = (y ^ (y >> np.uint32(12))) * np.uint32(0x297A2D39)
        return y ^ (y >> np.uint32(15))

    @staticmethod
    def _second(y: np.ndarray, spare: np.ndarray) -> np.ndarray:
        """In place; ``spare`` is a buffer of the same size."""
        for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
            np.right_shift(y, np.uint32(shift), out=spare)
            np.bitwise_xor(y, spare, out=y)
            np.multiply(y, np.uint32(factor), out=y)
        return y

    def signatures(self, sets: list[np.ndarray]) -> np.ndarray:
        """A row of coordinates for each set, none of which may be empty."""
        out = np.empty((self.bands * self.rows, len(sets)), dtype=np.uint32)
        sizes = np.array([len(s) for s in sets], dtype=np.int64)
        for a, b in chunks(sizes, self.STEP):
            scattered = self._first(np.concatenate(sets[a:b]))
            starts = np.concatenate(([0], np.cumsum(sizes[a : b - 1])))
            y, spare = np.empty_like(scattered), np.empty_like(scattered)
            for k in range(len(out)):
                np.add(scattered, np.uint32(k), out=y)
                np.minimum.reduceat(self._second(y, spare), starts, out=out[k, a:b])
        return out.T

    def band_keys(self, sets: list[np.ndarray]) -> np.ndarray:
        """A 64-bit key for each set and band."""
        if not sets:
            return np.empty((0, self.bands), dtype=np.int64)
        coordinates = self.signatures(sets).reshape(len(sets), self.bands, self.rows)
        key = mixed(np.arange(1, self.bands + 1, dtype=np.uint64))[None, :]
        for i in range(self.rows):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + coordinates[:, :, i])
        return np.ascontiguousarray(key).view(np.int64)
