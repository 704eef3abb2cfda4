"""Word arrays of many texts at once.

A word is a run of bytes other than space and \\t \\n \\v \\f \\r. UTF-8 never
uses those bytes inside a longer character, so ``bytes.split()`` gives exactly
the words of the pattern ``[^\\x20\\x09-\\x0D]+``.
"""

from __future__ import annotations

import numpy as np
import xxhash

MASK = (1 << 64) - 1
#: Odd multipliers of the polynomial hash and of its finisher (fixed values).
BASE = 0x9E3779B97F4A7C15
MIX = np.uint64(0xD6E8FEB86659FD93)


class Index(dict):
    """Numbers distinct keys in order of first use."""

    def __missing__(self, key):
        n = self[key] = len(self)
        return n

    def number(self, words) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


def word_hashes(index: Index, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of each numbered word."""
    return np.fromiter((xxhash.xxh64_intdigest(w, seed) for w in index), np.uint64, len(index))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all 64 bits."""
    h = (h ^ (h >> np.uint64(32))) * MIX
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(32))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every run of ``n`` consecutive entries (not finished by :func:`mix`).

    Runs are joined by doubling, so the work is a few vector operations for any n.
    """
    if len(h) < n:
        return np.empty(0, np.uint64)
    out, width, length, block = None, 0, 1, h
    while n:
        if n & 1:
            if out is None:
                out, width = block, length
            else:
                m = len(h) - width - length + 1
                out = out[:m] * np.uint64(pow(BASE, length, MASK + 1)) + block[width : width + m]
                width += length
        n >>= 1
        if n:
            m = len(block) - length
            block = block[:m] * np.uint64(pow(BASE, length, MASK + 1)) + block[length : length + m]
            length *= 2
    return out


def sliding_min(h: np.ndarray, n: int) -> np.ndarray:
    """Minimum of every run of ``n`` consecutive entries."""
    if len(h) < n:
        return h[:0]
    width, block = 1, h
    while width * 2 <= n:
        block = np.minimum(block[:-width], block[width:])
        width *= 2
    rest = n - width
    return np.minimum(block[: len(block) - rest], block[rest:]) if rest else block


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Positions start .. start + length - 1 of every pair, one after the other."""
    total = int(lengths.sum())
    ends = np.cumsum(lengths)
    return np.arange(total) + np.repeat(starts - (ends - lengths), lengths)
