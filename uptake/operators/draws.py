"""The hash draws of the bootstrap, many at a time: ``hash_draw`` of ``resample`` in numpy, value for value."""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np

#: Positions hashed at once, so that the arrays stay in the processor's cache.
SLICE = 1 << 14
_TURNS = [s for turns in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for s in turns * 4]
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_STATE = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


@lru_cache(maxsize=128)
def _digits(low: int, high: int) -> list[np.ndarray]:
    """ASCII digits of ``low .. high - 1``, which all have the same number of them, first digit first."""
    rest, out = np.arange(low, high), []
    for _ in str(low):
        rest, digit = np.divmod(rest, 10)
        out.append((digit + 48).astype(np.uint8))
    return out[::-1]


def _words(prefix: bytes, low: int, high: int) -> list:
    """The 16 words of the md5 block of ``prefix`` and each number: one number where it is the same for all, else an array."""
    digits = _digits(low, high)
    size = len(prefix) + len(digits)
    if size > 55:
        raise ValueError("the text of a draw has at most 55 bytes")
    block = prefix + bytes(len(digits)) + b"\x80" + bytes(55 - size) + (8 * size).to_bytes(8, "little")
    words: list = np.frombuffer(block, "<u4").tolist()
    for k, digit in enumerate(digits, len(prefix)):
        words[k // 4] = words[k // 4] + (digit.astype(np.uint32) << np.uint32(8 * (k % 4)))
    return words


def _md5_head(prefix: bytes, low: int, high: int) -> np.ndarray:
    """First 15 hex digits of the md5 of ``prefix`` and each number, as an integer."""
    words = _words(prefix, low, high)
    a, b, c, d = (np.full(high - low, x, np.uint32) for x in _STATE)
    for i in range(64):
        if i < 16:
            f, k = d ^ (b & (c ^ d)), i
        elif i < 32:
            f, k = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            f, k = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, k = c ^ (b | ~d), 7 * i % 16
        f += a
        if isinstance(words[k], int):
            f += np.uint32((_SINES[i] + words[k]) & 0xFFFFFFFF)
        else:
            f += words[k]
            f += np.uint32(_SINES[i])
        turned = f << np.uint32(_TURNS[i])
        f >>= np.uint32(32 - _TURNS[i])
        turned |= f
        turned += b
        a, b, c, d = d, turned, b, c
    a += np.uint32(_STATE[0])
    b += np.uint32(_STATE[1])
    return a.byteswap().astype(np.uint64) << np.uint64(28) | b.byteswap().astype(np.uint64) >> np.uint64(4)


def hash_draws(seed: int, replicate: int, low: int, high: int, n: int) -> np.ndarray:
    """Draws ``low .. high - 1`` of a replicate, each in [0, n)."""
    prefix, parts = f"{seed}:{replicate}:".encode(), []
    while low < high:
        end = min(high, low + SLICE, 10 ** len(str(low)))
        parts.append(_md5_head(prefix, low, end) % np.uint64(n))
        low = end
    return np.concatenate(parts).astype(np.int64) if parts else np.empty(0, np.int64)
