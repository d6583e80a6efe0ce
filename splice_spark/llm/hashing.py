"""Vectorised 64-bit hashes of words and word windows (numpy, no Python loop over words)."""

from __future__ import annotations

import numpy as np

_RNG = np.random.Generator(np.random.PCG64(20240611))
_TABLE = _RNG.integers(0, 1 << 64, 64 * 256, dtype=np.uint64)
_ODD = _RNG.integers(0, 1 << 64, 64, dtype=np.uint64) | np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end (byte offsets) of each run of non-space bytes in ``buf``.

    A word's hash is the sum of random values for (place in the word, byte),
    mixed; places count modulo 64, with a factor for each further 64.
    """
    word = np.zeros(len(buf) + 2, bool)
    word[1:-1] = ~_SPACE[buf]
    edges = np.flatnonzero(word[1:] != word[:-1])
    starts, ends = edges[0::2], edges[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64), starts, ends
    lens = ends - starts
    first = np.concatenate(([0], np.cumsum(lens)[:-1]))
    place = np.arange(int(lens.sum()), dtype=np.int32) - np.repeat(first.astype(np.int32), lens)
    values = _TABLE[((place & 63) << 8) | buf[word[1:-1]]]
    if lens.max() > 64:
        steps = np.full(int(lens.max()) // 64 + 1, 0xD6E8FEB86659FD93, np.uint64)
        steps[0] = 1  # words of up to 64 bytes hash alike whatever stands beside them
        steps = np.cumprod(steps)
        values *= steps[place >> 6]
    return mix(np.add.reduceat(values, first)), starts, ends


def windows(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each ``n`` consecutive values; shorter than ``h`` by n - 1."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(m, np.uint64)
    for j in range(n):
        out += h[j : j + m] * _ODD[j]
    return mix(out)

