"""Sets of word shingles as 64-bit hashes, worked out in numpy, and their sketches."""

from __future__ import annotations

import numpy as np

WORDS = 5
SKETCH = 128  # minimum hashes kept of a set

_GAPS = np.zeros(256, bool)
_GAPS[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20)
_MULTIPLIERS = _rng.integers(0, 1 << 63, SKETCH, dtype=np.uint64)[:, None] | np.uint64(1)
_STEPS = _rng.integers(0, 1 << 63, WORDS, dtype=np.uint64) | np.uint64(1)


def _powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64, by doubling."""
    out = np.ones(1, np.uint64)
    while len(out) < n:
        out = np.concatenate([out, out * np.uint64(pow(base, len(out), 1 << 64))])
    return out[:n]


_up, _down = _powers(_BASE, 1 << 16), _powers(_INVERSE, 1 << 16)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over all."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the runs of ``words`` words of a text.

    A text of fewer words has one shingle, all its words; one without words has
    none. The hash of a word is a polynomial of its bytes, read off running sums.
    """
    global _up, _down
    data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
    if len(data) > len(_up):
        _up, _down = _powers(_BASE, 2 * len(data)), _powers(_INVERSE, 2 * len(data))
    inside = np.concatenate([[False], ~_GAPS[data], [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if not len(starts):
        return np.empty(0, np.uint64)
    sums = np.concatenate([[np.uint64(0)], np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _up[:len(data)])])
    word = mixed((sums[ends] - sums[starts]) * _down[starts])
    n = min(words, len(word))
    total = np.full(len(word) - n + 1, np.uint64(n))
    for k in range(n):
        total += word[k:len(word) - n + 1 + k] * _STEPS[k % WORDS]
    return np.unique(mixed(total))


def minimum_hashes(shingles: np.ndarray) -> np.ndarray:
    """``SKETCH`` minimum hashes of a set that is not empty."""
    lowest = np.full(SKETCH, np.uint64(0xFFFFFFFFFFFFFFFF))
    for at in range(0, len(shingles), 1024):  # bounds the memory for very long texts
        lowest = np.minimum(lowest, (_MULTIPLIERS * shingles[None, at:at + 1024]).min(axis=1))
    return lowest
