"""Vectorised polynomial hashes of byte substrings.

``prefix[i]`` is the sum over j < i of T[byte j] * B**j modulo 2**64, so the hash
of bytes [s, e) is (prefix[e] - prefix[s]) * B**-s, finished by a mixer. T maps
bytes to fixed random odd numbers, B is odd and so has an inverse.
"""

from __future__ import annotations

import numpy as np

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        size = max(n, 2 * len(_powers[0]))
        for k, base in enumerate((_BASE, _INVERSE)):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


class Prefix:
    """Prefix sums of a byte buffer."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        power, self.inverse = _grow(n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_TABLE[buf] * power[:n], out=self.sums[1:])

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.sums[ends] - self.sums[starts]) * self.inverse[starts])

    def grams(self, q: int) -> np.ndarray:
        """Hash of the q bytes at every start."""
        n = len(self.sums) - q
        return mix((self.sums[q:] - self.sums[:n]) * self.inverse[:n])


def sliding(a: np.ndarray, w: int, op, fill) -> np.ndarray:
    """``op`` (np.minimum or np.maximum) over every window of w elements."""
    n = len(a)
    b = np.concatenate([a, np.full(-n % w, fill, a.dtype)]).reshape(-1, w)
    left = op.accumulate(b, axis=1).ravel()
    right = op.accumulate(b[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(right[:n - w + 1], left[w - 1:n])


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Start of every run of equal values, and the length at the end."""
    if not len(sorted_keys):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(sorted_keys[1:] != sorted_keys[:-1]) + 1,
                           [len(sorted_keys)]])
