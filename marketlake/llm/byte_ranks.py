"""Rolling byte-string hashes and window minima of one text (numpy)."""

from __future__ import annotations

import numpy as np

_FACTOR = 0x9E3779B97F4A7C15
_SYMBOLS = np.random.default_rng(400).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) \
    + np.uint64(1)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class Powers:
    """Powers of the factor and of its inverse modulo 2^64, grown on demand."""

    def __init__(self):
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def of(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up), 1 << 16)
            back = pow(_FACTOR, -1, 1 << 64)
            self.up, self.down = np.full(size, _FACTOR, np.uint64), np.full(size, back, np.uint64)
            self.up[0] = self.down[0] = 1
            self.up, self.down = np.cumprod(self.up), np.cumprod(self.down)
        return self.up[:n], self.down[:n]


_POWERS = Powers()


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class Ranks:
    """Hash ranks of the substrings of ``data``: equal strings, equal ranks."""

    def __init__(self, data: bytes):
        x = np.frombuffer(data, np.uint8)
        self.n = len(x)
        up, self.down = _POWERS.of(self.n + 1)
        self.sums = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_SYMBOLS[x] * up[:-1], out=self.sums[1:])

    def of(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        """Ranks of the strings at ``starts``; the length takes part."""
        raw = (self.sums[starts + lengths] - self.sums[starts]) * self.down[starts]
        return mix(raw + np.uint64(_FACTOR) * np.asarray(lengths).astype(np.uint64))

    def all_of(self, length: int) -> np.ndarray:
        """Ranks of every substring of one length."""
        if self.n < length:
            return np.empty(0, np.uint64)
        k = self.n - length + 1
        raw = (self.sums[length:] - self.sums[:k]) * self.down[:k]
        return mix(raw + np.uint64(_FACTOR * length % (1 << 64)))


def doubled(ranks: np.ndarray, offset: int, starts: np.ndarray) -> np.ndarray:
    """Ranks at twice the length: the pair (rank here, rank ``offset`` later)."""
    return mix(ranks[starts] * np.uint64(_FACTOR) + ranks[starts + offset])


def window_minima(x: np.ndarray, width: int) -> np.ndarray:
    """min(x[i:i + width]) for every full window."""
    n = len(x) - width + 1
    if n <= 0:
        return x[:0]
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(x.dtype).max, x.dtype)
    padded[:len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    behind = np.minimum.accumulate(grid, axis=1).reshape(-1)
    return np.minimum(ahead[:n], behind[width - 1:width - 1 + n])


def occurrences(x: np.ndarray, lo: np.ndarray, hi: np.ndarray, value: np.ndarray) -> np.ndarray:
    """How often ``value[k]`` stands in ``x[lo[k]:hi[k] + 1]``."""
    low = np.uint64(0xFFFF)
    maybe = np.zeros(1 << 16, bool)      # a cheap first test
    maybe[value & low] = True
    at = np.flatnonzero(maybe[x & low])
    known, which = np.unique(x[at], return_inverse=True)
    n = len(x) + 1
    keys = np.sort(which * n + at)
    own = np.searchsorted(known, value) * n
    return np.searchsorted(keys, own + hi, "right") - np.searchsorted(keys, own + lo, "left")
