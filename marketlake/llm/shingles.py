"""Word shingles of a text as sorted 64-bit hashes (numpy, whole texts)."""

from __future__ import annotations

import numpy as np
import xxhash

WORDS = 5
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_FACTOR = 0x9E3779B97F4A7C15          # odd; its powers weigh the words of a shingle


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Words are runs of bytes other than space and \\x09-\\x0D, A-Z folded.
    A text of fewer than ``words`` words is one shingle; without words, none."""

    def __init__(self, words: int = WORDS):
        self.words = words
        self.powers = [np.uint64(pow(_FACTOR, k + 1, 1 << 64)) for k in range(words)]

    def of(self, text: str) -> np.ndarray:
        """Distinct shingle hashes, ascending."""
        tokens = text.encode().lower().split()
        n = len(tokens)
        if not n:
            return np.empty(0, np.uint64)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, n)
        k = min(n, self.words)
        out = np.zeros(n - k + 1, np.uint64)
        for i in range(k):
            out += h[i:n - k + 1 + i] * self.powers[i]
        if n < self.words:
            out += np.uint64(n)            # a short text is not a part of a shingle
        out = np.sort(mix(out))
        return out[np.concatenate([[True], out[1:] != out[:-1]])]
