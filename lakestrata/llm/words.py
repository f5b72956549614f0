"""Words and word shingles as 64-bit numbers, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_GOLDEN = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


class WordHashes(dict):
    """64-bit hash of each word met so far; emptied between texts when it grows past ``limit`` entries."""

    def __init__(self, limit: int = 300_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit."""
    x = x + _GOLDEN
    x ^= x >> np.uint64(30)
    x *= _MIX[0]
    x ^= x >> np.uint64(27)
    x *= _MIX[1]
    x ^= x >> np.uint64(31)
    return x


def fold(columns: list[np.ndarray], seed: int = 0) -> np.ndarray:
    """One 64-bit hash per row of the given columns, sensitive to their order."""
    total = np.full(len(columns[0]), seed, np.uint64)
    for column in columns:
        total = mixed(total ^ column) * _MIX[1]
    return total


def ascii_words(text: str) -> list[bytes]:
    """Words between blanks and control blanks (20, 09-0D hex), A-Z in lower case."""
    return text.encode().lower().split()


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """The set of ``size``-word shingles, sorted; fewer words make one shingle, no words an empty set."""
    n = len(hashes)
    if not n:
        return hashes
    if n <= size:
        return fold([hashes[i : i + 1] for i in range(n)])
    return np.unique(fold([hashes[i : n - size + 1 + i] for i in range(size)]))
