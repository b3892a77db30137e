"""Hashes of words and of runs of words, for the operators on repeats and near copies."""

from __future__ import annotations

import numpy as np
import xxhash

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """64-bit hash by word in UTF-8; remembered, within bounds, as words repeat."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def runs(hashes: np.ndarray, k: int) -> np.ndarray:
    """A hash of each ``k`` words in a row."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    found = hashes[:n].copy()
    for j in range(1, k):
        found *= _FACTOR
        found += hashes[j : n + j]
    found ^= found >> np.uint64(29)
    found *= np.uint64(0xBF58476D1CE4E5B9)
    found ^= found >> np.uint64(32)
    return found
