"""Word shingle sets of whole texts, as 64-bit numbers (used by the near-duplicate operator)."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE = 5
_CACHE_LIMIT = 200_000
_ROW = np.random.default_rng(20240511)
_COEF = _ROW.integers(0, 2**63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SHORT = np.uint64(0x9E3779B97F4A7C15)


class WordNumbers(dict):
    """word -> 64-bit hash, remembered; emptied when it holds too many words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > _CACHE_LIMIT:
            self.clear()
        number = self[word] = xxhash.xxh3_64_intdigest(word)
        return number


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply, twice)."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))


def shingles(text: str | None, words: WordNumbers) -> np.ndarray:
    """Sorted distinct shingle numbers of a text.

    A-Z become lower case, words are runs of ``[^\\x20\\x09-\\x0D]``; a text of fewer than five words
    is one shingle, a text without words none. ``bytes.lower`` and ``bytes.split`` treat exactly
    those characters.
    """
    if not text:
        return np.empty(0, np.uint64)
    found = text.encode("utf-8", "surrogatepass").lower().split()
    n = len(found)
    if not n:
        return np.empty(0, np.uint64)
    if n < SHINGLE:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(found), seed=n)], np.uint64) ^ _SHORT
    numbers = np.fromiter(map(words.__getitem__, found), np.uint64, n)
    total = numbers[: n - SHINGLE + 1] * _COEF[0]
    for i in range(1, SHINGLE):
        total = total + numbers[i : n - SHINGLE + 1 + i] * _COEF[i]
    return np.unique(mix(total))
