"""Word shingles as sorted 64-bit hashes, on whole texts."""

from __future__ import annotations

import numpy as np
import xxhash

MAX_WORDS = 500_000


class WordHashes(dict):
    """word (bytes) to 64-bit hash; a cache that is emptied when it is full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > MAX_WORDS:
            self.clear()
        h = xxhash.xxh64_intdigest(word)
        if len(word) <= 64:
            self[word] = h
        return h


def words_of(text: str | None) -> list[bytes]:
    """Words of a text with A-Z lowered; only ASCII white space separates words."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(words: list[bytes], cache: WordHashes) -> np.ndarray:
    return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))


def combine(hashes: np.ndarray, k: int) -> np.ndarray:
    """One hash for each run of ``k`` neighbours."""
    n = len(hashes) - k + 1
    with np.errstate(over="ignore"):
        h = np.full(n, np.uint64(0x9E3779B97F4A7C15 + k))
        for j in range(k):
            h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + hashes[j : j + n]
        h ^= h >> np.uint64(30)
        h *= np.uint64(0x94D049BB133111EB)
        h ^= h >> np.uint64(31)
    return h


def shingle_set(text: str | None, k: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct shingle hashes; fewer than ``k`` words make one, none make none."""
    words = words_of(text)
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words, cache)
    return np.unique(combine(hashes, min(k, len(words))))
