"""Word shingles of texts as 64-bit hashes, in numpy over whole slices of rows.

Words are runs of characters other than ASCII white space, lower-cased in A-Z
only. A shingle is the hash of consecutive words in order.
"""

from __future__ import annotations

import numpy as np

from quarry.llm.common import odd_multipliers, splitmix

WORDS_KEPT = 150_000     # hashed words a worker remembers before it starts afresh


class WordHashes(dict):
    """Hash of each word met, computed once."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, text: str | None) -> np.ndarray:
        """Word hashes of a text in order; none for null."""
        if not text:
            return np.zeros(0, np.uint64)
        if len(self) > WORDS_KEPT:
            self.clear()
        words = text.encode("utf-8", "surrogatepass").lower().split()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Hash of every run of ``k`` words; a shorter text is one shingle of all its words."""
    n = len(words)
    if n == 0:
        return np.zeros(0, np.uint64)
    multipliers = odd_multipliers(k, 11)
    width = min(k, n)
    out = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        out += words[j:n - width + 1 + j] * multipliers[j]
    return splitmix(out)


def shingle_set(words: np.ndarray, k: int = 5) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(shingle_hashes(words, k))
