"""Word shingles of whole texts as 64-bit hashes, in numpy, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

SHINGLE_WORDS = 5
MEMO_WORDS = 200_000
_U = np.uint64
_FACTORS = [_U(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


class WordHashes(dict):
    """Word -> 64-bit hash, remembered up to MEMO_WORDS words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijective mix of 64-bit values."""
    x = x ^ _U(salt)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def words_of(text: str) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of the text with A-Z in lower case."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def shingle_hashes(words: list[bytes], memo: WordHashes, size: int = SHINGLE_WORDS) -> np.ndarray:
    """A hash per place; the whole sequence as one shingle if it is shorter; none without words."""
    n = len(words)
    if not n:
        return np.empty(0, dtype=_U)
    h = np.fromiter(map(memo.__getitem__, words), dtype=_U, count=n)
    k = min(size, n)
    out = np.full(n - k + 1, k, dtype=_U)
    for i in range(k):
        out += h[i : n - k + 1 + i] * _FACTORS[i % 5] ^ _U(i)
    return mixed(out)
