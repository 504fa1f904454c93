"""Words and word shingles of whole texts as 64-bit numbers, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

from chirplens.llm.common import CACHED_WORDS

WIDTH = 5

# Odd multipliers of the shingle polynomial and the finishing steps.
_BASE = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xFF51AFD7ED558CCD)
_MIX2 = np.uint64(0xC4CEB9FE1A85EC53)
_S33 = np.uint64(33)


class WordHashes(dict):
    """Word to 64-bit hash, filled on demand and emptied when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> _S33)
    values = values * _MIX1
    values = values ^ (values >> _S33)
    values = values * _MIX2
    return values ^ (values >> _S33)


def words(text: str | None) -> list[bytes]:
    """Maximal runs without ASCII white space, A-Z in lower case (bytes methods do just this)."""
    return text.encode("utf-8", "replace").lower().split() if text else []


def word_hashes(text: str | None, cache: WordHashes) -> np.ndarray:
    found = words(text)
    return np.fromiter(map(cache.__getitem__, found), np.uint64, len(found))


def shingle_hashes(hashes: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """One value per shingle, in text order; a shorter sequence is one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    with np.errstate(over="ignore"):
        if n < width:
            total = np.uint64(n)
            for h in hashes:
                total = total * _BASE + h
            return mixed(np.array([total], np.uint64))
        total = hashes[: n - width + 1].copy()
        for k in range(1, width):
            total *= _BASE
            total += hashes[k : n - width + 1 + k]
        return mixed(total)


def shingle_set(text: str | None, cache: WordHashes, width: int = WIDTH) -> np.ndarray:
    """The distinct shingles of a text, sorted."""
    return np.unique(shingle_hashes(word_hashes(text, cache), width))


def set_key(sorted_set: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, as two signed 64-bit numbers."""
    digest = np.frombuffer(xxhash.xxh3_128_digest(sorted_set.tobytes()), np.int64)
    return int(digest[0]), int(digest[1])
