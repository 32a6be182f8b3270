"""Hashed word shingles of texts with numpy, inside tasks."""

from __future__ import annotations

import hashlib

import numpy as np
import xxhash

# Odd multipliers of common 64-bit mixers.
_M = tuple(
    np.uint64(m)
    for m in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93)
)


class WordHashes(dict):
    """64-bit hash of each word, kept for the next time; emptied when it grows too large."""

    most = 500_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


def mixed(x: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * _M[1]
    x = (x ^ (x >> np.uint64(27))) * _M[2]
    return x ^ (x >> np.uint64(31))


def combined(values: np.ndarray, width: int) -> np.ndarray:
    """A hash for each run of ``width`` neighbours."""
    n = len(values) - width + 1
    total = mixed(values[:n] + _M[0])
    for k in range(1, width):
        total = mixed(total * _M[3] + values[k : n + k])
    return total


def shingle_set(words: list[bytes], width: int, hashes: WordHashes) -> np.ndarray:
    """Distinct shingles as signed 64-bit hashes in order; fewer words than ``width`` make one.

    Two different shingles fall together with probability 2⁻⁶⁴.
    """
    if not words:
        return np.empty(0, np.int64)
    values = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    return np.unique(combined(values, min(width, len(values))).view(np.int64))


def signature(shingles: np.ndarray) -> bytes:
    """128 bits that equal sets share."""
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


def lowered_words(text: str | None) -> list[bytes]:
    """Words between blanks, A-Z in lower case; null has none."""
    return [] if text is None else text.encode("utf-8", "replace").lower().split()
