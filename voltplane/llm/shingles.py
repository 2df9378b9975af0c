"""Sets of hashed word shingles."""

from __future__ import annotations

import numpy as np
import xxhash

from .common import utf8
from .perfect_hash import mix

_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word -> 64-bit hash; emptied when it holds many words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 17:
            self.clear()
        h = xxhash.xxh3_64_intdigest(word)
        self[word] = h
        return h


def word_hashes(data: bytes, hashes: WordHashes, chunk: int = 4 << 20) -> np.ndarray:
    """The hashes of the words `[^\\x20\\x09-\\x0D]+` of UTF-8 data."""
    if len(data) <= chunk:
        words = data.split()
        return np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    parts, at = [], 0
    while at < len(data):
        end = at + chunk
        while end < len(data) and data[end] not in b" \t\n\x0b\x0c\r":
            end += 1
        words = data[at:end].split()
        parts.append(np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words)))
        at = end
    return np.concatenate(parts)


def windows(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for each k consecutive words; with fewer words, but not none, one hash of them all."""
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    size = min(k, n)
    out = np.full(n - size + 1, np.uint64(size), np.uint64)
    for i in range(size):
        out = out * _FACTOR + words[i : n - size + 1 + i]
    return mix(out, size)


def shingle_set(text: str | None, k: int, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of the k-word shingles of the text, A-Z lower-cased."""
    return np.unique(windows(word_hashes(utf8(text).lower(), hashes), k))


def set_key(tokens: np.ndarray) -> tuple[int, int]:
    """128 bits that are equal for equal sets."""
    return int(mix(tokens, 101).sum(dtype=np.uint64)), int(mix(tokens, 202).sum(dtype=np.uint64))
