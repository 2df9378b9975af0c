"""A minimal perfect hash over 64-bit keys, made and asked in whole arrays.

Keys fall into a bit array by a hash of the level; those that fall alone are placed, the others go to the next, smaller level. A key's slot
is the rank of its bit over all levels, so n keys get the slots 0 .. n-1 at about three bits a key. What was never a key gets -1 or the slot
of some key: compare a fingerprint kept at the slot.
"""

from __future__ import annotations

import numpy as np

_LEVELS = 40


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser of keys and seed."""
    x = keys.astype(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class PerfectHash:
    def __init__(self, keys: np.ndarray):
        """keys: distinct, uint64."""
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        self.size, self.rest, rest = len(keys), np.zeros(0, np.uint64), keys.astype(np.uint64)
        placed = 0
        for level in range(_LEVELS):
            if not len(rest):
                break
            bits = -(-max(64, 2 * len(rest)) // 64) * 64
            at = (mix(rest, level + 1) % np.uint64(bits)).astype(np.int64)
            alone = np.bincount(at, minlength=bits) == 1
            words = np.packbits(alone, bitorder="little").view(np.uint64)
            ranks = placed + np.concatenate(([0], np.cumsum(np.bitwise_count(words).astype(np.int64))[:-1]))
            self.levels.append((bits, words, ranks))
            placed += int(alone.sum())
            rest = rest[~alone[at]]
        self.rest, self.placed = np.sort(rest), placed

    def slots(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key; -1 for some of what was never a key."""
        out, todo, keys = np.full(len(keys), -1, np.int64), np.arange(len(keys)), keys.astype(np.uint64)
        for level, (bits, words, ranks) in enumerate(self.levels):
            if not len(todo):
                return out
            at = mix(keys[todo], level + 1) % np.uint64(bits)
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            here = (words[word] >> bit) & np.uint64(1) == 1
            below = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
            out[todo[here]] = (ranks[word] + np.bitwise_count(below))[here]
            todo = todo[~here]
        if len(self.rest) and len(todo):
            at = np.minimum(np.searchsorted(self.rest, keys[todo]), len(self.rest) - 1)
            here = self.rest[at] == keys[todo]
            out[todo[here]] = self.placed + at[here]
        return out
