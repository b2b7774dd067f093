"""A minimal perfect hash over 64-bit keys, in numpy.

Keys are thrown into a bit array; those alone in their place are settled, the others go on
to the next, smaller array. A key's number is the count of set bits before its own.
"""

from __future__ import annotations

import numpy as np

_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(keys: np.ndarray, level: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = keys + _ODD * np.uint64(level + 1)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


class PerfectHash:
    """Numbers distinct keys from 0 without gaps. A key that was not in the set gets any
    number or -1: whoever probes compares a fingerprint."""

    def __init__(self, sizes: np.ndarray, bits: np.ndarray) -> None:
        self.sizes, self.bits = sizes, bits
        self.starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        ones = np.unpackbits(bits, bitorder="little").astype(np.int64).reshape(-1, 64).sum(axis=1)
        self.before = np.concatenate([[0], np.cumsum(ones)])
        self.words = bits.view(np.uint64)

    @classmethod
    def build(cls, keys: np.ndarray, spread: float = 1.7) -> PerfectHash:
        left, level, sizes, arrays = np.unique(keys.astype(np.uint64)), 0, [], []
        while len(left):
            size = max(64, -(-int(len(left) * spread) // 64) * 64)
            place = _mix(left, level) % np.uint64(size)
            alone = np.bincount(place.astype(np.int64), minlength=size) == 1
            sizes.append(size)
            arrays.append(np.packbits(alone, bitorder="little"))
            left, level = left[~alone[place.astype(np.int64)]], level + 1
        bits = np.concatenate(arrays) if arrays else np.zeros(0, np.uint8)
        return cls(np.array(sizes, np.int64), bits)

    def __len__(self) -> int:
        return int(self.before[-1])

    def number(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level, size in enumerate(self.sizes.tolist()):
            if not len(todo):
                break
            place = (_mix(keys[todo], level) % np.uint64(size)).astype(np.int64) + self.starts[level]
            word, bit = place >> 6, (place & 63).astype(np.uint64)
            hit = (self.words[word] >> bit & np.uint64(1)) == 1
            below = self.words[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1))
            out[todo[hit]] = self.before[word[hit]] + np.bitwise_count(below)
            todo = todo[~hit]
        return out
