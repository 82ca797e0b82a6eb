"""Minimal perfect hashing of a set of 64-bit keys.

Levels of bits: every key that alone hits its bit of a level has its place
there, the others go on to the next level with another hash.  A key's index
is the number of set bits before its own, over all levels, so n keys get the
indexes 0 to n - 1.  Keys that are not of the set get an index too, or none;
who looks up compares with the key stored at the index.
"""

from __future__ import annotations

import numpy as np

from policylens.llm.hashing import mix

# Bits of a level per key that reaches it.
BITS_PER_KEY = 2


def _bit(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    salted = keys.astype(np.uint64) + np.uint64((0x9E3779B97F4A7C15 * (level + 1)) % 2**64)
    return (mix(salted) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """``levels``: per level its bits, one byte each."""

    def __init__(self, levels: list[np.ndarray]):
        self.levels = levels
        # per bit, the set bits before it, over all levels
        self.ranks, total = [], 0
        for bits in levels:
            up_to = np.cumsum(bits, dtype=np.int64)
            self.ranks.append(total + up_to - bits)
            total += int(up_to[-1])
        self.size = total

    @classmethod
    def of(cls, keys: np.ndarray) -> PerfectHash:
        """``keys`` must be distinct."""
        levels, left = [], keys
        while len(left):
            size = max(64, BITS_PER_KEY * len(left))
            at = _bit(left, len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            levels.append(alone.astype(np.uint8))
            left = left[~alone[at]]
        return cls(levels)

    def index(self, keys: np.ndarray) -> np.ndarray:
        """The index of each key, -1 for some of those that are not of the set."""
        out, todo = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, (bits, ranks) in enumerate(zip(self.levels, self.ranks)):
            if not len(todo):
                break
            at = _bit(keys[todo], level, len(bits))
            hit = bits[at] == 1
            out[todo[hit]] = ranks[at[hit]]
            todo = todo[~hit]
        return out

    def to_bytes(self) -> bytes:
        sizes = np.array([len(self.levels), *map(len, self.levels)], np.int64)
        return sizes.tobytes() + b"".join(np.packbits(bits).tobytes() for bits in self.levels)

    @classmethod
    def from_bytes(cls, data: bytes) -> PerfectHash:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        sizes = np.frombuffer(data, np.int64, n, 8)
        at, levels = 8 * (n + 1), []
        for size in map(int, sizes):
            packed = np.frombuffer(data, np.uint8, (size + 7) // 8, at)
            levels.append(np.unpackbits(packed, count=size))
            at += len(packed)
        return cls(levels)
