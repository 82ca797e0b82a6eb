"""64-bit hashes of all words of a text at once.

A word is a run of bytes of a class.  Its hash is a polynomial in a fixed odd
base over fixed random numbers that stand for the bytes, taken from prefix
sums over the whole text, so no word becomes an object.  Everything is modulo
2 ** 64; a last mixing spreads the result over all bits.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240229)
_LETTERS = _RNG.integers(0, 2**64, 256, dtype=np.uint64)
# 3 modulo 8: powers of it stay as far from 1 as powers modulo 2 ** 64 can
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 2**64)
# Texts are hashed in blocks that end between words.
BLOCK = 1 << 20


def _class(members: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(members)] = True
    return out


#: all but the six ASCII white-space characters
NOT_SPACE = ~_class(b" \t\n\v\f\r")
#: ASCII letters and digits, and every byte of a longer character
LETTERS_DIGITS = _class(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz" + bytes(range(128, 256)))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


class _Tables:
    """Powers of the base and of its inverse, as many as were needed so far."""

    up = _powers(_BASE, BLOCK + 1)
    down = _powers(_INVERSE, BLOCK + 1)

    @classmethod
    def of(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n < len(cls.up):
            return cls.up[:n], cls.down[:n + 1]
        return _powers(_BASE, n), _powers(_INVERSE, n + 1)


def _block(data: np.ndarray, members: np.ndarray) -> np.ndarray:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = members[data]
    edge = np.diff(inside)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _Tables.of(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_LETTERS[data] * up, out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts])


def run_hashes(text: bytes, members: np.ndarray = NOT_SPACE) -> np.ndarray:
    """Hashes of the maximal runs of ``members`` in ``text``, in order."""
    data = np.frombuffer(text, np.uint8)
    if len(data) <= BLOCK:
        return _block(data, members)
    parts, at = [], 0
    while at < len(data):
        end = min(at + BLOCK, len(data))
        while end < len(data) and members[data[end]]:      # to the end of the word
            outside = np.flatnonzero(~members[data[end:end + BLOCK]])
            end = end + int(outside[0]) if len(outside) else min(end + BLOCK, len(data))
        parts.append(_block(data[at:end], members))
        at = end
    return np.concatenate(parts)


def word_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words of a text, A-Z lower-cased; null counts as empty."""
    return run_hashes((text or "").encode("utf-8", "surrogatepass").lower())
