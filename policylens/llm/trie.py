"""Elias-Fano sequences and an n-gram trie on them.

A monotone sequence keeps the low bits of its values as they are and the high
parts in unary; an element, or the first element not below a value, is found
by selecting a one or a zero in the unary part.  The trie has three levels.
Level 1 is the vocabulary.  Level 2 holds, context by context, the words that
follow it.  Level 3 holds what follows a pair, each word by its place among
the followers of the pair's last word, which is a much smaller number than
its place in the vocabulary.  Each level has its values and pointers as
Elias-Fano sequences and its log probabilities and back-off weights in 16 bits.
All levels lie in one file that is mapped into memory.
"""

from __future__ import annotations

import tempfile
from dataclasses import dataclass
from typing import BinaryIO

import numpy as np

# --- quantised logarithms ----------------------------------------------------------------------

LOWEST = -16.0
STEPS = 65_535


def quantise(log10: np.ndarray) -> np.ndarray:
    """A fixed grid, so that a text's score does not depend on what it is scored with."""
    return np.rint(np.clip(log10 / LOWEST, 0, 1) * STEPS).astype(np.uint16)


def restore(steps: np.ndarray) -> np.ndarray:
    return steps * (LOWEST / STEPS)


# --- bits --------------------------------------------------------------------------------------

#: _SELECT[8 * b + r]: the place of the r-th one in byte b
_SELECT = np.array([([i for i in range(8) if b >> i & 1] + [0] * 8)[:8] for b in range(256)], np.int64).ravel()


def _packed(bits: np.ndarray) -> np.ndarray:
    """Bits as 64-bit words with one word to spare."""
    raw = np.packbits(bits, bitorder="little")
    out = np.zeros((len(raw) + 7) // 8 * 8 + 8, np.uint8)
    out[:len(raw)] = raw
    return out.view(np.uint64)


def _select(words: np.ndarray, before: np.ndarray, k: np.ndarray, ones: bool) -> np.ndarray:
    """The place of the k-th one (or zero); ``before`` counts those before each word."""
    at = np.searchsorted(before, k, "right") - 1
    word = words[at] if ones else ~words[at]
    rest, place = k - before[at], at * 64
    for width in (32, 16, 8):                             # the half that holds it, down to a byte
        lower = np.bitwise_count(word & np.uint64((1 << width) - 1)).astype(np.int64)
        upper = rest >= lower
        rest -= lower * upper
        step = upper * width
        place += step
        word = word >> step.astype(np.uint64)
    return place + _SELECT[(word & np.uint64(255)).astype(np.int64) * 8 + rest]


@dataclass
class EliasFano:
    """A non-decreasing sequence of ``n`` numbers below ``universe``."""

    n: int
    low_bits: int
    low: np.ndarray
    high: np.ndarray
    ones: np.ndarray
    zeros: np.ndarray

    ARRAYS = ("low", "high", "ones", "zeros")

    @classmethod
    def of(cls, values: np.ndarray, universe: int) -> EliasFano:
        values = values.astype(np.uint64)
        n = len(values)
        low_bits = max(0, (universe // max(1, n)).bit_length() - 1)
        bits = np.arange(low_bits, dtype=np.uint64)
        low = np.concatenate([np.zeros((0, low_bits), bool), *[
            (values[at:at + 65_536, None] >> bits & np.uint64(1)).astype(bool) for at in range(0, n, 65_536)]])
        top = int(universe >> low_bits) + 1
        unary = np.zeros(n + top + 1, bool)
        unary[(values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)] = True
        high = _packed(unary)
        per_word = np.bitwise_count(high).astype(np.int64)
        ones = np.concatenate([[0], np.cumsum(per_word)])
        return cls(n, low_bits, _packed(low.ravel()), high, ones, np.arange(len(ones)) * 64 - ones)

    def _low(self, i: np.ndarray) -> np.ndarray:
        if not self.low_bits:
            return np.zeros(len(i), np.uint64)
        bit = i.astype(np.uint64) * np.uint64(self.low_bits)
        word, shift = (bit >> np.uint64(6)).astype(np.int64), bit & np.uint64(63)
        # a shift by 64 is undefined: the upper word moves in two steps
        above = self.low[word + 1] << (np.uint64(63) - shift) << np.uint64(1)
        return (self.low[word] >> shift | above) & np.uint64((1 << self.low_bits) - 1)

    def at(self, i: np.ndarray) -> np.ndarray:
        """Elements by their places."""
        i = np.asarray(i, np.int64)
        high = (_select(self.high, self.ones, i, True) - i).astype(np.uint64)
        return high << np.uint64(self.low_bits) | self._low(i)

    def successor(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each value the place of the first element not below it (``n`` if
        there is none), and whether that element equals it."""
        values = np.asarray(values, np.uint64)
        high = (values >> np.uint64(self.low_bits)).astype(np.int64)
        want = values & np.uint64((1 << self.low_bits) - 1)
        end = _select(self.high, self.zeros, high, False) - high
        lo = np.where(high > 0, _select(self.high, self.zeros, np.maximum(high - 1, 0), False) - high + 1, 0)
        hi, last = end.copy(), max(self.n - 1, 0)
        while True:                                       # among elements of the same high part
            open_ = np.flatnonzero(lo < hi)
            if not len(open_):
                break
            mid = (lo[open_] + hi[open_]) // 2
            below = self._low(mid) < want[open_]
            lo[open_] = np.where(below, mid + 1, lo[open_])
            hi[open_] = np.where(below, hi[open_], mid)
        equal = lo < end
        equal[equal] = self._low(np.minimum(lo[equal], last)) == want[equal]
        return lo, equal


# --- trie --------------------------------------------------------------------------------------

@dataclass
class Level:
    """Children of the nodes above: values relative to the context, where each
    node's children begin, their log probabilities, and their back-off weights."""

    values: EliasFano
    begins: EliasFano
    span: int
    prob: np.ndarray
    back: np.ndarray

    @classmethod
    def of(cls, parent: np.ndarray, child: np.ndarray, parents: int, span: int, prob: np.ndarray,
           back: np.ndarray) -> Level:
        """From (parent, child) pairs sorted by both; children are below ``span``."""
        counts = np.bincount(parent, minlength=parents)
        begins = np.concatenate([[0], np.cumsum(counts)])
        return cls(EliasFano.of(parent.astype(np.int64) * span + child, max(1, parents * span)),
                   EliasFano.of(begins, len(parent) + 1), span, quantise(prob), quantise(back))

    def find(self, parent: np.ndarray, child: np.ndarray) -> np.ndarray:
        """Places of the children, -1 where the parent has no such child."""
        place, equal = self.values.successor(parent.astype(np.int64) * self.span + child)
        return np.where(equal, place, -1)


@dataclass
class NgramTrie:
    """Word ids 0..V-1 are known words, V is the beginning, -1 an unknown word."""

    size: int
    prob: np.ndarray
    back: np.ndarray
    unknown: float
    pairs: Level
    triples: Level

    def pair_nodes(self, last: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places of the pairs, -1 where the model has none."""
        node = np.full(len(word), -1, np.int64)
        both = np.flatnonzero((last >= 0) & (word >= 0))
        node[both] = self.pairs.find(last[both], word[both])
        return node

    def after_word(self, last: np.ndarray, word: np.ndarray, node: np.ndarray) -> np.ndarray:
        """log10 probability of each ``word`` after the one word ``last``; ``node`` is their pair's place."""
        single = np.where(word >= 0, restore(self.prob[np.maximum(word, 0)]), self.unknown)
        out = single + np.where(last >= 0, restore(self.back[np.maximum(last, 0)]), 0.0)
        have = np.flatnonzero(node >= 0)
        out[have] = restore(self.pairs.prob[node[have]])
        return out

    def back_off(self, context: np.ndarray) -> np.ndarray:
        """What a word costs that does not follow the pair at ``context``."""
        return restore(self.pairs.back[context])

    def triple_nodes(self, context: np.ndarray, last: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Places of the triples whose first two words are the pair at ``context``
        and whose last two, beginning with ``last``, are the pair at ``node``."""
        out = np.full(len(node), -1, np.int64)
        have = np.flatnonzero((context >= 0) & (node >= 0))
        place = node[have] - self.pairs.begins.at(last[have]).astype(np.int64)
        inside = place < self.triples.span
        have, place = have[inside], place[inside]
        out[have] = self.triples.find(context[have], place)
        return out

    def score(self, before: np.ndarray, last: np.ndarray, word: np.ndarray) -> np.ndarray:
        """log10 probability of each ``word`` after (``before``, ``last``); ``before``
        is -2 where the context is only one long."""
        node = self.pair_nodes(last, word)
        out = self.after_word(last, word, node)
        # the longer context, where the model has it
        longer = (before >= 0) & (last < self.size)
        context = self.pair_nodes(np.where(longer, before, -1), last)
        have = np.flatnonzero(context >= 0)
        out[have] += self.back_off(context[have])
        found = self.triple_nodes(context, last, node)
        known = np.flatnonzero(found >= 0)
        out[known] = restore(self.triples.prob[found[known]])
        return out

    # --- one file, mapped ---

    def _arrays(self) -> list[tuple[object, str]]:
        out: list[tuple[object, str]] = [(self, "prob"), (self, "back")]
        for level in (self.pairs, self.triples):
            out += [(level, "prob"), (level, "back")]
            out += [(ef, name) for ef in (level.values, level.begins) for name in EliasFano.ARRAYS]
        return out

    def mapped(self, file: BinaryIO | None = None) -> NgramTrie:
        """Write every array to ``file`` (default: a nameless temporary one, gone
        when the trie is) and use them from there."""
        file = file or tempfile.TemporaryFile()
        places = []
        for owner, name in self._arrays():
            a = np.ascontiguousarray(getattr(owner, name))
            file.write(b"\0" * (-file.tell() % 8))
            places.append((owner, name, a.dtype, a.shape, file.tell()))
            file.write(a.tobytes())
        file.flush()
        for owner, name, dtype, shape, at in places:
            if shape[0]:
                setattr(owner, name, np.memmap(file, dtype, "r", at, shape))
        return self


def build_trie(single: np.ndarray, pair: tuple[np.ndarray, np.ndarray, np.ndarray],
               triple: tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray], texts: int, total: int, sorts: int,
               discount: float, pair_weight: float, triple_weight: float, least_context: int) -> NgramTrie:
    """A trie from counts: ``single`` per word; ``pair`` (last, word, count)
    sorted by both, last V meaning the beginning; ``triple`` (place in ``pair``
    of the context, its last word, place in ``pair`` of the last two words, count).

    Words: counts less ``discount``, the rest of the mass to the one unknown
    word.  After a context of count c, a word of count n has probability
    (n + weight * shorter) / (c + weight), where ``shorter`` is its
    probability after the context without its first word; the back-off weight
    is weight / (c + weight).  Pairs of count ``least_context`` on are contexts."""
    size = len(single)
    if not total:
        unknown = 1.0
    else:
        unknown = discount * sorts / total
    p1 = (single - discount) / max(1, total)
    context1 = np.concatenate([single, [texts]]).astype(float)
    last, word, n2 = pair
    p2 = (n2 + pair_weight * p1[word]) / (context1[last] + pair_weight)
    usable = n2 >= least_context
    back2 = np.where(usable, np.log10(triple_weight / (n2 + triple_weight)), 0.0)
    pairs = Level.of(last, word, size + 1, max(1, size), np.log10(p2), back2)
    node, middle, followed, n3 = triple
    place = followed - np.concatenate([[0], np.cumsum(np.bincount(last, minlength=size + 1))])[middle]
    p3 = (n3 + triple_weight * p2[followed]) / (n2[node] + triple_weight)
    span = int(place.max()) + 1 if len(place) else 1
    order = np.argsort(node * span + place, kind="stable")
    triples = Level.of(node[order], place[order], max(1, len(last)), span, np.log10(p3[order]), np.zeros(len(node)))
    # the spare place keeps an empty vocabulary addressable
    return NgramTrie(size, quantise(np.log10(np.append(p1, 1.0))), quantise(np.log10(pair_weight / (context1 + pair_weight))),
                     float(np.log10(unknown)), pairs, triples)
