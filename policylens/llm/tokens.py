"""Token counts by heap-and-linked-list byte-pair merging.

A text is cut by the vocabulary's own pre-tokenizer into chunks.  The bytes
of a chunk form a linked list; a heap holds its adjacent pairs by merge rank
(leftmost first), and the lowest is popped and merged until none is left.
The count is the initial symbols minus the merges; no identifiers are made.
A chunk costs O(n log n), however long.

Defined results: a null text counts as empty and has 0 tokens.  The strings
of added tokens inside a text are one token each, as the library's default.
Ties and repeated rows are counted row by row; other columns are carried.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import LongType, StructField, StructType

from policylens.llm.common import with_results

# The pre-tokenizer's pattern, with the classes spelled out for
# texts of the first 256 code points, and Unicode's white space.
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LATIN_LETTER = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
LATIN_NUMBER = "0-9²³¹¼-¾"
# Chunks a Python worker remembers the count of; a full memory starts anew.
REMEMBERED = 600_000


def _pattern(letter: str, number: str) -> str:
    return (f"{CONTRACTIONS}| ?[{letter}]+| ?[{number}]+| ?[^{SPACE}{letter}{number}]+"
            f"|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


latin_chunks = re.compile(_pattern(LATIN_LETTER, LATIN_NUMBER)).findall
unicode_chunks = regex.compile(_pattern(r"\p{L}", r"\p{N}")).findall


def is_latin(text: str) -> bool:
    """All code points below 256."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


def byte_symbols() -> list[str]:
    """The character that stands for each byte: visible Latin-1 characters for
    themselves, the other bytes in order from code point 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in visible else next(hidden)) for b in range(256)]


class MergeCounter:
    """Counts tokens with the merges of a byte-level vocabulary file."""

    SHIFT = 20

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, pre = spec["model"], spec["pre_tokenizer"] or {}
        if (model["type"], pre.get("type"), pre.get("use_regex"), pre.get("add_prefix_space")) != (
                "BPE", "ByteLevel", True, False) or spec["normalizer"] or model.get("end_of_word_suffix"):
            raise ValueError(f"{path} is not a plain byte-level pair-merging vocabulary")
        vocab = model["vocab"]
        self.first = [vocab[s] for s in byte_symbols()]
        self.merges: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.merges.setdefault(vocab[a] << self.SHIFT | vocab[b], (rank, vocab[a + b]))
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.known: dict[str, int] = {}

    def chunk(self, chunk: str) -> int:
        """Tokens of one chunk."""
        symbols = [self.first[b] for b in chunk.encode("utf-8")]
        n, merges, shift = len(symbols), self.merges, self.SHIFT
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found[0], i) for i in range(n - 1) if (found := merges.get(symbols[i] << shift | symbols[i + 1]))]
        heapq.heapify(heap)
        left = n
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if symbols[i] < 0 or j >= n:
                continue                                  # merged away, or nothing follows any more
            found = merges.get(symbols[i] << shift | symbols[j])
            if found is None or found[0] != rank:
                continue                                  # the pair here has changed since
            symbols[i], symbols[j] = found[1], -1
            left -= 1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                if found := merges.get(symbols[i] << shift | symbols[k]):
                    heapq.heappush(heap, (found[0], i))
            h = before[i]
            if h >= 0 and (found := merges.get(symbols[h] << shift | symbols[i])):
                heapq.heappush(heap, (found[0], h))
        return left

    def _plain(self, text: str) -> int:
        chunks = latin_chunks(text) if is_latin(text) else unicode_chunks(text)
        known = self.known
        try:
            return sum(map(known.__getitem__, chunks))
        except KeyError:
            pass
        if len(known) > REMEMBERED:
            known.clear()
        for c in set(chunks):
            if c not in known:
                known[c] = self.chunk(c)
        return sum(map(known.__getitem__, chunks))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.added is None or not self.added.search(text):
            return self._plain(text)
        parts = self.added.split(text)
        return len(parts) - 1 + sum(self._plain(p) for p in parts if p)


@lru_cache(maxsize=2)
def counter(path: str) -> MergeCounter:
    """One per Python worker and vocabulary."""
    return MergeCounter(path)


def with_token_counts(df: DataFrame, vocabulary: str, text: str = "text", name: str = "n_tokens") -> DataFrame:
    """``df`` without ``text``, with the bytes (``n_bytes``) and the tokens
    (``name``) of it, which replace columns of these names.  ``vocabulary`` is
    a path that every executor can open."""
    schema = StructType([StructField("n_bytes", LongType()), StructField(name, LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(vocabulary).count
        for batch in batches:
            texts = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("carried"), pa.array([len((t or "").encode()) for t in texts], pa.int64()),
                 pa.array([count(t) for t in texts], pa.int64())], names=["carried", *schema.names])

    return with_results(df, run, schema, text)
