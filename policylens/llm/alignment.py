"""Alignment of two tokenizers over the same texts.

A text's bytes are cut by both tokenizers; wherever a token of each ends at
the same byte, a group ends.  Every token of the first in a group is linked
with every token of the second in it.  How many documents hold a pair of ids
linked is counted over the corpus, and every document's links are judged by
these counts.

First pass: documents are dealt into blocks of a few megabytes of text, one
row each.  A task aligns a block and gives, for every shard of the first
tokenizer's ids, the distinct pairs with the number of the block's documents
that hold them.  Per shard, the distinct pairs of all blocks get a minimal
perfect hash, with the pairs themselves stored at their indexes.  Every lane
of blocks turns its pairs into one dense vector of counts, and the vectors
of the lanes are summed: a tree of two levels.  A shard's size is bounded by
the two vocabularies, whatever the corpus.

Second pass: the blocks' pairs are looked up by their hash, each verified
against the stored pair, and go back to their block with the counts; the
block's texts are aligned again and their links counted by them.

Texts are cut for the tokenizers before a space that follows no space and
comes before no white space: neither tokenizer joins anything across it
(``Tokenizers`` checks that of the second's pieces).  What such a segment
gives is remembered; a segment that does not give back its own bytes has its
whole text encoded, and so decides nothing by itself.

Defined results: a text that is null, empty, or not given back byte for byte
by both tokenizers has no tokens and zeros.  Repeated rows and ids are
documents of their own.  Ties in the highest count all count as best.  A
very long text is a block by itself; in a long group pairs are counted by
multiplicity, never listed.  An empty table gives no rows.  Only doc_id and
text are read; other columns cannot clash.
"""

from __future__ import annotations

import hashlib
import math
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policylens.llm.common import shuffle_partitions, stage
from policylens.llm.perfect_hash import PerfectHash
from policylens.llm.tokens import _pattern, byte_symbols

SEGMENT = re.compile(r" (?:[^ ]+| (?!\S)|(?<= ) )*")
# A segment that does not stand in a text with others when it is encoded.
ODD_SEGMENT = re.compile(r"^$|^\s|[ ▁]|^.{200}", re.DOTALL).search
# Text bytes of a block, and blocks that one lane sums.
BLOCK_BYTES = 2 << 20
LANE_BLOCKS = 64
# Pairs that a shard can hold at most, by the size of the vocabularies.
SHARD_PAIRS = 1 << 24
# Segments a Python worker remembers, and encodes at once.
REMEMBERED = 200_000
MANY = 20_000
# Marks that are counted at once.
MARKS = 1 << 25
# Links of a group that are listed one by one before they are counted.
LARGE_GROUP = 4_096


def _sums(values: np.ndarray, which: np.ndarray, n: int) -> np.ndarray:
    """Whole-number sums of ``values`` by ``which`` of 0 to n - 1, ascending."""
    up_to = np.concatenate([[0], np.cumsum(values)])
    at = np.searchsorted(which, np.arange(n + 1))
    return up_to[at[1:]] - up_to[at[:-1]]


def segments_of(text: str) -> list[str]:
    """A text's segments, without the space that begins each."""
    parts = text.split(" ")
    if "" not in parts and parts == list(map(str.lstrip, parts)):
        return parts                                      # every space is such a place
    return [x[1:] for x in SEGMENT.findall(" " + text)]


class Segments:
    """What segments give, a row each: ``numbers`` (tokens of either tokenizer,
    groups, links; -1 where the bytes differ), the distinct linked pairs
    ``pairs[starts[i]:starts[i + 1]]``, how many ``times`` each is linked, and
    the groups as ``text``."""

    def __init__(self):
        self.numbers = np.zeros((0, 4), np.int64)
        self.starts = np.zeros(1, np.int64)
        self.pairs, self.times, self.text = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def __len__(self) -> int:
        return len(self.numbers)

    def add(self, numbers, sizes, pairs, times, text) -> None:
        self.numbers = np.concatenate([self.numbers, numbers])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        self.pairs, self.times = np.concatenate([self.pairs, pairs]), np.concatenate([self.times, times])
        self.text += text

    def of(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pairs of ``places`` one after the other, as places in ``pairs``,
        and which of ``places`` each belongs to."""
        sizes = self.starts[places + 1] - self.starts[places]
        which = np.repeat(np.arange(len(places)), sizes)
        return np.arange(len(which)) + np.repeat(self.starts[places] - (np.cumsum(sizes) - sizes), sizes), which


def _products(own: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``own`` items its number and each of 0 to n - 1 of its own."""
    which = np.repeat(np.arange(len(own)), n)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)


class Tokenizers:
    """The two tokenizers of a worker, and the segments it remembers."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.a.no_padding()
        self.a.no_truncation()
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        self.size_a, self.size_b = self.a.get_vocab_size(), self.b.get_piece_size()
        value = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
        added = {t.content for t in self.a.get_added_tokens_decoder().values()}
        plain = {bytes(value[c] for c in t): i for t, i in self.a.get_vocab().items() if t not in added}
        self.bytes_a = [b""] * self.size_a
        for token, i in plain.items():
            self.bytes_a[i] = token
        # the same merges by the rank of what they give, for many short segments at once
        self.ranked = tiktoken.Encoding("ranked", pat_str=_pattern(r"\p{L}", r"\p{N}"), mergeable_ranks=plain,
                                        special_tokens={})
        self.bytes_b = []
        for i in range(self.size_b):
            piece = self.b.id_to_piece(i)
            if re.search("[^▁]▁", piece):
                raise ValueError(f"{pieces}: a piece joins words, texts cannot be cut at spaces")
            self.bytes_b.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i)
                                else piece.replace("▁", " ").encode())
        self.lengths = np.array([*map(len, self.bytes_a)]), np.array([*map(len, self.bytes_b)])
        # "id," or at a group's end "id|" and "id;"
        self.written = [f"{i}{c}" for n, end in ((self.size_a, "|"), (self.size_b, ";")) for i in range(n)
                        for c in (",", end)]
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.found, self.groups = Segments(), False
        self.uses = np.zeros(0, np.int64)

    def forget_rare(self) -> None:
        """Keep the segments that were used more than once since the last time,
        if these are not too many themselves."""
        old, uses, known = self.found, self.uses, self.known
        names = [s for s, place in known.items() if uses[place] > 1]
        groups = self.groups
        self.forget()
        self.groups = groups
        if names and len(names) < REMEMBERED // 2:
            kept = np.array([known[s] for s in names])
            pairs, _ = old.of(kept)
            self.found.add(old.numbers[kept], old.starts[kept + 1] - old.starts[kept], old.pairs[pairs],
                           old.times[pairs], [old.text[i] for i in kept.tolist()])
            self.known = {s: i for i, s in enumerate(names)}
            self.uses = np.zeros(len(names), np.int64)

    def _add(self, texts: list[str], groups: bool) -> None:
        """Align texts, each as if a space were before it; those that may stand
        one after the other are encoded as one."""
        odd = list(filter(ODD_SEGMENT, texts))
        plain = list(set(texts).difference(odd)) if odd else texts
        for own, encode in ((plain, self._encoded_at_once), (odd, self._encoded)):
            for at in range(0, len(own), MANY):
                part = own[at:at + MANY]
                self.known.update(zip(part, range(len(self.found), len(self.found) + len(part))))
                self.found.add(*self._aligned(*(encode(part) or self._encoded(part)), groups))

    def _encoded_at_once(self, texts: list[str]):
        joined = " ".join(texts)
        data = joined.encode()
        a, b = self.ranked.encode_ordinary(" " + joined), self.b.encode(joined)
        if not b"".join(map(self.bytes_a.__getitem__, a)) == b" " + data == b"".join(map(self.bytes_b.__getitem__, b)):
            return None
        return np.array(a), np.array(b), np.array([*map(len, data.split(b" "))]) + 1, np.ones(len(texts), bool)

    def _encoded(self, texts: list[str]):
        """Each text by itself; those with other bytes are left out and marked."""
        data = [b" " + t.encode() for t in texts]
        ids_a = [e.ids for e in self.a.encode_batch([" " + t for t in texts], add_special_tokens=False)]
        ids_b = self.b.encode(texts, num_threads=1)
        good = np.array([b"".join(map(self.bytes_a.__getitem__, a)) == d == b"".join(map(self.bytes_b.__getitem__, b))
                         for d, a, b in zip(data, ids_a, ids_b)], bool)
        a, b = ([i for ids, ok in zip(own, good) if ok for i in ids] for own in (ids_a, ids_b))
        return np.array(a, np.int64), np.array(b, np.int64), np.array([*map(len, data)], np.int64)[good], good

    def _aligned(self, a: np.ndarray, b: np.ndarray, sizes: np.ndarray, good: np.ndarray, write: bool):
        """The segments of ``sizes`` bytes that the tokens ``a`` and ``b`` cut, those
        not ``good`` with -1.  Both tokenizers end a token where a segment ends."""
        ends_a, ends_b, ends = np.cumsum(self.lengths[0][a]), np.cumsum(self.lengths[1][b]), np.cumsum(sizes)
        both = np.intersect1d(ends_a, ends_b, assume_unique=True)
        in_a, in_b = np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)
        n_a, n_b = np.bincount(in_a, minlength=len(both)), np.bincount(in_b, minlength=len(both))
        of = np.searchsorted(ends, both)                  # the segment of each group
        numbers = np.full((len(good), 4), -1, np.int64)
        numbers[good] = np.stack([np.bincount(of[in_a], minlength=len(ends)), np.bincount(of[in_b], minlength=len(ends)),
                                  np.bincount(of, minlength=len(ends)),
                                  _sums(n_a * n_b, of, len(ends))], axis=1) if len(ends) else 0
        # pairs: each token of the first with its group's tokens of the second, by ids and multiplicity in large groups
        large = n_a * n_b > LARGE_GROUP
        small_a = np.flatnonzero(~large[in_a])
        which, nth = _products(small_a, n_b[in_a[small_a]])
        first_b = np.cumsum(n_b) - n_b
        token = small_a[which]
        keys = [a[token] * self.size_b + b[first_b[in_a[token]] + nth]]
        segment, times = [of[in_a[token]]], [np.ones(len(token), np.int64)]
        first_a = np.cumsum(n_a) - n_a
        for g in np.flatnonzero(large).tolist():
            x, nx = np.unique(a[first_a[g]:first_a[g] + n_a[g]], return_counts=True)
            y, ny = np.unique(b[first_b[g]:first_b[g] + n_b[g]], return_counts=True)
            keys.append((x[:, None] * self.size_b + y).ravel())
            times.append((nx[:, None] * ny).ravel())
            segment.append(np.full(len(keys[-1]), of[g]))
        keys, segment, times = np.concatenate(keys), np.concatenate(segment), np.concatenate(times)
        by = np.lexsort((keys, segment))
        keys, segment, times = keys[by], segment[by], times[by]
        new = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]) | (segment[1:] != segment[:-1])])
                             [:len(keys)])
        per_segment = np.zeros(len(good), np.int64)
        per_segment[good] = np.bincount(segment[new], minlength=len(ends))
        text = [""] * len(good)
        if write and len(ends):
            last_a = np.append(in_a[1:] != in_a[:-1], True)
            last_b = np.append(in_b[1:] != in_b[:-1], True)
            codes = np.concatenate([2 * a + last_a, 2 * (self.size_a + b) + last_b])
            group = np.concatenate([in_a, in_b])
            by = np.argsort(2 * group + np.repeat([0, 1], [len(a), len(b)]), kind="stable")
            parts = list(map(self.written.__getitem__, codes[by].tolist()))
            until = np.cumsum(numbers[good, 0] + numbers[good, 1]).tolist()
            for place, start, end in zip(np.flatnonzero(good).tolist(), [0, *until], until):
                text[place] = "".join(parts[start:end])[:-1]
        return numbers, per_segment, keys[new], np.add.reduceat(times, new) if len(new) else times, text

    def segments(self, texts: list[str | None], groups: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """The segments of all texts in order, as places in ``found`` that hold
        until the next call, and how many of them each text has: none for a
        text without tokens.  ``groups``: write the groups down, too (the same in
        all calls until ``forget``)."""
        cut = [segments_of(t) if t else [] for t in texts]
        if self.groups != groups:
            self.forget()
            self.groups = groups
        if len(self.found) > REMEMBERED:
            self.forget_rare()
        self._add(list(set().union(*cut).difference(self.known)), groups)
        n = np.array([*map(len, cut)], np.int64)
        places = np.fromiter(map(self.known.__getitem__, chain.from_iterable(cut)), np.int64, n.sum())
        self.uses = np.bincount(places, minlength=len(self.found)) + np.pad(
            self.uses, (0, len(self.found) - len(self.uses)))
        bad = self.found.numbers[places, 0] < 0
        if bad.any():                                     # a text with such a segment is encoded as a whole
            own = np.split(places, np.cumsum(n)[:-1])
            for i in np.unique(np.repeat(np.arange(len(n)), n)[bad]).tolist():
                self.found.add(*self._aligned(*self._encoded([texts[i]]), groups))
                own[i] = np.array([len(self.found) - 1] if self.found.numbers[-1, 0] >= 0 else [], np.int64)
            places, n = np.concatenate(own), np.array([*map(len, own)], np.int64)
        return places, n


@lru_cache(maxsize=2)
def tokenizers(byte_level: str, pieces: str) -> Tokenizers:
    """One per Python worker and pair of vocabularies."""
    return Tokenizers(byte_level, pieces)


def _blocks(docs: DataFrame, block_bytes: int) -> DataFrame:
    """(block, ids, texts): documents in the order read, a few megabytes a row."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([ids], pa.list_(pa.int64())), pa.array([texts], pa.list_(pa.string()))],
                names=["ids", "texts"])

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id"), batch.column("text")):
                text = text.as_py()
                if ids and size + len(text or "") > block_bytes:
                    yield row()
                    ids, texts, size = [], [], 0
                ids.append(doc_id.as_py()), texts.append(text)
                size += 16 + len(text or "")
        if ids:
            yield row()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "ids array<long>, texts array<string>")
    return stage(rows.withColumn("block", F.monotonically_increasing_id()), "align-blocks")


def _longs(values) -> bytes:
    return np.asarray(values, np.int64).tobytes()


def _of(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(columns)


def block_pairs(both: Tokenizers, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct pairs of some documents, and how many of these hold each."""
    places, n = both.segments(texts)
    found, ends = both.found, np.cumsum(n)
    own = np.flatnonzero(np.bincount(places, minlength=1))
    pair, _ = found.of(own)
    keys, number = np.unique(found.pairs[pair], return_inverse=True)
    number_at = np.zeros(len(found.pairs), np.int64)
    number_at[pair] = number
    counts, rows = np.zeros(len(keys), np.int64), max(1, MARKS // max(1, len(keys)))
    for at in range(0, len(n), rows):                     # a mark for each of some documents and pairs
        many = n[at:at + rows]
        here = places[ends[at] - n[at]:ends[at] + many[1:].sum()]
        pair, which = found.of(here)
        marks = np.zeros(len(many) * len(keys), bool)
        marks[np.repeat(np.arange(len(many)), many)[which] * len(keys) + number_at[pair]] = True
        counts += marks.reshape(len(many), -1).sum(axis=0)
    return keys, counts


def _pairs(blocks: DataFrame, byte_level: str, pieces: str, shards: int, lanes: int) -> DataFrame:
    """(block, shard, lane, keys, counts): a block's distinct pairs, sorted, with
    the documents of the block that hold each."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(byte_level, pieces)
        for batch in batches:
            for i in range(batch.num_rows):
                block, lane = batch.column("block")[i].as_py(), batch.column("lane")[i].as_py()
                keys, counts = block_pairs(both, batch.column("texts")[i].as_py())
                shard = keys // both.size_b % shards
                by = np.lexsort((keys, shard))
                keys, counts, shard = keys[by], counts[by], shard[by]
                own, starts = np.unique(shard, return_index=True)
                ends = [*starts[1:], len(keys)]
                if len(own):
                    yield _batch(block=np.full(len(own), block), shard=own, lane=np.full(len(own), lane),
                                 keys=[_longs(keys[a:b]) for a, b in zip(starts, ends)],
                                 counts=[_longs(counts[a:b]) for a, b in zip(starts, ends)])

    lane = F.pmod(F.xxhash64("block"), F.lit(lanes))
    return blocks.select("block", lane.alias("lane"), "texts").mapInArrow(
        run, "block long, shard long, lane long, keys binary, counts binary")


def _every_lane(lanes: int):
    """A row per lane; of the type that ``lane`` has in the pairs, since groups
    of two frames only meet where their keys have the same type."""
    return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(lanes - 1).cast("long")))


def _rows(table: pa.Table, *names: str) -> Iterator[tuple]:
    return zip(*[table.column(n).to_pylist() for n in names])


def _union(table: pa.Table) -> pa.Table:
    keys = np.unique(np.concatenate([_of(k) for k, in _rows(table, "keys")]))
    return pa.table({"shard": table.column("shard")[:1], "keys": [keys.tobytes()]})


def _hashed(table: pa.Table) -> pa.Table:
    """A shard's keys at their indexes, and the hash that finds them."""
    keys = np.unique(np.concatenate([_of(k) for k, in _rows(table, "keys")]))
    own = PerfectHash.of(keys)
    placed = np.empty_like(keys)
    placed[own.index(keys)] = keys
    return pa.table({"shard": table.column("shard")[:1], "hash": [own.to_bytes()], "placed": [placed.tobytes()]})


def _index(table: pa.Table) -> tuple[PerfectHash, np.ndarray]:
    return PerfectHash.from_bytes(table.column("hash")[0].as_py()), _of(table.column("placed")[0].as_py())


def _verified(index: tuple[PerfectHash, np.ndarray], keys: np.ndarray) -> np.ndarray:
    own, placed = index
    at = own.index(keys)
    if (at < 0).any() or (placed[at] != keys).any():
        raise ValueError("a pair is not the one that its hash finds")
    return at


def _vector(rows: pa.Table, index: pa.Table) -> pa.Table:
    """A lane's pairs as one dense vector of counts."""
    if not rows.num_rows:                              # a lane without pairs of this shard
        return pa.table({"shard": pa.array([], pa.int64()), "vector": pa.array([], pa.binary())})
    index = _index(index)
    total = np.zeros(index[0].size, np.int64)
    keys, counts = (np.concatenate([_of(x) for x in rows.column(c).to_pylist()]) for c in ("keys", "counts"))
    np.add.at(total, _verified(index, keys), counts)
    return pa.table({"shard": rows.column("shard")[:1], "vector": [total.tobytes()]})


def _sum(table: pa.Table) -> pa.Table:
    total = np.sum([_of(v) for v, in _rows(table, "vector")], axis=0)
    return pa.table({"shard": table.column("shard")[:1], "vector": [total.tobytes()]})


def _looked_up(size_b: int):
    def run(rows: pa.Table, index: pa.Table) -> pa.Table:
        """The blocks' pairs with their counts, negative if the highest of their first id."""
        vector = _of(index.column("vector")[0].as_py())
        index = _index(index)
        first = index[1] // size_b
        ids, which = np.unique(first, return_inverse=True)
        highest = np.zeros(len(ids), np.int64)
        np.maximum.at(highest, which, vector)
        marked = np.where(vector == highest[which], -vector, vector)
        keys = [_of(k) for k in rows.column("keys").to_pylist()]
        found = marked[_verified(index, np.concatenate([np.zeros(0, np.int64), *keys]))]
        counts = [c.tobytes() for c in np.split(found, np.cumsum([len(k) for k in keys])[:-1])] if keys else []
        return pa.table({"block": rows.column("block"), "keys": rows.column("keys"),
                         "counts": pa.array(counts, pa.binary())})
    return run


def _judged(byte_level: str, pieces: str):
    def run(blocks: pa.Table, replies: pa.Table) -> pa.Table:
        """A block's documents, aligned again and judged by the counts."""
        both = tokenizers(byte_level, pieces)
        keys, counts = (np.concatenate([np.zeros(0, np.int64), *[_of(x) for x in replies.column(c).to_pylist()]])
                        for c in ("keys", "counts"))
        by = np.argsort(keys)
        keys, counts = keys[by], counts[by]
        out = {name: [] for name in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                                     "groups_sha256")}
        for ids, texts in _rows(blocks, "ids", "texts"):
            places, n = both.segments(texts, groups=True)
            found = both.found
            own = np.flatnonzero(np.bincount(places, minlength=1))
            row = np.zeros(len(found), np.int64)
            row[own] = np.arange(len(own))
            pair, segment = found.of(own)
            count, times = counts[np.searchsorted(keys, found.pairs[pair])], found.times[pair]
            judged = np.stack([_sums(times * (count < 0), segment, len(own)),
                               _sums(times * np.abs(count), segment, len(own))], axis=1)
            of = np.repeat(np.arange(len(n)), n)
            values = [*found.numbers[places].T, *judged[row[places]].T]
            sums = [_sums(v, of, len(n)).tolist() for v in values]
            written = [found.text[p] for p in places.tolist()]
            ends = np.cumsum(n).tolist()
            out["groups_sha256"] += [hashlib.sha256(";".join(written[s:e]).encode()).hexdigest() if e > s else ""
                                     for s, e in zip([0, *ends], ends)]
            for name, column in zip(out, [ids, *sums]):
                out[name] += column
        return pa.table({name: pa.array(v, pa.string() if name == "groups_sha256" else pa.int64())
                         for name, v in out.items()})
    return run


def _together(pairs: DataFrame, index: DataFrame):
    """Grouped by shard and lane, over as many tasks as a shuffle has: the work
    is far more than the bytes tell."""
    n = shuffle_partitions(pairs.sparkSession)
    one, two = (df.repartition(n, "shard", "lane").groupBy("shard", "lane") for df in (pairs, index))
    return one.cogroup(two)


def aligned(docs: DataFrame, byte_level: str, pieces: str, block_bytes: int = BLOCK_BYTES,
            shard_pairs: int = SHARD_PAIRS, lane_blocks: int = LANE_BLOCKS) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256.  ``byte_level`` and ``pieces`` are paths of
    vocabulary files that every executor can open."""
    own = tokenizers(byte_level, pieces)
    shards = math.ceil(own.size_a * own.size_b / shard_pairs)
    blocks = _blocks(docs, block_bytes)
    lanes = max(1, math.ceil(math.sqrt(blocks.count() / lane_blocks)))
    pairs = stage(_pairs(blocks, byte_level, pieces, shards, lanes), "align-pairs")
    index, sums = pair_counts(pairs, lanes)
    counted = index.join(sums, "shard").withColumn("lane", _every_lane(lanes))
    replies = _together(pairs, counted).applyInArrow(
        _looked_up(own.size_b), "block long, keys binary, counts binary")
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(
        _judged(byte_level, pieces), "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                     "count_sum long, groups_sha256 string")


def pair_counts(pairs: DataFrame, lanes: int) -> tuple[DataFrame, DataFrame]:
    """Per shard the hash with its stored pairs, and the dense vector of counts."""
    unions = pairs.select("shard", "lane", "keys").groupBy("shard", "lane").applyInArrow(
        _union, "shard long, keys binary")
    index = stage(unions.groupBy("shard").applyInArrow(_hashed, "shard long, hash binary, placed binary"),
                  "align-index")
    per_lane = index.withColumn("lane", _every_lane(lanes))
    vectors = _together(pairs, per_lane).applyInArrow(
        _vector, "shard long, vector binary")
    return index, stage(vectors.groupBy("shard").applyInArrow(_sum, "shard long, vector binary"), "align-counts")
