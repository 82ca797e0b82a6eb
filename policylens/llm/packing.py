"""Best-fit packing of token sequences by bin completion.

Texts are tokenised where they lie; only (length, checksum) rows move.  A
histogram of the pieces' lengths has at most as many rows as a sequence has
tokens, whatever the number of documents.  Branch and bound runs on that
histogram: the bin of the largest remaining length is completed by undominated
fillings, least waste first; a bin pattern is used as often as the histogram
allows, so the number of patterns is bounded by the lengths too.  The pieces,
ranked within their length by a distributed prefix sum, then look up their
place in the patterns.

Defined results: a null text is empty and has one token, the end.  Repeated
rows are packed as separate documents.  An empty table gives no rows.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from policylens.llm.common import prefix_sums, stage
from policylens.llm.tokens import CONTRACTIONS, LATIN_NUMBER, SPACE, is_latin

CAPACITY = 2048
END_ID = 0
# Chunks a Python worker remembers the ids of, those of late and those from before;
# what it meets again stays.  Workers outlive the task, so this is held beside
# whatever an executor does next.
REMEMBERED = 150_000
# Texts that are Python strings at a time.
TEXTS = 500
# Nodes that the search may visit beyond its first descent.
SEARCH_NODES = 2_000
# Fillings that are tried for one bin.
WIDTH = 4
# Dominated fillings that are looked at for one bin; a few short lengths have
# exponentially many.  The first, fullest filling is never one.
TRIES = 100

# --- tokens ------------------------------------------------------------------------------------

_LOWER_LETTER = "a-zªµºß-öø-ÿ"
_latin_chunks = re.compile(f"{CONTRACTIONS}|[{_LOWER_LETTER}]+|[{LATIN_NUMBER}]"
                           f"|[^{SPACE}{_LOWER_LETTER}{LATIN_NUMBER}]+").findall
# Fixed value: the split pattern for which the shortcut below holds.
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class IdEncoder:
    """Little-endian 32-bit ids of texts, by a tokenizers vocabulary file.

    Texts of the first 256 code points are split here and each distinct chunk
    is encoded by the library once (lower-casing is the only normalisation
    that can touch them); all other texts go through the library whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        steps = (spec["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        norm = [n["type"] for n in (spec["normalizer"] or {}).get("normalizers", [])]
        suffix = spec["model"].get("end_of_word_suffix")
        self.shortcut = bool(suffix) and norm == ["NFC", "Replace", "Lowercase"] and (
            steps[0].get("pattern") == {"Regex": _SPLIT})
        if self.shortcut:
            vocab = spec["model"]["vocab"]
            self.is_end = np.zeros(max(vocab.values()) + 1, bool)
            self.is_end[[i for token, i in vocab.items() if token.endswith(suffix)]] = True
            self.added = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or "(?!)")
            spec["normalizer"], spec["added_tokens"] = None, []
            steps[0] = {"type": "Split", "pattern": {"String": "\n"}, "behavior": "Removed", "invert": False}
            spec["model"]["vocab"], spec["model"]["merges"] = {}, []
            self.chunks = Tokenizer.from_str(json.dumps(spec))
            self.chunks.model = self.whole.model           # shared, so held once
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, missing: list[str]) -> None:
        for at in range(0, len(missing), 500):
            part = missing[at:at + 500]
            ids = np.array(self.chunks.encode("\n".join(part), add_special_tokens=False).ids, "<u4")
            ends = (np.flatnonzero(self.is_end[ids]) + 1) * 4
            raw, start = ids.tobytes(), 0
            for chunk, end in zip(part, ends.tolist(), strict=True):
                self.known[chunk] = raw[start:end]
                start = end

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        if not self.shortcut or not is_latin(text) or self.added.search(text):
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        chunks = _latin_chunks(text.lower())
        get = self.known.__getitem__
        try:
            return b"".join(map(get, chunks))
        except KeyError:
            pass
        half, parts = REMEMBERED // 2, []
        for at in range(0, len(chunks), half):             # a very long text in parts
            part = chunks[at:at + half]
            missing = set(part).difference(self.known)
            if len(self.known) + len(missing) > half:
                self.known, self.older, missing = {}, self.known, set(part)
            new = []
            for c in missing:
                ids = self.older.get(c)
                if ids is None:
                    new.append(c)
                else:
                    self.known[c] = ids
            self._learn(new)
            parts.append(b"".join(map(self.known.__getitem__, part)))
        return b"".join(parts)


@lru_cache(maxsize=2)
def encoder(path: str) -> IdEncoder:
    """One per Python worker and vocabulary."""
    return IdEncoder(path)


def pieces_of(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32."""
    schema = StructType([docs.schema["doc_id"], StructField("piece", IntegerType()), StructField("start", LongType()),
                         StructField("length", LongType()), StructField("ids_crc32", LongType())])
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary).encode
        for batch in batches:
            source, piece, start, length, crc = [], [], [], [], []
            texts = batch.column("text")
            for i, text in enumerate(t for at in range(0, len(texts), TEXTS) for t in texts.slice(at, TEXTS).to_pylist()):
                ids = encode(text) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at:at + 4 * capacity]
                    source.append(i)
                    piece.append(k)
                    start.append(at // 4)
                    length.append(len(part) // 4)
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(source, pa.int64())), pa.array(piece, pa.int32()),
                 *[pa.array(x, pa.int64()) for x in (start, length, crc)]], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


# --- bin completion ----------------------------------------------------------------------------

Pattern = tuple[tuple[int, int], ...]          # (length, copies), largest first


def waste_bound(counts: dict[int, int], capacity: int) -> int:
    """A lower bound on the bins: the better of the total over the capacity
    and, for each threshold t, the items above ``capacity - t`` alone, plus
    what the middle items need beyond the room beside the upper half."""
    if not counts:
        return 0
    lengths = np.array(sorted(counts), np.int64)
    n = np.array([counts[x] for x in lengths.tolist()], np.int64)
    total = lengths * n
    best = -(-int(total.sum()) // capacity)
    sums, numbers = np.concatenate([[0], np.cumsum(total)]), np.concatenate([[0], np.cumsum(n)])
    half = int(np.searchsorted(lengths, capacity // 2, "right"))
    for t in lengths[:half].tolist():
        low, high = int(np.searchsorted(lengths, t, "left")), int(np.searchsorted(lengths, capacity - t, "right"))
        alone = int(numbers[-1] - numbers[high])
        upper = int(numbers[high] - numbers[half])
        room = upper * capacity - int(sums[high] - sums[half])
        best = max(best, alone + upper + max(0, -(-(int(sums[half] - sums[low]) - room) // capacity)))
    return max(best, int(numbers[-1] - numbers[half]))


def fillings(counts: dict[int, int], room: int, width: int) -> Iterator[list[tuple[int, int]]]:
    """Up to ``width`` undominated fillings of ``room``, fullest first and with
    large items first.  Sums that the smaller lengths can reach are kept as
    bits of an integer for every suffix, so no branch is a dead end."""
    lengths = sorted((x for x in counts if x <= room), reverse=True)
    mask = (1 << room + 1) - 1
    reach = [1] * (len(lengths) + 1)
    for i in range(len(lengths) - 1, -1, -1):
        bits, left, step = reach[i + 1], min(counts[lengths[i]], room // lengths[i]), 1
        while left:
            take = min(step, left)
            bits |= bits << take * lengths[i] & mask
            left, step = left - take, 2 * step
        reach[i] = bits
    found, there, tries = 0, 0, 0
    for x, n in counts.items():
        there |= (n > 0) << x
    sums = reach[0]

    def exact(i: int, rest: int) -> Iterator[list[tuple[int, int]]]:
        if rest == 0:
            yield []
            return
        while i < len(lengths) and lengths[i] > rest:
            i += 1
        while i < len(lengths) and reach[i] >> rest & 1:
            x = lengths[i]
            for k in range(min(counts[x], rest // x), 0, -1):
                if reach[i + 1] >> (rest - k * x) & 1:
                    for tail in exact(i + 1, rest - k * x):
                        yield [(x, k), *tail]
            i += 1

    while sums and found < width:
        best = sums.bit_length() - 1
        sums ^= 1 << best
        for filling in exact(0, best):
            if not _dominated(filling, counts, room - best, there):
                yield filling
                found += 1
                if found >= width:
                    return
            else:
                tries += 1
                if tries >= TRIES:
                    return
        if best == room:
            return                                        # a full bin dominates what wastes more


def _dominated(filling: list[tuple[int, int]], counts: dict[int, int], slack: int, there: int) -> bool:
    """Could one unused item replace one or two of the filling and waste less?
    ``there`` has the bits of the lengths in ``counts``."""
    if not slack:
        return False
    for x, k in filling:
        if counts[x] <= k:
            there &= ~(1 << x)                            # none is left unused
    items = [x for x, k in filling for _ in range(min(k, 2))]
    subsets = {*items, *(a + b for i, a in enumerate(items) for b in items[i + 1:])}
    longer = (1 << slack) - 1
    return any(there >> s + 1 & longer for s in subsets)


def complete_bins(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = SEARCH_NODES,
                  width: int = WIDTH) -> list[tuple[Pattern, int]]:
    """Bin patterns and how often each is used, for ``counts`` pieces by length.

    Depth first: the largest length takes a bin, its fillings are tried least
    waste first, each as often as the counts allow.  The first descent is the
    best-fit solution; a branch is cut when its bins so far plus the waste
    bound of the rest cannot beat the best solution.  The search ends when
    that meets the bound at the root, or after ``nodes`` more nodes."""
    counts = {x: n for x, n in counts.items() if n}
    if not counts:
        return []
    goal = waste_bound(counts, capacity)
    best: tuple[int, list[tuple[Pattern, int]]] | None = None
    path: list[tuple[Pattern, int]] = []
    used, visited = 0, 0

    def choices() -> Iterator[tuple[Pattern, int]]:
        largest = max(counts)
        counts[largest] -= 1
        options = list(fillings({x: n for x, n in counts.items() if n}, capacity - largest, width))
        counts[largest] += 1
        for filling in options:
            pattern = dict(filling)
            pattern[largest] = pattern.get(largest, 0) + 1
            times = min(counts[x] // k for x, k in pattern.items())
            yield tuple(sorted(pattern.items(), reverse=True)), times

    def apply(pattern: Pattern, times: int) -> None:
        for x, k in pattern:
            counts[x] = counts.get(x, 0) - k * times
            if not counts[x]:
                del counts[x]

    stack = [choices()]
    while stack:
        step = next(stack[-1], None)
        if step is None:
            stack.pop()
            if path:
                pattern, times = path.pop()
                apply(pattern, -times)
                used -= times
            continue
        apply(*step)
        path.append(step)
        used += step[1]
        if best is not None:
            visited += 1
            if visited > nodes:
                break
            if used + waste_bound(counts, capacity) >= best[0]:
                pattern, times = path.pop()
                apply(pattern, -times)
                used -= times
                continue
        if counts:
            stack.append(choices())
            continue
        best = (used, list(path))
        if used <= goal:
            break
        pattern, times = path.pop()
        apply(pattern, -times)
        used -= times
    return best[1]


def _slots(patterns: list[tuple[Pattern, int]]) -> dict[str, np.ndarray]:
    """For each length in each pattern: the first of its ranks that lie there,
    the first sequence, the copies per sequence and the offset of the first."""
    rows, rank, first = [], {}, 0
    for pattern, times in patterns:
        offset = 0
        for length, copies in pattern:
            rows.append((length, rank.get(length, 0), first, copies, offset))
            rank[length] = rank.get(length, 0) + copies * times
            offset += length * copies
        first += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "first", "copies", "offset"), table.T, strict=True))


def pack(docs: DataFrame, vocabulary: str, capacity: int = CAPACITY, end_id: int = END_ID,
         nodes: int = SEARCH_NODES) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    pieces = stage(pieces_of(docs, vocabulary, capacity, end_id), "pieces")
    # at most ``capacity`` rows
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = _slots(complete_bins(counts, capacity, nodes))
    lengths = np.array(sorted(counts), np.int64)
    starts = np.concatenate([[0], np.cumsum([counts[x] for x in lengths.tolist()])])[:-1]
    ranked = prefix_sums(pieces, [F.col(c) for c in ("length", "doc_id", "piece", "ids_crc32")], F.lit(1), "rank")
    names = pieces.columns
    schema = StructType([*pieces.schema.fields, StructField("sequence_id", LongType()),
                         StructField("offset", LongType())])
    far = max((int(n) for n in counts.values()), default=0) + 1

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = slots["length"] * far + slots["rank"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy() - starts[np.searchsorted(lengths, length)]
            at = np.searchsorted(keys, length * far + rank, "right") - 1
            inside = rank - slots["rank"][at]
            sequence = slots["first"][at] + inside // slots["copies"][at]
            offset = slots["offset"][at] + inside % slots["copies"][at] * length
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place, schema)
