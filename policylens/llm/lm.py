"""LM scoring with an Elias-Fano n-gram trie over the whole corpus.

Nothing is cut off and nothing whole is held anywhere: counts of all words,
pairs and triples of the training texts stay distributed, and every task gets
the part of the model that its own documents touch.

1. Documents are gathered into groups of about ``GROUP_WORDS`` words where they
   lie.  A group is one row of a table bucketed by group: the hashes of its
   distinct words, and its texts as numbers into them.
2. A group asks for the counts of its distinct n-grams: their hashes and their
   own training counts go to the shard of the hash, each once per group, so
   no word is hot.  A shard adds up and answers in the order asked.
3. Words and pairs are asked for first; triples then only where both of their
   pairs occur in the training texts, elsewhere no triple can.
4. A group builds the trie of its n-grams with their corpus counts, maps it
   into memory, and scores its documents by successor search.

The words of a group are asked for by 64-bit hash; pairs and triples by 48 bits
within their shard, whose size does not grow with the corpus.

Defined results: a null text counts as empty and is one token, the end.  With
no training texts every score is 0.  Equal texts have equal scores, whatever
their group.  Probabilities after a context sum to one.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, BooleanType, DoubleType, IntegerType, LongType, StructField, StructType

from policylens.llm.common import shuffle_partitions, stage
from policylens.llm.hashing import mix, word_hashes
from policylens.llm.trie import NgramTrie, build_trie, restore
from policylens.session import scratch_path

GROUP_WORDS = 1_000_000
PAIR_WEIGHT, TRIPLE_WEIGHT = 20.0, 1.0
LEAST_CONTEXT = 1        # a context is every pair that occurs
# Hashes that no word is given: the end of a text, and its beginning as a context.
END, BEGIN = np.uint64(1), np.uint64(2)
_FIRST, _SECOND, _THIRD = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F))
_LOW = np.uint64((1 << 48) - 1)


def _pack(a: np.ndarray) -> bytes:
    """Numbers compressed byte plane by byte plane."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), -1).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(blob: bytes, dtype: str) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(dtype).ravel()


# --- groups ------------------------------------------------------------------------------------

def _groups_schema(id_field: StructField) -> StructType:
    return StructType([StructField("group", LongType()), StructField("ids", ArrayType(id_field.dataType)),
                       StructField("held_out", ArrayType(BooleanType())), StructField("lengths", BinaryType()),
                       StructField("vocabulary", BinaryType()), StructField("tokens", BinaryType())])


def grouped(docs: DataFrame, group_words: int) -> DataFrame:
    """``docs`` (doc_id, text, held_out) as one row per group, in a bucketed table."""
    spark = docs.sparkSession
    schema = _groups_schema(docs.schema["doc_id"])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId() << 32
        ids, held, hashes, lengths, count, made = [], [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            vocabulary, tokens = np.unique(np.concatenate(hashes), return_inverse=True)
            row = [[task | made], [ids], [held], [_pack(np.array(lengths, np.int64))], [vocabulary.tobytes()],
                   [_pack(tokens.astype(np.uint32))]]
            types = [pa.int64(), pa.list_(id_type), pa.list_(pa.bool_()), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(row, types, strict=True)],
                                              names=schema.names)

        for batch in batches:
            id_type = batch.column("doc_id").type
            for doc_id, text, out in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "held_out")),
                                         strict=True):
                h = word_hashes(text)
                h[h <= BEGIN] += np.uint64(3)             # the two hashes that are taken
                hashes.append(np.append(h, END))
                ids.append(doc_id)
                held.append(out)
                lengths.append(len(h) + 1)
                count += len(h) + 1
                if count >= group_words:
                    yield flush()
                    ids, held, hashes, lengths, count, made = [], [], [], [], 0, made + 1
        if count:
            yield flush()

    table, buckets = f"lm_groups_{uuid.uuid4().hex}", shuffle_partitions(spark)
    (docs.select("doc_id", "text", "held_out").mapInArrow(run, schema).write.format("parquet")
     .bucketBy(buckets, "group").option("path", scratch_path(spark, "lm-groups")).saveAsTable(table))
    return spark.table(table)


class Group:
    """A group's texts as numbers, and its distinct n-grams.  Place V stands for the beginning."""

    def __init__(self, vocabulary: bytes, tokens: bytes, lengths: bytes, held_out: list[bool]):
        self.vocabulary = np.frombuffer(vocabulary, np.uint64)
        self.tokens = _unpack(tokens, "u4").astype(np.int64)
        self.lengths = _unpack(lengths, "i8")
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.size = len(self.vocabulary)
        self.learn = np.repeat(~np.array(held_out, bool), self.lengths)
        self.last = np.empty_like(self.tokens)
        self.last[1:] = self.tokens[:-1]
        self.last[self.starts] = self.size
        self.hashes = np.append(self.vocabulary, BEGIN)

    def singles(self) -> tuple[np.ndarray, np.ndarray]:
        return self.vocabulary, np.bincount(self.tokens[self.learn], minlength=self.size)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct pairs by place: ``pair_of`` says which one each position has.
        Returns their hashes and training counts."""
        codes, self.pair_of = np.unique(self.last * (self.size + 1) + self.tokens, return_inverse=True)
        self.pair_last, self.pair_word = np.divmod(codes, self.size + 1)
        keys = mix(self.hashes[self.pair_last] * _FIRST + self.hashes[self.pair_word] * _SECOND)
        return keys, np.bincount(self.pair_of[self.learn], minlength=len(codes))

    def triples(self, pair_counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct triples of which both pairs are known: ``triple_at`` are
        their positions, ``triple_of`` which one each has, ``triple_node`` and
        ``triple_pair`` their first and last two words as pairs."""
        often = (pair_counts >= LEAST_CONTEXT)[self.pair_of]
        at = np.flatnonzero(often)
        at = at[~np.isin(at, self.starts)]
        self.triple_at = at = at[often[at - 1]]
        codes, self.triple_of = np.unique(self.pair_of[at - 1] * (self.size + 1) + self.tokens[at],
                                          return_inverse=True)
        self.triple_node, self.triple_word = np.divmod(codes, self.size + 1)
        self.triple_pair = np.zeros(len(codes), np.int64)        # which pair its last two words are
        self.triple_pair[self.triple_of] = self.pair_of[at]
        first, middle = self.pair_last[self.triple_node], self.pair_word[self.triple_node]
        keys = mix(mix(self.hashes[first] * _FIRST + self.hashes[middle] * _SECOND) * _THIRD
                    + self.hashes[self.triple_word])
        return keys, np.bincount(self.triple_of[self.learn[at]], minlength=len(codes))


# --- asking and answering ----------------------------------------------------------------------

_ASK = StructType([StructField("shard", LongType()), StructField("group", LongType()), StructField("level", IntegerType()),
                   StructField("keys", BinaryType()), StructField("counts", BinaryType())])
_ANSWER = StructType([StructField("group", LongType()), StructField("level", IntegerType()),
                      StructField("shard", LongType()), StructField("counts", BinaryType())])


def _asked(group: int, level: int, keys: np.ndarray, counts: np.ndarray, shards: int) -> Iterator[tuple]:
    """Rows that ask for ``keys``, which are put in hash order, a shard's together."""
    order = np.argsort(keys)
    keys, counts = keys[order], counts[order]
    shard = ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(shard)) + 1
    for part, n, s in zip(np.split(keys, cuts), np.split(counts, cuts), shard[np.concatenate([[0], cuts])] if len(keys)
                          else [], strict=False):
        raw = part.tobytes() if level == 1 else np.ascontiguousarray(
            (part & _LOW).view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()
        yield int(s), group, level, raw, _pack(n.astype(np.uint32))


def _ask_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    types = [pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                                      names=_ASK.names)


def _keys(raw: bytes, level: int) -> np.ndarray:
    if level == 1:
        return np.frombuffer(raw, np.uint64)
    out = np.zeros((len(raw) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _answers(asks: DataFrame) -> DataFrame:
    """Corpus counts for every ask, in its order.  Level 0 rows carry a shard's
    words: their total, how many there are, and how many occur once and twice."""

    def run(table: pa.Table) -> pa.Table:
        level = table.column("level")[0].as_py()
        shard = table.column("shard")[0].as_py()
        keys = [_keys(k, level) for k in table.column("keys").to_pylist()]
        counts = [_unpack(c, "u4") for c in table.column("counts").to_pylist()]
        _, where = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(where, weights=np.concatenate(counts)).astype(np.int64)
        told = np.split(total[where], np.cumsum([len(k) for k in keys])[:-1])
        rows = [(g, level, shard, _pack(t)) for g, t in zip(table.column("group").to_pylist(), told, strict=True)]
        if level == 1:
            facts = np.array([total.sum(), (total > 0).sum(), (total == 1).sum(), (total == 2).sum()], np.int64)
            rows.append((-1, 0, shard, _pack(facts)))
        return pa.table([pa.array(list(c), t) for c, t in zip(zip(*rows, strict=True), (
            pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)], names=_ANSWER.names)

    return stage(asks.groupBy("shard", "level").applyInArrow(run, _ANSWER), "lm-answers")


def _told(answers: pa.Table, level: int, keys: np.ndarray) -> np.ndarray:
    """Answered counts of ``keys``, which may be in any order."""
    rows = sorted((s, c) for lv, s, c in zip(*(answers.column(x).to_pylist() for x in ("level", "shard", "counts")),
                                             strict=True) if lv == level)
    out = np.zeros(len(keys), np.int64)
    if len(keys):
        out[np.argsort(keys)] = np.concatenate([_unpack(c, "i8") for _, c in rows])
    return out


def _group_of(row: dict) -> Group:
    return Group(row["vocabulary"], row["tokens"], row["lengths"], row["held_out"])


def _group_rows(table: pa.Table) -> list[dict]:
    return table.select(["group", "ids", "held_out", "lengths", "vocabulary", "tokens"]).to_pylist()


# --- the operator ------------------------------------------------------------------------------

def score(docs: DataFrame, group_words: int = GROUP_WORDS) -> DataFrame:
    """One row per document of ``docs`` (doc_id, text, held_out): doc_id, held_out,
    n_tokens, n_known, train_tokens, base_score, score.  Texts that are not held
    out are what the model learns from."""
    groups = grouped(docs, group_words)
    # as many shards as groups: both stay the same size when the corpus grows
    shards = max(1, groups.agg(F.count(F.lit(1))).first()[0])

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                group = _group_of(row)
                for level, (keys, counts) in ((1, group.singles()), (2, group.pairs())):
                    yield _ask_batch(list(_asked(row["group"], level, keys, counts, shards)))

    parts = groups.select("group", "held_out", "lengths", "vocabulary", "tokens")
    first = _answers(parts.mapInArrow(ask, _ASK))
    facts = np.zeros(4, np.int64)
    for r in first.where("level = 0").groupBy("counts").agg(F.count(F.lit(1)).alias("n")).toLocalIterator():
        facts += _unpack(r["counts"], "i8") * r["n"]       # one short row per shard
    total, sorts, once, twice = map(int, facts)
    discount = once / (once + 2 * twice) if once and twice else 0.5
    told = first.where("level > 0")

    def ask_triples(key: tuple, mine: pa.Table, answers: pa.Table) -> pa.Table:
        rows = []
        for row in _group_rows(mine):
            group = _group_of(row)
            keys, _ = group.pairs()
            keys, counts = group.triples(_told(answers, 2, keys))
            rows += _asked(row["group"], 3, keys, counts, shards)
        return pa.Table.from_batches([_ask_batch(rows)])

    by_group = groups.groupBy("group")
    third = _answers(by_group.cogroup(told.groupBy("group")).applyInArrow(ask_triples, _ASK))

    schema = StructType([docs.schema["doc_id"], StructField("held_out", BooleanType()),
                         *[StructField(c, LongType()) for c in ("n_tokens", "n_known", "train_tokens")],
                         *[StructField(c, DoubleType()) for c in ("base_score", "score")]])
    names = schema.names

    def run(key: tuple, mine: pa.Table, answers: pa.Table) -> pa.Table:
        tables = [pa.table({"doc_id": pa.array([], mine.schema.field("ids").type.value_type),
                            "held_out": pa.array([], pa.bool_()),
                            **{c: pa.array([], pa.int64()) for c in names[2:5]},
                            **{c: pa.array([], pa.float64()) for c in names[5:]}})]
        for row in _group_rows(mine):
            group = _group_of(row)
            single = _told(answers, 1, group.singles()[0])
            pair = _told(answers, 2, group.pairs()[0])
            triple = _told(answers, 3, group.triples(pair)[0])
            scores = _score_group(group, single, pair, triple, total, sorts, discount)
            base = np.log10((single + 1) / (total + sorts + 1))[group.tokens]
            known = (single > 0)[group.tokens]
            tables.append(pa.table({
                "doc_id": pa.array(row["ids"], tables[0].schema.field("doc_id").type),
                "held_out": pa.array(row["held_out"], pa.bool_()), "n_tokens": pa.array(group.lengths, pa.int64()),
                "n_known": pa.array(np.add.reduceat(known.astype(np.int64), group.starts), pa.int64()),
                "train_tokens": pa.array(np.full(len(group.lengths), total), pa.int64()),
                "base_score": pa.array(np.add.reduceat(base, group.starts)),
                "score": pa.array(np.add.reduceat(scores, group.starts))}))
        return pa.concat_tables(tables)

    return by_group.cogroup(told.unionByName(third).groupBy("group")).applyInArrow(run, schema)


def _score_group(group: Group, single: np.ndarray, pair: np.ndarray, triple: np.ndarray, total: int, sorts: int,
                 discount: float) -> np.ndarray:
    """log10 probability at every position of a group."""
    known = np.flatnonzero(single > 0)
    ids = np.full(group.size + 1, -1, np.int64)            # places in the group to words of the trie
    ids[known] = np.arange(len(known))
    ids[group.size] = len(known)
    seen = np.flatnonzero(pair > 0)
    nodes = np.full(len(pair) + 1, -1, np.int64)
    nodes[seen] = np.arange(len(seen))
    kept = np.flatnonzero(triple > 0)
    texts = int(single[np.searchsorted(group.vocabulary, END)])      # every training text has one end
    trie: NgramTrie = build_trie(
        single[known], (ids[group.pair_last[seen]], ids[group.pair_word[seen]], pair[seen]),
        (nodes[group.triple_node[kept]], ids[group.pair_word[group.triple_node[kept]]], nodes[group.triple_pair[kept]],
         triple[kept]), texts, total, sorts, discount, PAIR_WEIGHT, TRIPLE_WEIGHT, LEAST_CONTEXT).mapped()
    # every distinct pair and triple is searched for once; a pair's place is the context of the next word
    last, word = ids[group.pair_last], ids[group.pair_word]
    node = trie.pair_nodes(last, word)
    out = trie.after_word(last, word, node)[group.pair_of]
    inner = np.ones(len(group.tokens), bool)
    inner[group.starts] = False
    at = np.flatnonzero(inner)
    context = node[group.pair_of[at - 1]]
    at, context = at[context >= 0], context[context >= 0]
    out[at] += trie.back_off(context)
    found = trie.triple_nodes(node[group.triple_node], word[group.triple_node], node[group.triple_pair])[group.triple_of]
    known = np.flatnonzero(found >= 0)
    out[group.triple_at[known]] = restore(trie.triples.prob[found[known]])
    return out
