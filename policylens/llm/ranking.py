"""Ranked lexical search: term at a time, rarest first, accumulators limited.

Documents are read once for the terms that the queries ask for; what is kept
of a document (its length and its frequencies of such terms) is staged.  The
corpus counts come from that.  Then every task goes through its documents in
blocks.  For each query the terms of a block are taken from the rarest on and
their contributions added to accumulators.  As soon as ``k`` documents, of the
block or of the best found so far, have a score above what all remaining
terms can still add, no document that has no accumulator yet can be among the
best: from there on none is made, and those that exist are updated with every
remaining term, exactly.  Each task hands on the best ``k`` of its documents
for each query; the best of all tasks are the result.

Scores are whole numbers, as the contract of the weights has them: a term's
weight is floor(1000 * ln((2N + 2) / (2df + 1))), its contribution that weight
times (10^9 * tf) div (1000 * tf + 20 * m), m being 100 - b + (b * n * N) div L.

Queries are taken in groups of ``GROUP_TERMS`` (query, term) rows, a query
that crosses a group's end included, which bounds what is sent to the tasks;
any number of groups is worked through, each with a pass over the documents.

Defined results: a null or empty text has no terms and is never returned, a
query without terms returns nothing.  Rows with the same query id, null
included, are one query with the terms of all of them.  Equal scores are
ranked by ascending doc_id, null last; repeated ids are documents of their
own.  A term's weight may be 0; a document whose score is 0 is not returned.
Very long texts are read in pieces that end between terms.  Empty tables
give no rows.  Only the columns named are read; others cannot clash.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from policylens.llm.common import prefix_sums, shuffle_partitions, stage

# A term is a run of ASCII letters, digits and all characters beyond ASCII;
# in UTF-8 every byte of these is one of the class.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
TERM_PATTERN = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
K = 50
# How far a document's length counts, of 100.
LENGTH_SHARE = 50
# (query, term) rows that one pass over the documents serves.
GROUP_TERMS = 1_000_000
# Postings of a block, and bytes of a text that are cut into terms at once.
BLOCK_POSTINGS = 2_000_000
PIECE = 1 << 20


def terms_of(data: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in order, in lists of bounded length."""
    at = 0
    while at < len(data):
        end = min(at + PIECE, len(data))
        if end < len(data):
            cut = TERM.match(data, end)       # to the end of a term that goes on
            end = cut.end() if cut else end
        yield TERM.findall(data[at:end].lower())
        at = end


def count_terms(text: str | None, wanted: dict[bytes, int]) -> tuple[int, list[int], list[int]]:
    """A text's number of terms, and the wanted ones in it with their counts."""
    n, seen = 0, Counter()
    for terms in terms_of((text or "").encode("utf-8", "surrogatepass")):
        n += len(terms)
        seen.update(terms)
    found = sorted((wanted[t], c) for t, c in seen.items() if t in wanted)
    return n, [t for t, _ in found], [c for _, c in found]


def postings(docs: DataFrame, terms: list[bytes]) -> DataFrame:
    """(doc_id, n, terms, counts) of each document with a term at all."""
    spread = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = {t: i for i, t in enumerate(spread.value)}
        for batch in batches:
            ids, ns, found, counts = [], [], [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                n, t, c = count_terms(text.as_py(), wanted)
                if n:
                    ids.append(doc_id), ns.append(n), found.append(t), counts.append(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(found, pa.list_(pa.int32())),
                 pa.array(counts, pa.list_(pa.int64()))], names=["doc_id", "n", "terms", "counts"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n long, terms array<int>, counts array<long>")


class Best:
    """The best ``k`` (score, doc_id) of one query so far, best first.  A null
    id is the largest number."""

    NULL = np.iinfo(np.int64).max

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.null = k, *(np.zeros(0, t) for t in (np.int64, np.int64, bool))

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        if len(self.scores) == self.k:                 # ties with the last may still win by their id
            keep = scores >= self.scores[-1]
            scores, ids, null = scores[keep], ids[keep], null[keep]
        if not len(scores):
            return
        scores, ids, null = (np.concatenate(p) for p in ((self.scores, scores), (self.ids, ids), (self.null, null)))
        first = np.lexsort((ids, null, -scores))[:self.k]
        self.scores, self.ids, self.null = scores[first], ids[first], null[first]


class Block:
    """An inverted index of a few thousand documents: per term the places of
    its documents and what it adds to their scores before its weight."""

    def __init__(self, batches: list[pa.RecordBatch], n_docs: int, n_terms: int, length_share: int):
        def column(name):
            return pa.chunked_array([b.column(name) for b in batches]).combine_chunks()

        ids = column("doc_id")
        self.null = np.asarray(ids.is_null())
        self.ids = np.asarray(ids.fill_null(Best.NULL))
        m = 100 - length_share + length_share * np.asarray(column("n")) * n_docs // n_terms
        lists = column("terms")
        # an Arrow slice keeps its parent's values: flatten() gives its own
        term, tf = np.asarray(lists.flatten()), np.asarray(column("counts").flatten())
        doc = np.repeat(np.arange(len(self.ids)), np.asarray(lists.value_lengths()))
        by = np.argsort(term, kind="stable")
        term, tf, self.doc = term[by], tf[by], doc[by]
        self.part = 1_000_000_000 * tf // (1000 * tf + 20 * m[self.doc])
        self.terms, starts = np.unique(term, return_index=True)
        self.starts = np.append(starts, len(term))
        self.most = np.maximum.reduceat(self.part, starts) if len(starts) else np.zeros(0, np.int64)

    def search(self, query: np.ndarray, weights: np.ndarray, best: Best) -> int:
        """Add the block's best for a query (its terms, rarest first) to ``best``;
        returns how many of its terms made accumulators."""
        at = np.searchsorted(self.terms, query)
        here = (at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == query)
        at, weights = at[here], weights[here]
        # what the terms from each on can add at most
        rest = np.cumsum((weights * self.most[at])[::-1])[::-1]
        scores, made, held = np.zeros(len(self.ids), np.int64), None, best.scores
        makers = 0
        for i, (t, w) in enumerate(zip(at, weights)):
            own = slice(self.starts[t], self.starts[t + 1])
            docs, parts = self.doc[own], self.part[own]
            if made is None and np.count_nonzero(held > rest[i]) + np.count_nonzero(scores > rest[i]) >= best.k:
                made = scores > 0                       # no accumulator is made from here on
            if made is None:
                scores[docs] += w * parts
                makers += 1
            else:
                on = made[docs]
                scores[docs[on]] += w * parts[on]
        found = np.flatnonzero(scores)
        best.add(scores[found], self.ids[found], self.null[found])
        return makers


def _blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[list[pa.RecordBatch]]:
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += len(batch.column("terms").flatten()) + batch.num_rows
        if size >= BLOCK_POSTINGS:
            yield held
            held, size = [], 0
    if held:
        yield held


def _best_of_group(docs: DataFrame, queries: list[tuple[int, list[bytes]]], k: int, length_share: int) -> DataFrame:
    """(query, doc_id, score) with the best ``k`` per query and more."""
    spark = docs.sparkSession
    terms = sorted({t for _, own in queries for t in own})
    place = {t: i for i, t in enumerate(terms)}
    found = stage(postings(docs, terms), "postings")
    n_docs, n_terms = found.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    frequency = dict(found.select(F.explode("terms").alias("t")).groupBy("t").count().collect())   # one row per term
    weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency.get(i, 0) + 1)))
                       for i in range(len(terms))], np.int64)
    plan = []
    for number, own in queries:
        q = np.array([place[t] for t in own], np.int64)
        q = q[weight[q] > 0]                           # nothing can come of the others
        plan.append((number, q[np.lexsort((q, -weight[q]))]))
    spread = spark.sparkContext.broadcast((plan, weight))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weight = spread.value
        best = [Best(k) for _ in plan]
        for group in _blocks(batches):
            block = Block(group, n_docs, n_terms, length_share)
            if len(block.terms):
                for (_, q), b in zip(plan, best):
                    block.search(q, weight[q], b)
        for (number, _), b in zip(plan, best):
            if len(b.scores):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(b.scores), number)), pa.array(b.ids, mask=b.null), pa.array(b.scores)],
                    names=["query", "doc_id", "score"])

    return found.mapInArrow(run, "query long, doc_id long, score long")


def _query_groups(items: DataFrame, group_terms: int) -> tuple[DataFrame, int]:
    """(group, number, item_id, term) and the number of groups: queries are
    numbered and cut into groups by the prefix sum of their numbers of terms."""
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    pairs = stage(items.select("item_id", F.explode(F.regexp_extract_all(text, F.lit(TERM_PATTERN), F.lit(0)))
                               .alias("term")).distinct(), "query-terms")
    sizes = pairs.groupBy("item_id").agg(F.count(F.lit(1)).alias("terms"))
    order = [F.col("item_id").isNull(), F.col("item_id")]
    placed = prefix_sums(prefix_sums(sizes, order, F.col("terms"), "before"), order, F.lit(1), "number")
    # a query belongs to the group that its last term falls in
    placed = placed.withColumn("group", F.floor((F.col("before") + F.col("terms") - 1) / group_terms))
    placed = stage(placed.withColumnRenamed("item_id", "_item"), "queries")
    groups = (placed.agg(F.max("group")).first()[0] or 0) + 1
    rows = pairs.join(placed, F.col("item_id").eqNullSafe(F.col("_item"))).select("group", "number", "item_id", "term")
    return stage(rows, "query-groups"), groups


def ranked(docs: DataFrame, items: DataFrame, k: int = K, length_share: int = LENGTH_SHARE,
           group_terms: int = GROUP_TERMS) -> DataFrame:
    """The ``k`` best documents (doc_id, text) of each item (item_id, text):
    item_id, rank, doc_id, score."""
    rows, groups = _query_groups(items, group_terms)
    names = rows.select("number", F.col("item_id")).distinct()
    found = None
    for group in range(groups):
        own = (rows.where(F.col("group") == group).groupBy("number").agg(F.collect_set("term")).collect())
        queries = sorted((number, sorted(t.encode() for t in terms)) for number, terms in own)
        if queries:
            best = _best_of_group(docs, queries, k, length_share)
            found = best if found is None else found.unionByName(best)
    if found is None:
        found = docs.sparkSession.createDataFrame([], "query long, doc_id long, score long")
    # first among the tasks of a lane, then among the lanes
    found = found.withColumn("lane", F.spark_partition_id() % shuffle_partitions(docs.sparkSession))
    order = [F.desc("score"), F.col("doc_id").isNull(), F.col("doc_id")]
    for by in (["query", "lane"], ["query"]):
        place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        found = found.withColumn("rank", place).where(F.col("rank") <= k)
    return found.join(names, F.col("query") == F.col("number")).select("item_id", "rank", "doc_id", "score")
