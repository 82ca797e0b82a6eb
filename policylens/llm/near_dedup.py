"""MinHash near-dedup: one-permutation hashing, banded buckets, star edges.

1. Each document's set of word shingles is hashed once; the least hash in each
   of 128 equal ranges is its signature, empty ranges borrow the value of a
   range that an independent hash sequence picks (optimal densification).
2. Documents with equal sets form a class, represented once from here on.
3. Signatures are cut into bands; classes that agree in a band share a bucket.
   In each bucket one class is the centre: the one whose buckets are the
   fullest, which in a group of near copies is close to what they were copied
   from.  Only edges to the centre are candidates, one per member, so they
   grow with the members and not with their pairs.
4. Candidates are confirmed on the full sets, and components are formed.
5. What a star cannot see: two members of one bucket, neither its centre,
   that are still in different components.  Buckets where that is so are
   dealt out in pairs of blocks and joined exactly by prefix filtering, only
   across components.  Links found there are spanning edges of each block
   pair, never all pairs.

Defined results: words are lower-cased (A-Z) runs of non-space; a document
with fewer words than a shingle is one shingle; without words or text its set
is empty and links with nothing.  Repeated rows are equal texts.  A group's
id is its smallest non-null doc_id.  An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType, StructField, StructType

from policylens.llm.common import dealt, stage, tasks_for
from policylens.llm.components import components
from policylens.llm.hashing import mix, word_hashes
from policylens.operators.joins import salted_join

SHINGLE = 5
THRESHOLD = 80           # percent
BINS, ROWS_PER_BAND = 128, 4
BLOCK = 256
# Tokens of a block that are counted at once: a table of 8 MB for two blocks.
COLUMNS = 4096
_ATTEMPTS = 64
# Shingle sets beside each other in one task of a small table.
TASK_SETS = 1_000


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the text's word shingles."""
    h = word_hashes(text)
    if not len(h):
        return h
    n = max(1, len(h) - size + 1)
    out = np.full(n, min(len(h), size), np.uint64)
    for k in range(min(len(h), size)):
        out = out * np.uint64(0x9E3779B97F4A7C15) + h[k:k + n]
    return np.unique(mix(out))


_RNG = np.random.default_rng(20240229)
_PROBES = _RNG.integers(0, BINS, (BINS, _ATTEMPTS))
_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(64 - 7)
_BAND_FACTORS = _RNG.integers(1, 2**63, ROWS_PER_BAND, dtype=np.uint64) | np.uint64(1)


def band_keys(shingles: np.ndarray) -> np.ndarray:
    """A 64-bit bucket key per band of a non-empty set's signature."""
    at = np.searchsorted(shingles, _EDGES)
    value = shingles[np.minimum(at, len(shingles) - 1)]
    filled = (at < len(shingles)) & (value >> np.uint64(64 - 7) == np.arange(BINS, dtype=np.uint64))
    empty = np.flatnonzero(~filled)
    if len(empty):
        tries = filled[_PROBES[empty]]
        first = tries.argmax(axis=1)
        donor = _PROBES[empty, first]
        missed = ~tries[np.arange(len(empty)), first]
        if missed.any():                                 # next filled range, cyclically
            have = np.flatnonzero(filled)
            donor[missed] = have[np.searchsorted(have, empty[missed]) % len(have)]
        value[empty] = value[donor]
    bands = value.reshape(-1, ROWS_PER_BAND) * _BAND_FACTORS
    return mix(bands.sum(axis=1, dtype=np.uint64) + np.arange(1, len(bands) + 1, dtype=np.uint64))


def _list_column(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts).view(np.int64) if parts else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def signatures(rows: DataFrame, size: int) -> DataFrame:
    """(row, doc_id, text) → row, doc_id, n, digest of the set, band keys."""
    schema = StructType([rows.schema["row"], rows.schema["doc_id"], StructField("n", LongType()),
                         StructField("digest", BinaryType()), StructField("bands", ArrayType(LongType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.empty(0, np.uint64)
        for batch in batches:
            n, digest, bands = [], [], []
            for text in batch.column("text").to_pylist():
                s = shingle_set(text, size)
                n.append(len(s))
                digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                bands.append(band_keys(s) if len(s) else none)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), pa.array(n, pa.int64()),
                 pa.array(digest, pa.binary()), _list_column(bands)], names=schema.names)

    return rows.select("row", "doc_id", "text").mapInArrow(run, schema)


def _sets(rows: DataFrame, size: int) -> DataFrame:
    """(row, text) → class, shingles (sorted as unsigned numbers)."""
    schema = StructType([StructField("class", LongType()), StructField("shingles", ArrayType(LongType()))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [shingle_set(t, size) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("row"), _list_column(parts)], names=schema.names)

    return rows.select("row", "text").mapInArrow(run, schema)


def _similar(common, n_a, n_b, threshold: int):
    return 100 * common >= threshold * (n_a + n_b - common)


def _shared_buckets(classes: DataFrame, n: int) -> DataFrame:
    """(key, class, n, centre) for buckets with two or more of the ``n`` classes."""
    keys = n * (BINS // ROWS_PER_BAND)
    rows = stage(classes.select("class", "n", F.explode("bands").alias("key")), "bands")
    full = stage(dealt(rows.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), keys),
                 "buckets")
    shared = stage(dealt(salted_join(rows, full, "key", how="inner", heavy="left", count_tasks=tasks_for(keys)), keys),
                   "shared")
    members = shared.count()
    weight = shared.groupBy("class").agg(F.sum("members").alias("weight"))
    weighted = stage(dealt(shared.join(weight, "class"), members), "weighted")
    centre = weighted.groupBy("key").agg(
        F.max_by("class", F.struct("weight", F.xxhash64("class"))).alias("centre"),
        F.max_by("n", F.struct("weight", F.xxhash64("class"))).alias("n_centre"))
    stars = salted_join(weighted.select("key", "class", "n"), dealt(centre, members), "key", how="inner", heavy="left",
                        count_tasks=tasks_for(members))
    return stage(dealt(stars, members), "stars")


def _confirmed(candidates: DataFrame, sets: DataFrame, threshold: int, n: int | None = None) -> DataFrame:
    """Edges (a, b) of the ``n`` ``candidates`` (centre, class) that are similar on their full sets."""
    n = candidates.count() if n is None else n
    members = candidates.join(sets, "class").withColumnRenamed("shingles", "_of_class")
    both = salted_join(members, sets.withColumnsRenamed({"class": "centre", "shingles": "_of_centre"}), "centre",
                       how="inner", heavy="left", salt_by=["class"], count_left=candidates, count_tasks=tasks_for(n))
    common = F.size(F.array_intersect("_of_class", "_of_centre"))
    return both.where(_similar(common, F.size("_of_class"), F.size("_of_centre"), threshold)).select(
        F.col("centre").alias("a"), F.col("class").alias("b"))


def _common(of: np.ndarray, token: np.ndarray, members: int) -> np.ndarray:
    """How many tokens each two members have in common: ``token`` is distinct in
    each member ``of``.  Products of 0/1 tables of ``COLUMNS`` tokens at a time."""
    tokens, token = np.unique(token, return_inverse=True)
    order = np.argsort(token, kind="stable")
    of, token = of[order], token[order]
    common = np.zeros((members, members), np.int64)
    for start in range(0, len(tokens), COLUMNS):
        low, high = np.searchsorted(token, [start, start + COLUMNS])
        held = np.zeros((members, min(COLUMNS, len(tokens) - start)), np.float32)
        held[of[low:high], token[low:high] - start] = 1
        common += (held @ held.T).astype(np.int64)
    return common


def block_links(members: list[tuple[int, int, np.ndarray]], threshold: int) -> list[tuple[int, int]]:
    """Links that join different components among ``members`` (class, component,
    set): exact by prefix filtering, a spanning set of them.  Members that share
    no token of their prefixes with another component link with none; what the
    others have in common is counted for all of them at once."""
    if len(members) < 2:
        return []
    n = np.array([len(m[2]) for m in members])
    _, component = np.unique([m[1] for m in members], return_inverse=True)
    values, token, counts = np.unique(np.concatenate([m[2] for m in members]), return_inverse=True, return_counts=True)
    rank = np.empty(len(values), np.int64)
    rank[np.argsort(counts, kind="stable")] = np.arange(len(values))
    owner, token = np.repeat(np.arange(len(members)), n), rank[token]
    order = np.lexsort((token, owner))                   # each member's rarest tokens first
    owner, token = owner[order], token[order]
    place = np.arange(len(token)) - np.repeat(np.cumsum(n) - n, n)

    def across(of: np.ndarray, held: np.ndarray) -> np.ndarray:
        """Which of the tokens ``held`` members of different components have."""
        low, high = np.full(len(values), len(members)), np.full(len(values), -1)
        np.minimum.at(low, held, component[of])
        np.maximum.at(high, held, component[of])
        return low[held] != high[held]

    prefix = place < np.repeat(n - -(-threshold * n // 100) + 1, n)
    left = np.unique(owner[prefix][across(owner[prefix], token[prefix])])
    if not len(left):
        return []
    n, component, names = n[left], component[left], [members[i][0] for i in left.tolist()]
    new = np.full(len(members), -1)
    new[left] = np.arange(len(left))
    rest = new[owner] >= 0
    owner, token = owner[rest], token[rest]
    rest = across(new[owner], token)
    common = _common(new[owner[rest]], token[rest], len(left))
    alike = _similar(common, n[:, None], n[None, :], threshold) & (component[:, None] != component[None, :])
    links = []
    for i, j in np.argwhere(np.tril(alike)).tolist():
        if component[i] != component[j]:
            links.append((names[i], names[j]))
            component[component == component[j]] = component[i]
    return links


def _left_over(stars: DataFrame, found: DataFrame, threshold: int) -> DataFrame:
    """(key, block pair, class, component) of what the stars left undecided."""
    labelled = stars.where("class <> centre").select("key", "class").join(
        found.select(F.col("node").alias("class"), "component"), "class", "left_outer").select(
        "key", "class", F.coalesce("component", "class").alias("component"))
    labelled = stage(labelled, "labelled")
    n = labelled.count()
    open_keys = labelled.groupBy("key").agg(F.min("component").alias("_lo"), F.max("component").alias("_hi")).where(
        "_lo <> _hi").select("key")
    members = stage(dealt(salted_join(labelled, dealt(open_keys, n), "key", how="inner", heavy="left",
                                      count_tasks=tasks_for(n)), n), "open")
    n = members.count()
    by_component = dealt(members.groupBy("key", "component").agg(F.count(F.lit(1)).alias("_n")), n)
    sizes = by_component.groupBy("key").agg(
        F.max_by("component", F.struct("_n", "component")).alias("main"), F.max("_n").alias("n_main"),
        F.sum("_n").alias("n_all"))
    rows = dealt(salted_join(members, dealt(sizes, n), "key", how="inner", heavy="left", count_tasks=tasks_for(n)), n)
    # blocks 0..m-1 hold the bucket's largest component, which needs no look into itself
    m, o = F.ceil(F.col("n_main") / BLOCK), F.ceil((F.col("n_all") - F.col("n_main")) / BLOCK)
    main = F.col("component") == F.col("main")
    block = F.when(main, F.pmod(F.xxhash64("class"), m)).otherwise(m + F.pmod(F.xxhash64("class"), o))
    partner = F.explode(F.when(main, F.sequence(m, m + o - 1)).otherwise(F.sequence(F.lit(0).cast("long"), m + o - 1)))
    rows = rows.withColumn("_block", block).withColumn("_partner", partner)
    return rows.select("key", F.least("_block", "_partner").alias("low"), F.greatest("_block", "_partner").alias("high"),
                       "class", "component")


def _block_edges(rows: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    schema = StructType([StructField("a", LongType()), StructField("b", LongType())])

    def run(table: pa.Table) -> pa.Table:
        shingles = table.column("shingles").combine_chunks()
        ends = shingles.offsets.to_numpy()
        parts = np.split(shingles.values.to_numpy().view(np.uint64)[:ends[-1]], ends[1:-1])
        members = list(zip(table.column("class").to_pylist(), table.column("component").to_pylist(), parts,
                           strict=True))
        links = block_links(members, threshold)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()),
                         "b": pa.array([b for _, b in links], pa.int64())})

    return rows.join(sets, "class").groupBy("key", "low", "high").applyInArrow(run, schema)


def near_duplicates(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, row, n_shingles, component_id, kept (one row of each group)."""
    rows = docs.select("doc_id", "text", (F.col("row") if "row" in docs.columns else
                                          F.monotonically_increasing_id()).alias("row"))
    if "row" not in docs.columns:
        rows = stage(rows, "near-documents")               # row numbers must stay what they are
    signed = stage(signatures(rows, size), "signatures")
    # of equal sets, the least doc_id and then row; empty sets are no class
    classes = stage(signed.where("n > 0").groupBy("digest").agg(
        F.min("row").alias("class"), F.min("doc_id").alias("least_id"),
        F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row")).alias("least"),
        F.first("n").alias("n"), F.first("bands").alias("bands")), "classes")
    n_classes = classes.count()
    stars = _shared_buckets(classes, n_classes)
    sized = stars.where((F.col("class") != F.col("centre")) & (
        100 * F.least("n", "n_centre") >= threshold * F.greatest("n", "n_centre")))
    candidates = stage(dealt(sized.select("centre", "class").distinct(), stars.count()), "candidates")
    wanted = stars.select("class").distinct()
    texts = rows.join(wanted.withColumnRenamed("class", "row"), "row", "left_semi")
    sets = stage(_sets(dealt(texts, n_classes, TASK_SETS), size), "sets")
    n_candidates = candidates.count()
    found = stage(components(_confirmed(candidates, sets, threshold, n_candidates), n_candidates), "components")
    more = stage(_block_edges(_left_over(stars, found, threshold), sets, threshold), "more-links")
    n_more = more.count()
    if n_more:
        found = _joined(found, more, n_more)
    return _labelled(signed, classes, found, n_classes)


def _joined(found: DataFrame, more: DataFrame, n_more: int | None = None) -> DataFrame:
    """Components after further links, ``n_more``, between nodes of different components."""
    n_more = more.count() if n_more is None else n_more

    def label(df: DataFrame, name: str) -> DataFrame:
        known = found.select(F.col("node").alias(name), F.col("component").alias("_c"))
        return df.join(known, name, "left_outer").withColumn(name, F.coalesce("_c", name)).drop("_c")

    merged = components(label(label(more, "a"), "b").distinct(), n_more).select(
        F.col("node").alias("component"), F.col("component").alias("_into"))
    nodes = found.unionByName(more.select(F.explode(F.array("a", "b")).alias("node")).distinct()
                              .join(found, "node", "left_anti").select("node", F.col("node").alias("component")))
    n = found.count() + 2 * n_more
    joined = salted_join(nodes, merged, "component", heavy="left", salt_by=["node"], count_tasks=tasks_for(n))
    return stage(dealt(joined.select("node", F.coalesce("_into", "component").alias("component")), n), "joined")


def _labelled(signed: DataFrame, classes: DataFrame, found: DataFrame, n_classes: int) -> DataFrame:
    of_class = classes.select("digest", "class", "least_id", "least").join(
        found.withColumnRenamed("node", "class"), "class", "left_outer").withColumn(
        "component", F.coalesce("component", "class"))
    of_class = stage(dealt(of_class, n_classes), "class-components")
    groups = of_class.groupBy("component").agg(F.min("least_id").alias("component_id"),
                                               F.min("least").alias("least"))
    of_class = salted_join(of_class.select("digest", "component"), dealt(groups, n_classes), "component", how="inner",
                           heavy="left", count_tasks=tasks_for(n_classes))
    of_class = of_class.select("digest", "component_id", F.col("least.row").alias("keep_row"))
    of_class = stage(dealt(of_class, n_classes), "class-groups")
    out = salted_join(signed.select("row", "doc_id", "n", "digest"), of_class, "digest", heavy="left",
                      count_tasks=tasks_for(signed.count()))
    alone = F.col("digest").isNull()
    return out.select("doc_id", "row", F.col("n").alias("n_shingles"),
                      F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
                      (alone | (F.col("keep_row") == F.col("row"))).alias("kept"))


def without_near_copies(docs: DataFrame, size: int = SHINGLE, threshold: int = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each group of near copies, in the same columns."""
    columns = docs.columns
    rows = stage(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
                             F.monotonically_increasing_id().alias("row")), "near-stage")
    kept = near_duplicates(rows.select("doc.doc_id", "doc.text", "row"), size, threshold).where("kept").select("row")
    return rows.join(dealt(kept, rows.count()), "row", "left_semi").select(*[F.col(f"doc.`{c}`").alias(c) for c in columns])
