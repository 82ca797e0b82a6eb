"""Document fingerprints from chains of words behind common words (SpotSigs).

A signature is an anchor, which is a common word, with the content words that
follow it: ``CHAIN`` of them, common words skipped.  The start of a text is
an anchor too, and so is every sixteenth content word by hash, so texts
without common words have signatures as well.  The fingerprint is the set of
signatures, written as base64 of sorted 32-bit numbers; it depends on the
text alone.  Two fingerprints are compared by Jaccard similarity; where only
values from a threshold on matter, sets whose lengths already rule it out
are not compared, and a merge stops once the rest cannot reach it.

Defined results: null counts as empty, an empty text has an empty fingerprint,
and a text without words has one signature, itself.  Two empty sets have
likeness 1.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from policylens.llm.common import shuffle_partitions, stage
from policylens.llm.hashing import LETTERS_DIGITS, mix, run_hashes

CHAIN = 3
# Common words of English, German, French and Spanish.
COMMON_WORDS = frozenset((
    "a an and are as at be but by for from had has have he her his if in into is it its not of on or she that the their "
    "there they this to was were which will with you "
    "aber als am auch auf aus bei bin das dass dem den der des die ein eine einem einen einer es für hat ich ihr im "
    "ist mit nach nicht noch nur oder sich sie sind so über um und uns von vor war wie wir zu zum zur "
    "au aux avec ce ces cette comme d dans de des du elle en est et il ils je l la le les leur lui mais ne nous on ou "
    "par pas plus pour qu que qui s sa se ses son sont sur un une vous y "
    "al con del desde e el ella ellos era esta este fue ha hay las lo los más me muy ni no o para pero por sin sobre "
    "su sus también te tiene todo una unos ya").split())

_COMMON_HASHES = np.sort(np.concatenate([run_hashes(w.encode(), LETTERS_DIGITS) for w in sorted(COMMON_WORDS)]))


def signatures(text: str | None) -> np.ndarray:
    """Sorted distinct 32-bit signatures of a text."""
    if not text:
        return np.empty(0, np.uint32)
    h = run_hashes(text.lower().encode("utf-8", "surrogatepass"), LETTERS_DIGITS)
    if not len(h):
        return np.array([xxhash.xxh32_intdigest(text.encode("utf-8", "surrogatepass"))], np.uint32)
    at = np.searchsorted(_COMMON_HASHES, h)
    common = _COMMON_HASHES[np.minimum(at, len(_COMMON_HASHES) - 1)] == h
    content = np.flatnonzero(~common)
    # the start of the text stands before the first word
    anchors = np.concatenate([[-1], np.flatnonzero(common | (h >> np.uint64(60) == 0))])
    chain = np.searchsorted(content, anchors, "right")
    words = np.concatenate([h[content], np.zeros(CHAIN, np.uint64)])
    out = np.where(anchors < 0, np.uint64(7), h[anchors])
    for k in range(CHAIN):
        out = out * np.uint64(0x9E3779B97F4A7C15) + words[np.minimum(chain + k, len(words) - 1)]
    return np.unique((mix(out) >> np.uint64(32)).astype(np.uint32))


def fingerprint(signed: np.ndarray) -> str:
    return base64.b64encode(signed.astype(">u4").tobytes()).decode("ascii")


def parse(text: str) -> np.ndarray:
    """The signatures of a fingerprint."""
    return np.frombuffer(base64.b64decode(text), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, at_least: float = 0.0) -> float:
    """Jaccard similarity of two signature sets, or 0 where it is below
    ``at_least``; sets whose lengths rule that out are not compared."""
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < at_least * large:
        return 0.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    value = common / (small + large - common)
    return value if value >= at_least else 0.0


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of ``following``."""
    n = len(text) // 3
    return text[:len(text) - n] + following[:n]


def _buckets(docs: DataFrame) -> tuple[list[int], int]:
    """Ids that begin a bucket, in descending order, of about equal rows each:
    at most one per shuffle partition, each the id of a row."""
    parts = shuffle_partitions(docs.sparkSession)
    top = docs.agg(F.max("doc_id")).first()[0]
    if top is None:
        return [], parts
    cuts = docs.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.25 / parts)
    # quantiles are ids as doubles: only those that are ids exactly may begin a bucket
    near = sorted({int(c) for c in cuts})
    real = {r[0] for r in docs.where(F.col("doc_id").isin(near)).select("doc_id").distinct().collect()} if near else set()
    return sorted({*real, top}, reverse=True), parts


def with_next(docs: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text) in descending doc_id inside partitions of
    consecutive ids, nulls last, ties by text.  The first row of the next
    partition follows each partition's own rows, marked ``_ahead``."""
    starts, parts = _buckets(docs)
    ids = np.array(starts[::-1], np.int64)                 # ascending
    last = len(starts) - 1

    @F.pandas_udf("array<int>")
    def places(ids_column: pd.Series) -> pd.Series:
        known = ids_column.notna().to_numpy()
        value = ids_column.fillna(0).astype("int64").to_numpy()
        # bucket k holds ids from starts[k] down to above starts[k + 1]
        at = np.where(known, last - np.searchsorted(ids, value, "left"), max(last, 0))
        first = known & np.isin(value, ids)
        back = np.where(at == 0, max(last, 0), at - 1)
        return pd.Series([[int(a), int(b)] if f else [int(a)] for a, b, f in zip(at, back, first, strict=True)])

    rows = docs.select("doc_id", "text", F.posexplode(places("doc_id")).alias("_ahead", "_bucket"))
    rows = rows.repartitionById(parts, "_bucket").sortWithinPartitions(
        F.col("_ahead"), F.col("doc_id").desc_nulls_last(), F.col("text"))
    return rows


def compare_with_next(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.  The next document is the one
    with the next smaller doc_id; after the last comes the first."""
    rows = with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    schema = StructType([docs.schema["doc_id"], StructField("n_chars", LongType()),
                         *[StructField(c, StringType()) for c in ("edited_sha256", "fingerprint", "edited_fingerprint")],
                         *[StructField(c, DoubleType()) for c in ("near_edited", "near_next")]])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = first = None                                # the row whose next one is still to come; the first row
        for batch in batches:
            out = []
            for doc_id, text, ahead in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "text", "_ahead")],
                                           strict=True):
                signed = signatures(text)
                first = first or (text, signed)
                if held is not None:
                    out.append(describe(*held, text, signed))
                    held = None
                if ahead:
                    break                                  # whatever follows are ties of the row ahead
                held = (doc_id, text, signed)
            else:
                yield batch_of(out)
                continue
            yield batch_of(out)
            break
        if held is not None:                               # no id at all: nothing is ahead of the only bucket
            yield batch_of([describe(*held, *first)])
        for _ in batches:
            pass

    def describe(doc_id, text, signed, next_text, next_signed):
        other = edited(text, next_text)
        other_signed = signed if other == text else signatures(other)
        return (doc_id, len(text), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(),
                fingerprint(signed), fingerprint(other_signed), likeness(signed, other_signed),
                likeness(signed, next_signed))

    arrow_id = pa.int64() if docs.schema["doc_id"].dataType == LongType() else pa.int32()
    types = [arrow_id, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = schema.names

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        columns = zip(*out, strict=True) if out else [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types, strict=True)],
                                          names=names)

    return rows.select("doc_id", "text", "_ahead").mapInArrow(run, schema)


def similar_documents(docs: DataFrame, threshold: float = 0.8) -> DataFrame:
    """(a, b, likeness) of fingerprints at least ``threshold`` alike, a < b, and
    not the same: one row per pair of distinct fingerprints, each represented
    by its least doc_id (``fingerprint_classes`` has the membership).

    Fingerprints are dealt out by set length: partition p holds lengths from
    1 / threshold ** p on, so similar sets lie in the same partition or in
    neighbouring ones.  Within a partition, sets meet on the rarest signatures
    alone, of which similar sets must share one."""
    classes = stage(fingerprint_classes(docs).groupBy("fingerprint").agg(F.min("doc_id").alias("doc_id")), "spot-classes")
    sets = stage(_exploded(classes), "spot-sets")
    counts = sets.groupBy("signature").agg(F.count(F.lit(1)).alias("rarity"))
    placed = sets.join(counts, "signature").groupBy("doc_id", "n").agg(
        F.array_sort(F.collect_list(F.struct("rarity", "signature"))).alias("s"))
    length = (F.log(F.col("n").cast("double")) / -np.log(threshold) + 1e-9).cast("int")
    short = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    rarest = F.slice(F.col("s.signature"), F.lit(1), short.cast("int"))
    keyed = stage(placed.select("doc_id", "n", F.col("s.signature").alias("s"), length.alias("part"),
                                F.explode(rarest).alias("key")), "spot-keys")
    one = keyed.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), "key", F.col("part").alias("pa"),
                       F.explode(F.array(F.col("part"), F.col("part") + 1)).alias("part"))
    two = keyed.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), "key", "part")
    near = (F.col("a") != F.col("b")) & (F.least("na", "nb") >= F.greatest("na", "nb") * threshold) & (
        (F.col("pa") != F.col("part")) | (F.col("a") < F.col("b")))
    pairs = one.join(two, ["key", "part"]).where(near).select("a", "b").distinct()
    whole = placed.select("doc_id", F.col("s.signature").alias("s"))
    both = (pairs.join(whole.withColumnsRenamed({"doc_id": "a", "s": "sa"}), "a")
            .join(whole.withColumnsRenamed({"doc_id": "b", "s": "sb"}), "b"))
    common = F.size(F.array_intersect("sa", "sb"))
    value = common / (F.size("sa") + F.size("sb") - common)
    return both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), value.alias("likeness")).where(
        F.col("likeness") >= threshold)


def fingerprint_classes(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) per document."""
    schema = StructType([docs.schema["doc_id"], StructField("fingerprint", StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(signatures(t)) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints, pa.string())], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(run, schema)


def _exploded(classes: DataFrame) -> DataFrame:
    """(doc_id, n, signature) of fingerprints, in the engine's own functions."""
    raw = F.hex(F.unbase64("fingerprint"))
    n = (F.length(raw) / 8).cast("int")
    numbers = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.conv(F.substr(raw, i * 8 + 1, F.lit(8)), 16, 10)
                          .cast("long"))
    return classes.where(F.length("fingerprint") > 0).select("doc_id", n.alias("n"), F.explode(numbers).alias("signature"))
