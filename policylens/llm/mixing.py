"""Mixing sources to target weights.

Each document gets a hash-random key.  Rows are range-sorted by (source, key),
a distributed prefix sum of their word counts gives every document its place
in its source, and each source is cut at its exact budget: whole epochs first,
then the words of the last, partial epoch in key order.

Defined results: a null text has size 0, a null source is a source of its own
(last), an empty table gives no rows.  Repeated rows and rows with the same
doc_id are separate rows; ties in the key are ordered by doc_id, size and a
hash of the text, and rows equal in all of these are interchangeable.  Only
the columns named here are read; others cannot clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policylens.llm.common import WORD_PATTERN, prefix_sums, stage, word_count

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MAX_EPOCHS = 2


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, source_size, start, target) per source of ``sizes`` (source, size).

    Sources in code-point order, null last, take ``weights`` in turn and share
    ``share`` of all sizes.  No target exceeds ``max_epochs`` times its
    source's size; the excess is reshared by weight among the others until
    none is above.  That fixed point is found in closed form: in the order of
    limit per unit of weight, the first source whose share of what the
    earlier ones leave stays within its limit sets the level for it and all
    later ones.  ``start`` is the size of all sources before this one.
    """
    per_source = stage(sizes.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    by_name = [F.col("source").isNull(), F.col("source")]
    n = per_source.count()                     # sizes the tasks of what follows
    placed = prefix_sums(per_source, by_name, F.lit(1), "position", n)
    placed = prefix_sums(placed, by_name, F.col("source_size"), "start", n)
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          (F.col("position") % len(weights) + 1).cast("int"))
    limited = stage(placed.withColumn("weight", weight).withColumn("limit", F.col("source_size") * max_epochs)
                    .withColumn("level", F.col("limit").cast("double") / F.col("weight")), "limits")
    by_level = [F.col("level"), *by_name]
    ranked = prefix_sums(limited, by_level, F.col("limit"), "limits_before", n)
    ranked = prefix_sums(ranked, by_level, F.col("weight"), "weights_before", n)
    all_sizes, all_weights = (limited.agg(F.sum(c)).scalar() for c in ("source_size", "weight"))
    ranked = stage(ranked.withColumn("own_level", (all_sizes * F.lit(float(share)) - F.col("limits_before"))
                                     / (all_weights - F.col("weights_before"))), "levels")
    water = ranked.where(F.col("own_level") <= F.col("level")).agg(
        F.min_by("own_level", F.struct("level", F.col("source").isNull(), "source"))).scalar()
    target = F.least(F.col("limit").cast("double"), F.coalesce(water * F.col("weight"), F.lit(float("inf"))))
    return ranked.select("source", "source_size", "start", target.alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE,
        max_epochs: int = MAX_EPOCHS, seed: str = "") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, the
    whole ``epochs`` it is taken and the ``part`` words of it in the last one.
    A column ``row`` of ``docs`` is carried through."""
    carried = ["row"] if "row" in docs.columns else []
    sizes = stage(docs.select(
        "doc_id", "source", *carried, word_count(F.col("text")).alias("size"),
        F.md5(F.concat(F.lit(seed), F.col("doc_id").cast("string"))).alias("key"),
        F.xxhash64("text").alias("tie")), "sizes")
    targets = source_targets(sizes, weights, share, max_epochs)
    order = [F.col("source").isNull(), *[F.col(c) for c in ("source", "key", "doc_id", "size", "tie", *carried)]]
    placed = prefix_sums(sizes, order, F.col("size"))
    # one row per source, each far smaller than the documents it stands for
    rows = placed.join(targets.withColumnRenamed("source", "_source"),
                       F.col("source").eqNullSafe(F.col("_source")), "inner")
    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0).cast("long")
    rest = budget - F.col("epochs") * F.col("source_size") - (F.col("before") - F.col("start"))
    return rows.withColumn("epochs", epochs).select(
        "doc_id", "source", *carried, "size", "source_size", "target", "epochs",
        F.greatest(F.lit(0), F.least(F.col("size"), rest)).cast("long").alias("part"))


def mixed_documents(docs: DataFrame, **params) -> DataFrame:
    """The mix itself, in the columns of ``docs``: each document once per whole
    epoch; the last epoch holds documents in key order up to the budget, and
    the one at the cut keeps the words that still fit, with the white space
    before each.  Documents without words cost nothing: one copy stays."""
    columns = docs.columns
    rows = stage(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
                             F.monotonically_increasing_id().alias("row")), "mix-documents")
    plan = mix(rows.select("doc.doc_id", "doc.source", "doc.text", "row"), **params)
    copies = F.when(F.col("size") == 0, F.lit(1)).otherwise(F.col("epochs") + (F.col("part") > 0).cast("long"))
    plan = plan.select("row", "size", "epochs", "part", copies.alias("copies")).where("copies > 0")
    taken = rows.join(plan, "row").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    cut = (F.col("copy") > F.col("epochs")) & (F.col("part") < F.col("size")) & (F.col("size") > 0)
    pieces = F.regexp_extract_all(F.col("doc.text"), F.lit(rf"[\x20\x09-\x0D]*{WORD_PATTERN}"), F.lit(0))
    text = F.when(cut, F.array_join(F.slice(pieces, F.lit(1), F.col("part").cast("int")), "")).otherwise(
        F.col("doc.text"))
    out = []
    for c in columns:
        column = text if c == "text" else F.col(f"doc.`{c}`")
        if c == "n_chars":
            column = F.when(cut, F.length(text).cast(docs.schema[c].dataType)).otherwise(column)
        out.append(column.alias(c))
    return taken.select(*out)
