"""Contiguous shards of near equal bytes.

Documents are put in one total order.  Rows are range-partitioned by it,
every range is summed by itself, the ranges' totals (as many rows as shuffle
partitions) give the offsets, and so each document knows the bytes of all
documents before it.  The corpus is cut at equal targets: a document belongs
to the shard in which its middle byte lies, so a cut is never further from
its target than half a document, and no shard is longer or shorter than the
target by more than one document.

Defined results: a null text has no bytes and counts ``OVERHEAD`` like every
row.  Order columns that are null come last.  Repeated ids and repeated rows
are rows of their own, ordered by size and by a hash of the text; rows equal
in these are interchangeable and are spread over the ranges by a row number
taken when they were staged.  A document longer than a shard's target has a
shard to itself and the shards that its bytes would fill stay empty.  An
empty table gives no rows.  Other columns are not read by ``shard_plan`` and
are carried in a struct by ``sharded_documents``, so no name can clash.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from policylens.llm.common import shuffle_partitions, stage

SHARDS = 40
# Bytes that a row costs besides its text.
OVERHEAD = 16


def _text_bytes(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def shard_plan(docs: DataFrame, shards: int = SHARDS, order: Sequence[str] = ("doc_id",),
               overhead: int = OVERHEAD) -> DataFrame:
    """One row per document: the ``order`` columns, ``row`` (if ``docs`` has
    it), size, text_crc32, shard and slot (the place in the shard, from 0)."""
    carried = ["row"] if "row" in docs.columns else []
    row = F.col("row") if carried else F.monotonically_increasing_id()
    keys = [f"_key{i}" for i in range(len(order))]
    data = _text_bytes(F.col("text"))
    rows = stage(docs.select(
        *[F.col(f"`{c}`").alias(k) for c, k in zip(order, keys)],
        (F.octet_length(data) + overhead).cast("long").alias("size"), F.crc32(data).alias("text_crc32"),
        F.xxhash64(data).alias("_tie"), row.alias("_row")), "shard-sizes")
    by = [c for k in keys for c in (F.col(k).isNull(), F.col(k))] + [F.col("size"), F.col("_tie"), F.col("_row")]
    ranges = stage(rows.repartitionByRange(shuffle_partitions(docs.sparkSession), *by)
                   .withColumn("_part", F.spark_partition_id()), "shard-ranges")

    totals = ranges.groupBy("_part").agg(F.sum("size").alias("_bytes"), F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = totals.select(
        "_part", F.sum("_bytes").over(everything).alias("_all"),
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("_bytes", "_rows")])
    inside = Window.partitionBy("_part").orderBy(*by)
    placed = (ranges.withColumn("_to_here", F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("_place", F.row_number().over(inside) - 1)
              .join(F.broadcast(offsets), "_part")
              # twice the bytes up to the document's middle, as whole numbers
              .withColumn("_middle", (F.col("_bytes_before") + F.col("_to_here")) * 2 - F.col("size"))
              .withColumn("_place", F.col("_place") + F.col("_rows_before"))
              .withColumn("shard", F.expr(f"int((_middle * {int(shards)}) div (2 * _all))")))
    # at most ``shards`` rows
    starts = placed.groupBy("shard").agg(F.min("_place").alias("_start"))
    return placed.join(F.broadcast(starts), "shard").select(
        *[F.col(k).alias(c) for c, k in zip(order, keys)], *([F.col("_row").alias("row")] if carried else []),
        "size", "text_crc32", "shard", (F.col("_place") - F.col("_start")).cast("long").alias("slot"))


def sharded_documents(docs: DataFrame, shards: int = SHARDS, order: Sequence[str] = ("doc_id",)) -> DataFrame:
    """(doc, size, shard, slot) per document, ``doc`` a struct of all columns of
    ``docs``; partitioned by shard and place when written with
    ``write.partitionBy("shard")``."""
    rows = stage(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                             F.monotonically_increasing_id().alias("row")), "shard-documents")
    plan = shard_plan(rows.select(*[F.col(f"doc.`{c}`").alias(c) for c in (*order, "text")], "row"), shards, order)
    return rows.join(plan.select("row", "size", "shard", "slot"), "row").select("doc", "size", "shard", "slot")
