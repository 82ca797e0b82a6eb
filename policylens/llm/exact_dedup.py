"""Exact dedup against a persistent digest index.

The index is a table bucketed and sorted by digest.  A batch is reduced to
one row per digest (partial aggregation first) in buckets of the same kind,
sort-merge anti-joined with the index, and what is new is appended.  Neither
side of that join is shuffled; each task sorts one bucket.

A job may die after the append and before its result is written.  Each row of
the index therefore carries the name of its batch: a rerun under the same name
takes the rows of that batch for its own, appends only those that are missing
and returns what the lost run would have.  Without a name every call is a new
batch, for which all that the index holds is older.

Defined results: texts are equal when identical after lower-casing A-Z; null
counts as empty.  Of equal texts in a batch the row with the largest doc_id
stays, null ids last; of rows that tie in doc_id too, one stays.  A text that
the index already holds from another batch keeps its indexed id and no row of
the batch stays.  Very long texts are hashed whole and never moved; an empty
table gives no rows.  Other columns are not read.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from policylens.llm.common import lower_az, shuffle_partitions, stage, tasks_for
from policylens.operators.joins import salted_join
from policylens.session import scratch_path


def text_digest(text: Column) -> Column:
    """SHA-256 (32 bytes) of the normalised text."""
    return F.unhex(F.sha2(lower_az(text), 256))


class DigestIndex:
    """A bucketed, sorted table of (digest, keep_id) under ``path``.

    ``path`` must lie in storage that driver and executors share.  Opening a
    path that holds an index (same ``buckets``) goes on with it."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None,
                 id_type: str = "bigint"):
        self.spark = spark
        self.path = path or scratch_path(spark, "digest-index")
        self.buckets = buckets or shuffle_partitions(spark)
        self.table = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.table} (digest BINARY, keep_id {id_type}, batch STRING) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self.path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.table)

    def _write(self, df: DataFrame, table: str, path: str, mode: str) -> DataFrame:
        (df.repartition(self.buckets, "digest").write.mode(mode).format("parquet")
         .bucketBy(self.buckets, "digest").sortBy("digest").option("path", path).saveAsTable(table))
        return self.spark.table(table)

    def older(self, groups: DataFrame, batch: str) -> DataFrame:
        """Rows of the index for the digests of ``groups`` (in the index's buckets): digest, held_id, own."""
        return groups.select("digest").join(self.rows().hint("merge"), "digest").select(
            "digest", F.col("keep_id").alias("held_id"), F.col("batch").eqNullSafe(F.lit(batch)).alias("own"))

    def add(self, rows: DataFrame, batch: str | None = None) -> DataFrame:
        """Append the new digests of ``rows`` (row, doc_id, digest) and return one
        row per digest of it: digest, keep_id, group_size, keep_row (null when
        another batch brought the digest before)."""
        batch = batch or uuid.uuid4().hex
        newest = F.max(F.struct(F.col("doc_id"), (-F.col("row")).alias("row")))
        table = f"digest_groups_{uuid.uuid4().hex}"
        groups = self._write(rows.groupBy("digest").agg(newest.alias("keep"), F.count(F.lit(1)).alias("group_size")),
                             table, scratch_path(self.spark, "digest-groups"), "error")
        held = stage(self.older(groups, batch), "digests-held")
        fresh = groups.select("digest", F.col("keep.doc_id").alias("keep_id"), F.lit(batch).alias("batch")).join(
            self.rows().hint("merge"), "digest", "left_anti")
        self._write(fresh, self.table, self.path, "append")
        known = held.where(~F.col("own")).select("digest", F.lit(True).alias("known"), "held_id")
        told = stage(groups.join(known, "digest", "left_outer").select(
            "digest", "group_size",
            F.when(F.col("known"), F.col("held_id")).otherwise(F.col("keep.doc_id")).alias("keep_id"),
            F.when(F.col("known").isNull(), -F.col("keep.row")).alias("keep_row")), "digests-told")
        self.spark.sql(f"DROP TABLE {table}")              # the catalog's entry; the files are scratch
        return told


def exact_duplicates(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """One row per document: doc_id, row, keep_id, group_size, kept, digest.
    ``docs`` is added to ``index`` (default: a new one) as ``batch``; name it
    where a lost run may have to be run again."""
    row = F.col("row") if "row" in docs.columns else F.monotonically_increasing_id()
    rows = stage(docs.select("doc_id", row.alias("row"), text_digest(F.col("text")).alias("digest")), "digests")
    index = index or DigestIndex(docs.sparkSession, id_type=docs.schema["doc_id"].dataType.simpleString())
    groups = index.add(rows, batch)
    joined = salted_join(rows, groups, "digest", how="inner", heavy="left", count_tasks=tasks_for(rows.count()))
    return joined.select("doc_id", "row", "keep_id", "group_size",
                         F.coalesce(F.col("keep_row") == F.col("row"), F.lit(False)).alias("kept"), "digest")


def without_copies(docs: DataFrame, index: DigestIndex | None = None, batch: str | None = None) -> DataFrame:
    """``docs`` with one row of each text, in the same columns."""
    columns = docs.columns
    rows = stage(docs.select(F.struct(*[F.col(f"`{c}`") for c in columns]).alias("doc"),
                             F.monotonically_increasing_id().alias("row")), "dedup-documents")
    kept = exact_duplicates(rows.select("doc.doc_id", "doc.text", "row"), index, batch).where("kept").select("row")
    return rows.join(kept, "row", "left_semi").select(*[F.col(f"doc.`{c}`").alias(c) for c in columns])
