"""What the operators of this subpackage share: word patterns, staged tables
in the shared folder, and prefix sums over a total order."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from policylens.session import scratch_path

# A word is a run of anything but the six ASCII white-space characters.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_az(text: Column) -> Column:
    """A-Z lower-cased and nothing else; null counts as empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD_PATTERN)).cast("long")


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_recording: list[list[str]] = []


@contextmanager
def recorded(paths: list[str]) -> Iterator[list[str]]:
    """Add to ``paths`` every table that is staged inside the block."""
    _recording.append(paths)
    try:
        yield paths
    finally:
        _recording.pop()


def release(spark: SparkSession, paths: list[str]) -> None:
    """Delete the staged tables ``paths``, which nothing may read any more, and
    let Spark's cleaner drop the shuffles of finished queries: it goes by what
    the driver's garbage collector finds."""
    for path in paths:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    paths.clear()
    spark._jvm.System.gc()


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: the
    lineage is cut, and lost executors cost nothing that was written."""
    path = scratch_path(df.sparkSession, name)
    for paths in _recording:
        paths.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def with_results(docs: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]],
                 results: StructType, text: str = "text") -> DataFrame:
    """The columns of ``docs`` but ``text``, and ``results``, which ``run`` gives
    for batches of (text, carried) beside ``carried``.  A column of ``docs``
    named as a result is replaced by it."""
    gone = {text.lower(), *(f.name.lower() for f in results)}
    others = [c for c in docs.columns if c.lower() not in gone]
    carried = F.struct(*[F.col(f"`{c}`") for c in others] or [F.lit(0).alias("nothing")]).alias("carried")
    packed = docs.select(F.col(f"`{text}`").alias("text"), carried)
    rows = packed.mapInArrow(run, StructType([StructField("carried", packed.schema["carried"].dataType), *results]))
    return rows.select(*[F.col(f"carried.`{c}`").alias(c) for c in others], *[f.name for f in results])


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


# Narrow rows beside each other in one task, and the tasks of the smallest table.
TASK_ROWS, LEAST_TASKS = 50_000, 8


def tasks_for(rows: int, each: int = TASK_ROWS) -> int:
    return max(LEAST_TASKS, -(-rows // each))


def dealt(df: DataFrame, rows: int, each: int = TASK_ROWS) -> DataFrame:
    """``df`` in as many tasks as ``rows`` need at ``each`` of them, if that is fewer
    than a shuffle's: a small table in many files costs more to write than to make."""
    tasks = tasks_for(rows, each)
    return df.coalesce(tasks) if tasks < shuffle_partitions(df.sparkSession) else df


def prefix_sums(df: DataFrame, order: Sequence[Column], value: Column, name: str = "before",
                rows: int | None = None) -> DataFrame:
    """Add ``name``: the sum of ``value`` over all rows that come earlier in
    the total order ``order``.

    Rows are range-partitioned by the order and staged with their partition
    number, each partition is summed by itself, and the partitions' totals
    (as many rows as shuffle partitions) give the offsets.  No task sees more
    than one range; rows that are equal in the whole order share a range.
    ``rows``: how many there are, if known; they size the tasks of the result.
    """
    ranged = df.withColumn("_value", value.cast("long")).repartitionByRange(
        shuffle_partitions(df.sparkSession), *order).withColumn("_part", F.spark_partition_id())
    staged = stage(ranged, "ranges")
    totals = staged.groupBy("_part").agg(F.sum("_value").alias("_total"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_part", F.coalesce(F.sum("_total").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = (staged.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
           .join(F.broadcast(offsets), "_part")
           .withColumn(name, F.col("_inside") + F.col("_offset"))
           .drop("_value", "_part", "_inside", "_offset"))
    return out if rows is None else dealt(out, rows)
