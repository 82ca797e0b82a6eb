"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policylens.llm.common import LEAST_TASKS, dealt, stage

# Edges beside each other in one task.
TASK_EDGES = 50_000


def _dealt(df: DataFrame, edges: int) -> DataFrame:
    """``df`` in as many tasks as so many ``edges`` need: a contraction's tables
    shrink with the components, and a round is several shuffles and files a task."""
    return dealt(df, edges, TASK_EDGES)


def _star(edges: DataFrame, large: bool, n: int) -> DataFrame:
    """One contraction of (a, b), a > b: every node's neighbours are linked with
    the least of them and of the node; large: the greater neighbours, else the
    smaller ones and the node itself.  The least neighbours are staged, so the
    join is one of two plain scans and the optimizer splits a hub's rows.  ``n``:
    how many edges there are, which sizes the tasks."""
    both = edges
    if large:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = stage(_dealt(both.groupBy("a").agg(F.min("b").alias("_m")), n), "least")
    rows = _dealt(both.join(least, "a"), 2 * n).withColumn("_m", F.least("a", "_m"))
    if large:
        out = rows.where("b > a").select(F.col("b").alias("a"), F.col("_m").alias("b"))
    else:
        own = least.select("a", F.col("_m").alias("b"))
        out = rows.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(own)
    return stage(_dealt(out.where("a <> b").distinct(), 2 * n), "star")


def _state(edges: DataFrame) -> tuple:
    """How many edges, and a sum that tells one set of them from another."""
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, most: int | None = None) -> DataFrame:
    """(node, component): the least node reachable, for every node of the
    edges (a, b).  Nodes are numbers; self loops and repeats do no harm.
    ``most``: how many edges there are at most, if known."""
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct()
    edges = stage(edges if most is None else _dealt(edges, most), "edges")
    state = _state(edges)
    while True:
        edges = _star(_star(edges, True, state[0]), False, state[0])
        now = _state(edges)
        if now == state:
            break
        state = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    least = stars.select(F.col("component").alias("node"), "component").distinct()
    return stars.unionByName(_dealt(least, state[0]))
