"""Join helpers.

``left_join`` is a plain left outer equi-join by column names (the key is
kept once; null keys never match) that is left to the planner and AQE.

``salted_join`` is the same join for keys that may be heavy.  It has one
path whatever the data look like: a key is heavy when it holds more than
``1 / (SHARE * shuffle partitions)`` of its side's rows, so at most
``SHARE * shuffle partitions`` keys can be heavy.  That arithmetic bound is
what makes the table of heavy keys safe to broadcast; nothing is collected
or left out.  Every heavy key is cut into as many pieces as its
own row count asks for, and no piece is larger than a key that is not heavy.

``salted_chain`` joins several sides on one key.  The heavy keys of all sides
are counted in one pass that moves no key, the left rows get their piece once
and keep it, so no join of the chain moves them again.  The same pass counts
the sides' rows: a chain of more rows than ``TASK_ROWS`` for each shuffle
partition is dealt to more tasks, so what a task sorts does not grow with the input.
Where such a chain has no heavy key, every side is dealt by the key alone, and a
side that is aggregated by it first, or joined on more columns, stays where it is:
each row is moved once.

A piece must be the same when a lost executor's rows are computed again.  A
row id is, above a file scan; above a shuffle it is not, since rows come in
any order.  ``stable_rows`` decides from the plan and writes such a side to
the shared folder first; a chain without heavy keys needs no row ids and
writes none.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from policylens.session import scratch_path

# Pieces per shuffle partition: a key is cut when it alone fills more than
# a quarter of an average task.
SHARE = 4
# Numbers per shuffle partition over which rows with a null key are spread.
SPREAD = 64
# Rows of all sides of a chain, beside each other in one task.
TASK_ROWS = 500_000


def left_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str]) -> DataFrame:
    keys = [keys] if isinstance(keys, str) else list(keys)
    return left.join(right, keys, "left_outer")


# Plan nodes below which rows have no order of their own.
MOVES_ROWS = {"Join", "AsOfJoin", "Aggregate", "Distinct", "Deduplicate", "Window", "Sort", "Repartition",
              "RepartitionByExpression", "RebalancePartitions", "GlobalLimit", "Intersect", "Except"}


def moves_rows(df: DataFrame) -> bool:
    """Does ``df`` have a shuffle of rows, or what may become one, in its plan?"""
    def below(plan) -> bool:
        children = plan.children()
        return plan.nodeName() in MOVES_ROWS or any(below(children.apply(i)) for i in range(children.size()))

    plan = getattr(df, "_jdf", None)         # Spark Connect does not show plans: taken as one that does
    return plan is None or below(plan.queryExecution().analyzed())


def stable_rows(df: DataFrame) -> DataFrame:
    """``df`` with rows whose row id is the same whenever they are computed:
    itself above file scans, else written to the shared folder and read back."""
    return _written(df, "stable-rows") if moves_rows(df) else df


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def heavy_keys(df: DataFrame, keys: Sequence[str], pieces: str, tasks: int | None = None) -> DataFrame:
    """Heavy keys of ``df`` with the number of ``pieces`` (at least 2) each is
    cut into.  At most ``SHARE * shuffle partitions`` rows, by arithmetic.
    ``tasks``: how many are enough to count the keys in (default: a shuffle's)."""
    total = df.agg(F.count(F.lit(1)).alias("_total")).scalar()
    share = SHARE * _partitions(df)
    counts = df.dropna(subset=list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    if tasks is not None and tasks < _partitions(df):
        counts = counts.coalesce(tasks)
    return counts.where(F.col("_n") * share > total).select(
        *keys, F.greatest(F.lit(2), F.ceil(F.col("_n") * share / total)).cast("int").alias(pieces))


def _row_hash(salt_by: Sequence[str] | None) -> Column:
    """What a row's piece is chosen by, the same when a task is recomputed: the
    row id of ``stable_rows``, which tells identical copies apart, or the
    columns ``salt_by`` of rows that move."""
    return F.xxhash64(*[F.col(f"`{c}`") for c in salt_by] if salt_by else [F.monotonically_increasing_id()])


def _piece(pieces: str) -> Column:
    return F.pmod(F.col("_row_hash"), F.col(pieces)).cast("int")


def _row_salt(df: DataFrame, pieces: Column, salt_by: Sequence[str] | None) -> Column:
    """A piece per row, the same when a task is recomputed.  The row id spreads
    identical copies of a file scan's or a staged table's rows; rows behind a
    shuffle come in any order, and have a piece by their columns ``salt_by``."""
    what = [F.col(f"`{c}`") for c in salt_by] if salt_by else [
        *[F.col(f"`{c}`") for c in df.columns], F.monotonically_increasing_id()]
    return F.pmod(F.xxhash64(*what), pieces).cast("int")


def _every_piece(pieces: str) -> Column:
    return F.explode(F.sequence(F.lit(0), F.coalesce(F.col(pieces), F.lit(1)) - 1))


def _spread(df: DataFrame, by: Sequence[str] | None) -> Column:
    """A number per row for rows that match nothing, many to a task, so that
    each task gets about as many."""
    numbers = F.lit(SPREAD * _partitions(df))
    return F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in (by or df.columns)]), numbers).cast("int")


class Step(NamedTuple):
    """One left outer join of a chain.  ``unique``: ``right`` has at most one row
    per key.  ``count_on``: a cheaper frame with the same rows per key.
    ``where`` filters the joined rows before the next join.  ``salt_by``:
    columns that tell the rows of ``right`` apart, if it has such.  ``rows``: about
    how many a unique ``right`` has at most (default: as the chain's left; or
    ``count_on``, the rows that it is aggregated from, is counted)."""

    right: DataFrame
    unique: bool = False
    count_on: DataFrame | None = None
    where: Column | None = None
    salt_by: Sequence[str] | None = None
    rows: int | None = None
    keys: Sequence[str] | None = None        # other columns joined on, of a chain that is dealt


class Heavy(NamedTuple):
    """The heavy keys of a chain's sides: a small staged table, and whether it has
    rows.  ``rows``: of the left and of all sides that were counted.  ``even``: no
    key of any of these is heavy, nor are the rows with a null key."""

    table: DataFrame
    found: bool
    rows: tuple[int, int]
    even: bool = False


# Groups of keys per heavy key that there can be.
GROUPS = 8


class Chain(NamedTuple):
    """The sides of a chain by number (the left is 0), the keys it joins on, and the
    sides that are counted but not cut: they are aggregated before their join."""

    sides: dict[int, DataFrame]
    keys: list[str]
    whole: frozenset[int] = frozenset()


def _grouped_keys(chain: Chain, groups: int) -> DataFrame:
    """The keys of all sides of ``chain``, each with its side and its group of keys."""
    no_null, rows = F.lit(True), None
    for k in chain.keys:
        no_null = no_null & F.col(k).isNotNull()
    for i, df in chain.sides.items():
        own = df.select(*chain.keys, F.lit(i).alias("_side"), F.when(
            no_null, F.pmod(F.xxhash64(*chain.keys), F.lit(groups)).cast("int")).alias("_group"))
        rows = own if rows is None else rows.unionByName(own)
    return rows


def _heavy_of_sides(chains: Sequence[Chain]) -> list[Heavy]:
    """For each chain the keys that are heavy on some side: ``_lp`` pieces of the left
    (side 0), ``_rp`` pieces of the right that is cut, and ``_split``, its number.  At
    most ``SHARE * shuffle partitions`` rows for each side, by arithmetic.

    Rows of all chains are counted in one job, by a hash of their keys first, a
    bounded number of groups of keys, so no key is moved.  A heavy key makes its
    group as large as itself; only the keys of groups that large, as few as heavy
    keys can be, are counted one by one, and there are none if no key is heavy."""
    share, group = SHARE * _partitions(chains[0].sides[0]), F.col("_group")
    rows = [_grouped_keys(chain, GROUPS * share) for chain in chains]
    every = None
    for c, own in enumerate(rows):
        own = own.select(F.lit(c).alias("_chain"), "_side", "_group")
        every = own if every is None else every.unionByName(own)
    counts = _written(every.groupBy("_chain", "_side", "_group").agg(F.count(F.lit(1)).alias("_n")), "key-groups")
    by_side = counts.groupBy("_chain", "_side").agg(
        F.sum("_n").alias("_rows"), F.sum(F.when(group.isNull(), F.col("_n")).otherwise(0)).alias("_nulls")).collect()
    large = F.lit(False)
    for r in by_side:
        large = large | ((F.col("_chain") == r["_chain"]) & (F.col("_side") == r["_side"])
                         & (F.col("_n") * share > r["_rows"]))
    groups = counts.where(group.isNotNull() & large).select("_chain", "_group").distinct().collect()
    return [_heavy_of_chain(chain, rows[c], [r["_group"] for r in groups if r["_chain"] == c],
                            {r["_side"]: r for r in by_side if r["_chain"] == c}, share)
            for c, chain in enumerate(chains)]


def _heavy_of_chain(chain: Chain, rows: DataFrame, groups: list[int], by_side: dict[int, Row], share: int) -> Heavy:
    keys, sides, whole, side = chain.keys, chain.sides, chain.whole, F.col("_side")
    totals = {i: r["_rows"] for i, r in by_side.items()}
    spread = all(r["_nulls"] * share <= r["_rows"] for r in by_side.values())
    pieces = {}
    for i in sides:
        n, total = F.col(f"_n{i}"), F.lit(totals.get(i, 1))
        pieces[i] = F.when(n * share > total, F.greatest(F.lit(2), F.ceil(n * share / total)).cast("int"))
    cuts = [F.when(p.isNotNull(), F.struct(p.alias("pieces"), F.lit(i).alias("side")))
            for i, p in pieces.items() if i > 0 and i not in whole]
    cut = F.greatest(*cuts) if len(cuts) > 1 else cuts[0] if cuts else F.lit(None).cast("struct<pieces:int,side:int>")
    heavy = (rows.where(F.col("_group").isin(groups)) if groups
             else rows.sparkSession.createDataFrame([], rows.schema)).groupBy(*keys).agg(
        *[F.count_if(side == i).alias(f"_n{i}") for i in sides]).select(
        *keys, pieces[0].alias("_lp"), cut.alias("_cut"), *[pieces[i].alias(f"_whole{i}") for i in whole]).where(
        F.coalesce(F.col("_lp"), F.col("_cut.side"), *[F.col(f"_whole{i}") for i in whole]).isNotNull()).select(
        *keys, "_lp", F.col("_cut.pieces").alias("_rp"), F.col("_cut.side").alias("_split"))
    table = _written(heavy, "heavy-keys")
    some = bool(groups) and not table.isEmpty()
    found = some and not (whole and table.where("_lp is not null or _rp is not null").isEmpty())
    return Heavy(table, found, (totals.get(0, 0), sum(totals.values())), spread and not some)


def none_heavy(df: DataFrame, keys: Sequence[str], rows: tuple[int, int]) -> Heavy:
    """For a chain on ``keys`` of ``df`` that is known to have no heavy key and about so many ``rows``."""
    table = df.limit(0).select(*keys, *[F.lit(0).alias(c) for c in ("_lp", "_rp", "_split")])
    return Heavy(_written(df.sparkSession.createDataFrame([], table.schema), "heavy-keys"), False, rows)


def _tasks(heavy: Heavy, steps: Sequence[Step]) -> int:
    """Tasks that take ``TASK_ROWS`` rows of a chain's sides each."""
    left, counted = heavy.rows
    rows = counted + sum(left if s.rows is None else s.rows for s in steps if s.unique and s.count_on is None)
    return -(-rows // TASK_ROWS)


def heavy_of_chain(left: DataFrame, keys: str | Sequence[str], steps: Sequence[Step]) -> Heavy:
    """What a chain of ``left`` and ``steps`` on ``keys`` cuts, for plans that
    must know it before they build the chain's left."""
    return heavy_of_chains((left, keys, steps))[0]


def heavy_of_chains(*chains: tuple[DataFrame, str | Sequence[str], Sequence[Step]]) -> list[Heavy]:
    """``heavy_of_chain`` of several chains, counted in one job that reads what they share once."""
    told = []
    for left, keys, steps in chains:
        keys = [keys] if isinstance(keys, str) else list(keys)
        told.append(Chain({0: left.select(*keys)} | {
            i: (s.right if s.count_on is None else s.count_on).select(*keys)
            for i, s in enumerate(steps, 1) if not s.unique or s.count_on is not None}, keys,
            frozenset(i for i, s in enumerate(steps, 1) if s.unique and s.count_on is not None)))
    return _heavy_of_sides(told)


def arranged(df: DataFrame) -> DataFrame:
    """``df`` with its text columns first, its dates last: a shuffle compresses rows
    better if what differs from row to row lies together."""
    kinds = {"string": 0, "timestamp_ntz": 2, "timestamp": 2, "date": 2}
    return df.select(*[F.col(f"`{c}`") for c, kind in sorted(df.dtypes, key=lambda x: kinds.get(x[1], 1))])


def dealt_tasks(left: DataFrame, heavy: Heavy, steps: Sequence[Step] = ()) -> int | None:
    """Tasks that a chain is dealt to by its key alone, the shuffle's partitions at
    least: where it has rows for more than one and no heavy key, else None."""
    tasks = _tasks(heavy, steps)
    return max(tasks, _partitions(left)) if heavy.even and tasks > 1 else None


def dealt_chain(left: DataFrame, key: str, steps: Sequence[Step], tasks: int) -> DataFrame:
    """``left`` left outer joined with every step's ``right`` in turn, all dealt to
    ``tasks`` by ``key``, which is not heavy on any side.  A step joins on ``key``
    and on ``Step.keys``; a ``unique`` right was dealt before it was aggregated.
    Where a step has such ``keys``, tasks are dealt by their number, which is part of
    every join's key: Spark would deal rows again that lie by ``key`` alone."""
    columns, numbered = list(left.columns), any(s.keys for s in steps)

    def deal(df: DataFrame) -> DataFrame:
        df = arranged(df)
        if not numbered:
            return df.repartition(tasks, key)
        return df.withColumn("_task", F.pmod(F.xxhash64(key), F.lit(tasks)).cast("int")).repartitionById(tasks, "_task")

    out = deal(left)
    for step in steps:
        on = [*(["_task"] if numbered else []), key, *(step.keys or ())]
        columns += [c for c in step.right.columns if c not in on]
        out = out.join(step.right if step.unique and not numbered else deal(step.right), on, "left_outer")
        if step.where is not None:
            out = out.where(step.where)
    return out.select(*[F.col(f"`{c}`") for c in columns])


def grouped_rows(rows: DataFrame, key: str, aggs: Sequence[Column], others: Sequence[str] = (),
                 heavy: Heavy | None = None) -> DataFrame:
    """``rows.groupBy(key, *others).agg(*aggs)`` for any number of keys: rows more than
    ``TASK_ROWS`` for each shuffle partition are dealt to more tasks before they are
    aggregated, so the groups of one task do not grow with the input.  What is dealt
    so is not aggregated before its shuffle; heavy keys and the null key are, in an
    aggregate of their own, where they are few groups by arithmetic unless ``others``
    part them.  ``heavy``: what was found in the chain that the groups are joined in,
    ``rows`` among its sides; they are dealt to its tasks if that has no heavy key."""
    tasks = None if heavy is None else dealt_tasks(rows, heavy)
    if tasks is not None:
        return rows.repartition(tasks, key).groupBy(key, *others).agg(*aggs)
    if heavy is None or _tasks(heavy, []) > _partitions(rows):
        heavy = heavy_of_chain(rows, key, [])
    tasks = _tasks(heavy, [])
    if tasks <= _partitions(rows):
        return rows.groupBy(key, *others).agg(*aggs)
    light, few = F.col(key).isNotNull(), F.col(key).isNull()
    if heavy.found:
        rows = rows.join(F.broadcast(heavy.table.select(key, F.lit(True).alias("_heavy"))), key, "left_outer")
        light, few = light & F.col("_heavy").isNull(), few | F.col("_heavy").isNotNull()
    return rows.where(light).repartition(tasks, key).groupBy(key, *others).agg(*aggs).unionByName(
        rows.where(few).groupBy(key, *others).agg(*aggs))


def with_row_key(df: DataFrame, name: str) -> DataFrame:
    """Add ``name``, a number that tells rows apart, equal ones too; it can be
    carried through joins and be what later pieces are chosen by."""
    return stable_rows(df).withColumn(name, F.monotonically_increasing_id())


def salted_chain(left: DataFrame, keys: str | Sequence[str], steps: Sequence[Step],
                 spread_by: Sequence[str] | None = None, salt_by: Sequence[str] | None = None,
                 count_left: DataFrame | None = None, heavy: Heavy | None = None) -> DataFrame:
    """``left`` left outer joined with every step's ``right`` in turn, all on
    ``keys``.

    A heavy key is cut twice: its left rows into pieces by the left's own
    count, and the right side that has most rows of it into pieces by that
    side's count.  Left rows go to one piece of the first and to every piece of
    the second kind, rows of the side that is cut the other way round, rows of
    the other sides to all.  Copies of left rows that meet no row of the side
    that is cut are dropped at its step.  Rows with a null key match nothing
    and are spread over all tasks.  The pieces are part of every join's key and
    the left rows keep them from the first join to the last.

    ``salt_by``: columns that tell the left rows apart (default: the row id of
    ``stable_rows``); ``count_left``: a cheaper frame whose rows per key are in
    proportion to those of ``left``; ``heavy``: what ``heavy_of_chain`` found.
    Only where a key is heavy is any side written for its row ids.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    columns = list(left.columns)
    if heavy is None:
        heavy = heavy_of_chain(left if count_left is None else count_left, keys, steps)
    tasks = dealt_tasks(left, heavy, steps) if len(keys) == 1 else None
    if tasks is not None:
        return dealt_chain(left, keys[0], steps, tasks)

    def pieces_by(columns: Sequence[str] | None) -> Column:
        return _row_hash(columns) if heavy.found else F.lit(0).cast("long")

    left = left if salt_by or not heavy.found else stable_rows(left)
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    rights = [s.right if s.unique or s.salt_by or not heavy.found else stable_rows(s.right) for s in steps]
    cuts = F.broadcast(heavy.table)
    on = [*keys, "_ls", "_rs"]
    out = (arranged(left).withColumn("_row_hash", pieces_by(salt_by)).join(cuts, keys, "left_outer")
           .withColumn("_ls", F.when(null_key, _spread(left, spread_by)).when(F.col("_lp").isNull(), 0)
                       .otherwise(_piece("_lp")))
           .withColumn("_rs", _every_piece("_rp")).drop("_lp", "_rp", "_row_hash"))
    tasks = _tasks(heavy, steps)
    if tasks > _partitions(left):            # the joins take over this number
        out = out.repartition(tasks, *on)
    for i, (step, right) in enumerate(zip(steps, rights), 1):
        columns += [c for c in right.columns if c not in keys]
        if step.unique:
            r = arranged(right).join(cuts, keys, "left_outer").withColumn("_rs", _every_piece("_rp"))
        else:
            cut = F.coalesce(F.col("_split") == i, F.lit(False))
            last = F.coalesce(F.col("_rp"), F.lit(1)) - 1
            r = arranged(right).withColumn("_row_hash", pieces_by(step.salt_by)).join(cuts, keys, "left_outer")
            r = r.withColumn("_rs", F.explode(F.sequence(
                F.when(cut, _piece("_rp")).otherwise(0), F.when(cut, _piece("_rp")).otherwise(last)))).drop("_row_hash")
        r = r.withColumn("_ls", _every_piece("_lp")).drop("_lp", "_rp", "_split").withColumn("_hit", F.lit(True))
        out = out.join(r, on, "left_outer")
        if not step.unique:
            out = out.where(F.col("_hit").isNotNull() | ~F.coalesce(F.col("_split") == i, F.lit(False)))
        out = out.drop("_hit")
        if step.where is not None:
            out = out.where(step.where)
    return out.select(*[F.col(f"`{c}`") for c in columns])


def salted_join(left: DataFrame, right: DataFrame, keys: str | Sequence[str], how: str = "left_outer",
                heavy: str = "right", count_right: DataFrame | None = None,
                spread_by: Sequence[str] | None = None, salt_by: Sequence[str] | None = None,
                count_left: DataFrame | None = None, count_tasks: int | None = None) -> DataFrame:
    """``left.join(right, keys, how)`` for ``how`` "left_outer" or "inner", with
    heavy keys of the ``heavy`` side ("left", "right", "both" or "none") cut in
    pieces.  "none" is for keys known to be unique on both sides.

    A row of a heavy key goes to one piece: by a hash of the row and its row id
    where the heavy side is a file scan or staged, by a hash of ``salt_by``,
    columns that tell its rows apart, where it is not.  The other side's rows of that key are copied to every piece.  A left outer
    join drops the copies that met no row in their piece: a key that is heavy
    on the right has a match in another piece.  Left rows with a null key match
    nothing and are spread over all tasks by a hash of ``spread_by`` (default:
    every column; naming a few lets the others be pruned).  ``count_right`` is
    a cheaper frame to count right keys on, with the same rows per key (default:
    ``right``), ``count_left`` one for left keys; ``count_tasks``: as many tasks
    are enough to count them in, where that is fewer than a shuffle's.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    l_cols = list(left.columns)
    r_cols = [c for c in right.columns if c not in keys]
    outer = how == "left_outer"
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()

    if not salt_by:                          # pieces by row id: of rows that do not move
        left = stable_rows(left) if heavy in ("left", "both") else left
        right = stable_rows(right) if heavy in ("right", "both") else right
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in (spread_by or l_cols)]),
                    F.lit(_partitions(left))).cast("int")
    l, r, on = left, right.withColumn("_hit", F.lit(True)), list(keys)
    if heavy in ("right", "both"):
        table = heavy_keys((right if count_right is None else count_right).select(*keys), keys, "_rp", count_tasks)
        r = r.join(F.broadcast(table), keys, "left_outer").withColumn(
            "_rs", F.when(F.col("_rp").isNull(), 0).otherwise(_row_salt(right, F.col("_rp"), salt_by))).drop("_rp")
        l = l.join(F.broadcast(table), keys, "left_outer").withColumn("_rs", _every_piece("_rp"))
        on.append("_rs")
    if heavy in ("left", "both"):
        table = heavy_keys((left if count_left is None else count_left).select(*keys), keys, "_lp", count_tasks)
        l = l.join(F.broadcast(table), keys, "left_outer").withColumn(
            "_ls", F.when(null_key, spread).when(F.col("_lp").isNull(), 0)
            .otherwise(_row_salt(left, F.col("_lp"), salt_by))).drop("_lp")
        r = r.join(F.broadcast(table), keys, "left_outer").withColumn("_ls", _every_piece("_lp")).drop("_lp")
        on.append("_ls")
    elif outer:
        l = l.withColumn("_ls", F.when(null_key, spread).otherwise(0))
        # zero, but not as a literal: the optimizer would drop it from the join keys
        r = r.withColumn("_ls", F.pmod(F.hash(*keys), F.lit(1)))
        on.append("_ls")
    out = l.join(r, on, how)
    if outer and heavy in ("right", "both"):
        # a key can be heavy on the right only if it has rows there
        out = out.where(F.col("_hit").isNotNull() | F.col("_rp").isNull())
    return out.select(*[F.col(f"`{c}`") for c in [*l_cols, *r_cols]])
