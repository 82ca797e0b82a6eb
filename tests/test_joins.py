"""Join helpers: the salted join equals a plain join and spreads heavy and null keys."""

import pytest
from pyspark.sql import functions as F

from policylens.operators import joins
from policylens.operators.joins import (
    MOVES_ROWS, Step, heavy_keys, left_join, moves_rows, salted_chain, salted_join, stable_rows, with_row_key,
)
from policylens.plans.endorsement import details_by_application, head_with_multiplicity
from policylens.queries import spark_queries
from policylens.sources.adapter import sources_for
from tests.conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.select(sorted(df.columns)).collect()),
                  key=lambda t: tuple((x is None, str(x)) for x in t))


@pytest.fixture
def sides(spark):
    left = spark.createDataFrame(
        [("H", 1), ("H", 2), ("H", 2), ("a", 3), ("b", 4), (None, 5), (None, 5), ("z", 6)], "k string, l int")
    right = spark.range(0, 5000).select(
        F.when(F.col("id") < 4000, F.lit("H")).when(F.col("id") < 4003, F.lit("a"))
        .when(F.col("id") < 4010, F.lit(None)).otherwise(F.lit("b")).alias("k"),
        (F.col("id") % 7).alias("r"))
    return left, right


@pytest.mark.parametrize("heavy", ["right", "left", "both", "none"])
@pytest.mark.parametrize("how", ["left_outer", "inner"])
def test_salted_join_equals_plain_join(sides, heavy, how):
    left, right = sides
    assert rows(salted_join(left, right, "k", how, heavy)) == rows(left.join(right, ["k"], how))
    assert rows(salted_join(right, left, "k", how, heavy)) == rows(right.join(left, ["k"], how))


def test_salted_join_without_heavy_keys_and_without_rows(spark):
    left = spark.createDataFrame([("a", 1)], "k string, l int")
    right = spark.createDataFrame([("a", 2), ("a", 3)], "k string, r int")
    assert rows(salted_join(left, right, "k")) == rows(left_join(left, right, "k"))
    assert rows(salted_join(left, right.limit(0), "k", heavy="both")) == [("a", 1, None)]
    assert rows(salted_join(left.limit(0), right, "k", heavy="both")) == []


def test_composite_keys(spark):
    left = spark.createDataFrame(
        [("H", "p1", 1), ("H", "p2", 2), ("H", None, 3), ("a", "p1", 4), (None, "p1", 5)], "k string, p string, l int")
    right = spark.range(0, 2000).select(
        F.when(F.col("id") < 1900, F.lit("H")).otherwise(F.lit("a")).alias("k"),
        F.when(F.col("id") % 2 == 0, F.lit("p1")).otherwise(F.lit("p9")).alias("p"),
        (F.col("id") % 5).alias("r"))
    assert rows(salted_join(left, right, ["k", "p"])) == rows(left.join(right, ["k", "p"], "left_outer"))


def test_heavy_keys_are_bounded_and_cut_by_their_own_count(spark):
    df = spark.range(0, 10_000).select(F.when(F.col("id") < 5000, -1).otherwise(F.col("id")).alias("k"))
    found = {r["k"]: r["pieces"] for r in heavy_keys(df, ["k"], "pieces").collect()}
    assert found == {-1: 16}                 # half of the rows over 4 pieces for each of 8 partitions


def test_salt_by_columns_does_not_depend_on_row_order(spark):
    left = spark.range(0, 4000).select(F.lit(1).alias("k"), F.col("id").alias("l"))
    right = spark.createDataFrame([(1, "x")], "k int, r string")
    for heavy, one, two in (("left", left, right), ("right", right, left)):
        out = salted_join(one, two, "k", how="inner", heavy=heavy, salt_by=["l"])
        assert "monotonically_increasing_id" not in out._jdf.queryExecution().analyzed().toString()
        assert rows(out) == rows(one.join(two, "k"))


def row_ids_above_moved_rows(plan):
    """Plan nodes with a row id in an expression and rows that move below."""
    def moves(p):
        return p.nodeName() in MOVES_ROWS or any(moves(c) for c in children(p))

    def children(p):
        return [p.children().apply(i) for i in range(p.children().size())]

    below = children(plan)
    own = "monotonically_increasing_id" in plan.expressions().toString() and any(moves(c) for c in below)
    return ([plan.nodeName()] if own else []) + [x for c in below for x in row_ids_above_moved_rows(c)]


def test_the_guard_sees_a_row_id_above_an_aggregate(spark):
    moved = spark.range(9).groupBy((F.col("id") % 2).alias("k")).count()
    bad = moved.withColumn("row", F.monotonically_increasing_id())
    assert row_ids_above_moved_rows(bad._jdf.queryExecution().analyzed()) == ["Project"]
    assert moves_rows(moved) and not moves_rows(stable_rows(moved)) and not moves_rows(spark.range(3))
    assert rows(stable_rows(moved)) == rows(moved)


@pytest.mark.parametrize("name", sorted(set(spark_queries()) - {"stream_policy_indicators"}))
def test_no_registered_plan_has_a_row_id_above_moved_rows(spark, name):
    df = spark_queries()[name](spark, SF_SMALL)
    assert row_ids_above_moved_rows(df._jdf.queryExecution().analyzed()) == []


def largest_task(df):
    return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]


def test_null_and_heavy_keys_spread_over_tasks(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 40_000).select(
            F.when(F.col("id") % 20 == 0, F.col("id")).alias("k"), F.col("id").alias("l"))
        right = spark.range(0, 40_000, 20).select(F.col("id").alias("k"), F.col("id").alias("r"))
        assert largest_task(salted_join(left, right, "k")) < 2 * 40_000 / 8
        copies = spark.range(0, 30_000).select(F.lit(0).cast("long").alias("k"), F.lit(7).alias("r"))
        assert largest_task(salted_join(spark.range(1).withColumnRenamed("id", "k"), copies, "k")) < 2 * 30_000 / 8
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.fixture
def no_broadcast(spark):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def chain_sides(spark):
    left = spark.range(0, 900).select(
        F.when(F.col("id") < 400, "H").when(F.col("id") < 500, None).when(F.col("id") < 520, "R")
        .otherwise(F.concat(F.lit("k"), F.col("id") % 90)).alias("k"), (F.col("id") % 11).alias("l"))
    one = spark.range(0, 700).select(
        F.when(F.col("id") < 600, "R").when(F.col("id") < 603, "H").when(F.col("id") < 620, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 90)).alias("k"), (F.col("id") % 7).alias("a"))
    two = spark.range(0, 60).select(F.concat(F.lit("k"), F.col("id")).alias("k"), F.col("id").alias("b")).union(
        spark.createDataFrame([("H", 1000), (None, 5)], "k string, b long"))
    three = spark.range(0, 300).select(F.when(F.col("id") < 200, "k1").when(F.col("id") < 206, "R")
                                       .otherwise(F.lit("none")).alias("k"), (F.col("id") % 5).alias("c"))
    return left, one, two, three


def test_chain_equals_plain_joins(spark):
    left, one, two, three = chain_sides(spark)
    plain = left.join(one, ["k"], "left_outer").where("a is null or a <> 3").join(two, ["k"], "left_outer").join(
        three, ["k"], "left_outer")
    steps = [Step(one, where=F.expr("a is null or a <> 3")), Step(two, unique=True), Step(three)]
    assert rows(salted_chain(left, "k", steps)) == rows(plain)
    keyed = with_row_key(left, "_row")
    assert rows(salted_chain(keyed, "k", steps, spread_by=["l"], salt_by=["_row"], count_left=left).drop("_row")) == (
        rows(plain))
    empty = [Step(one.limit(0)), Step(two.limit(0), unique=True)]
    assert rows(salted_chain(left, "k", empty)) == rows(left.withColumns({
        "a": F.lit(None).cast("long"), "b": F.lit(None).cast("long")}))
    assert rows(salted_chain(left.limit(0), "k", steps)) == []


def spread_of(df, column):
    """Rows in the largest task over the mean.  Reads ``column`` of a right side:
    the optimizer drops a left join of unique keys that nothing reads."""
    counts = df.select(F.spark_partition_id().alias("p"), F.hash(column).alias("h")).groupBy("p").agg(
        F.count(F.lit(1)).alias("n"), F.max("h")).collect()
    return max(r["n"] for r in counts) * 16 / sum(r["n"] for r in counts)


@pytest.mark.parametrize("kind", ["null", "hot"])
def test_a_chain_keeps_null_and_hot_left_keys_spread(spark, no_broadcast, kind):
    hot = F.lit(None).cast("long") if kind == "null" else F.lit(7).cast("long")
    left = spark.range(0, 40_000).select(F.when(F.col("id") % 10 < 7, hot).otherwise(F.col("id")).alias("k"),
                                         F.col("id").alias("l"))
    sides = [spark.range(0, 40_000).select(F.col("id").alias("k"), (F.col("id") * i).alias(f"r{i}")) for i in (1, 2, 3)]
    for n in (1, 2, 3):
        out = salted_chain(left, "k", [Step(s, unique=True) for s in sides[:n]], spread_by=["l"])
        assert spread_of(out, f"r{n}") < 2
    text = out._jdf.queryExecution().executedPlan().toString()
    moves = [line for line in text.splitlines() if "Exchange hashpartitioning(k" in line and "_ls" in line]
    assert len(moves) == 4                    # the left rows once, each right side once


def story_of_one_fleet(spark):
    """The rows of one policy are most rows of every extract on the policy side."""
    from policylens.sources.adapter import materialize_sources, sources_for
    from policylens.session import scratch_path

    src = materialize_sources(spark, sources_for(spark, SF_SMALL), scratch_path(spark, "fleet"))
    first = src.policy.agg(F.min("proposalno")).first()[0]
    vehicles = src.vehicle.withColumn("proposalno", F.when(F.hash("licenseno") % 2 == 0, F.lit(first)).otherwise(
        F.col("proposalno")))
    no_number = F.when(F.hash("proposalno") % 2 == 0, F.lit(None)).otherwise(F.col("policyno"))
    return type(src)(**{**src.__dict__, "vehicle": vehicles}), type(src)(**{
        **src.__dict__, "policy": src.policy.withColumn("policyno", no_number)})


def test_a_fleet_and_policies_without_number_stay_spread(spark, no_broadcast, monkeypatch):
    from policylens.operators.period import Period
    from policylens.plans import policy
    from policylens.plans.extensions import ncd_coefficient

    fleet, numberless = story_of_one_fleet(spark)
    everything = Period.of("1900-01-01 00:00:00", "2100-01-01 00:00:00")
    # without the join on comcode, which deals the rows out by company where it is not a broadcast
    monkeypatch.setattr(policy, "left_join", lambda rows, right, key: rows.withColumns(
        {c: F.lit(None).cast("string") for c in right.columns if c != key}))
    wide = policy.policy_wide_table(fleet, everything)
    assert wide.groupBy("policyno").count().agg(F.max("count")).first()[0] > wide.count() / 4
    assert spread_of(wide, "rawpremium") < 2.5
    runs = ncd_coefficient(numberless, pieces=16)
    assert runs.count() == 1500 and spread_of(runs, "ncd_coefficient") < 2.5


def test_without_heavy_keys_nothing_is_written_for_row_ids(spark, monkeypatch):
    """Sides behind a shuffle are staged, and their keys counted one by one, only where a key is heavy."""
    from policylens.operators import joins

    staged, write = [], joins._written
    monkeypatch.setattr(joins, "_written", lambda df, name: staged.append(name) or write(df, name))
    left = spark.range(0, 5000).groupBy(F.col("id").alias("k")).agg(F.max("id").alias("l"))
    right = spark.range(0, 5000).groupBy(F.concat(F.lit(""), F.col("id")).cast("long").alias("k")).agg(F.max("id").alias("r"))
    out = salted_chain(left, "k", [Step(right)])
    assert "stable-rows" not in staged
    assert rows(out) == rows(left.join(right, ["k"], "left_outer"))
    hot = right.union(spark.range(0, 4000).groupBy("id").agg(F.max("id")).select(F.lit(7).cast("long"), "max(id)"))
    assert rows(salted_chain(left, "k", [Step(hot)])) == rows(left.join(hot, ["k"], "left_outer"))
    assert "stable-rows" in staged


def test_a_chain_of_many_rows_has_tasks_of_a_bounded_size(spark, monkeypatch):
    """More rows than shuffle partitions should sort go to more tasks; few rows do not."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        left = spark.range(0, 30_000).select(F.col("id").alias("k"), (F.col("id") % 7).alias("l"))
        right = spark.range(0, 30_000).select(F.col("id").alias("k"), (F.col("id") % 5).alias("r"))
        other = right.withColumnRenamed("r", "u")
        steps = [Step(right), Step(other, unique=True), Step(right.withColumnRenamed("r", "v"))]
        few = salted_chain(left, "k", steps)
        monkeypatch.setattr(joins, "TASK_ROWS", 4_000)       # 4 sides of 30,000 rows: 30 tasks
        many = salted_chain(left, "k", steps)
        assert largest_task(few) > 30_000 / 8 / 1.5
        assert largest_task(many) < 1.5 * 30_000 / 30
        assert rows(many) == rows(few)
        known = salted_chain(left, "k", [Step(other, unique=True, rows=290_000)])
        assert largest_task(known) < 1.5 * 30_000 / 80
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


@pytest.mark.parametrize("hot", [False, True])
def test_groups_are_dealt_to_as_many_tasks_as_their_rows_need(spark, monkeypatch, hot):
    key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 9_000) if hot else F.col("id") % 9_000
    df = spark.range(30_000).select(F.when(F.col("id") % 50 > 0, key).alias("k"), (F.col("id") % 2).alias("o"), F.col("id").alias("v"))
    aggs = [F.sum("v").alias("s"), F.count(F.lit(1)).alias("n")]
    before = joins.grouped_rows(df, "k", aggs, ["o"])
    monkeypatch.setattr(joins, "TASK_ROWS", 1_000)
    dealt = joins.grouped_rows(df, "k", aggs, ["o"])
    assert sorted(map(tuple, dealt.collect()), key=str) == sorted(map(tuple, before.collect()), key=str)
    groups = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert max(groups) < 18_000 / 30 * 1.5 and len(groups) >= 30        # 8 shuffle partitions


def test_details_and_heads_are_aggregated_in_as_many_tasks_as_their_rows_need(spark, monkeypatch):
    src = sources_for(spark, SF_SMALL)
    monkeypatch.setattr(joins, "TASK_ROWS", 200)
    for grouped in (details_by_application(src), head_with_multiplicity(src.head)):
        rows = grouped.count()
        largest = max(r["count"] for r in grouped.groupBy(F.spark_partition_id()).count().collect())
        assert largest < rows / 12                                          # 8 shuffle partitions


def moved_by(df, key):
    text = df._jdf.queryExecution().executedPlan().toString()
    return sum(f"Exchange hashpartitioning({key}#" in line for line in text.splitlines())


@pytest.fixture
def extracts(spark):
    from policylens.session import scratch_path
    from policylens.sources.adapter import materialize_sources

    return materialize_sources(spark, sources_for(spark, SF_SMALL), scratch_path(spark, "join-extracts"))


def with_one_application(src, name, share):
    """``src`` with one of ``share`` rows of an extract on the same application."""
    df = getattr(src, name)
    first = df.agg(F.min("applyno")).first()[0]
    hot = df.withColumn("applyno", F.when(F.xxhash64(*df.columns) % share == 0, F.lit(first)).otherwise(F.col("applyno")))
    return type(src)(**{**src.__dict__, name: hot})


def test_a_dealt_roll_up_moves_every_row_once(spark, no_broadcast, monkeypatch, extracts):
    """Copy main, heads and details by application, each once; a heavy key or null keys go the salted way."""
    from policylens.plans.endorsement import endorsement_rollup
    from policylens.queries import WINDOW

    nulls = type(extracts)(**{**extracts.__dict__, "copymain": extracts.copymain.withColumn(
        "applyno", F.when(F.hash("applyno") % 3 > 0, F.col("applyno")))})
    for src, moves in ((extracts, 3), (with_one_application(extracts, "fee", 3), None),
                       (with_one_application(extracts, "copymain", 3), None), (nulls, None)):
        with monkeypatch.context() as m:
            few = rows(endorsement_rollup(src, WINDOW))
            m.setattr(joins, "TASK_ROWS", 400)
            many = endorsement_rollup(src, WINDOW)
            assert rows(many) == few
            assert (moved_by(many, "applyno") == 3) == (moves == 3)


def test_snapshots_that_no_window_reaches_are_not_moved(spark, no_broadcast, extracts):
    from policylens.operators.period import Period
    from policylens.plans.endorsement import copy_with_head

    early = Period.of("1900-01-01 00:00:00", "1901-01-01 00:00:00")
    plan = copy_with_head(extracts, early)._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("LeftOuter"):]
    assert "1901-01-01" in below and copy_with_head(extracts, early).count() == 0


def test_items_and_fees_of_many_heads_are_moved_once(spark, no_broadcast, monkeypatch, extracts):
    """Heads, items, fees and snapshots by application, each once, though items are joined on the policy too."""
    from policylens.plans.plain import plain_wide_table

    other = type(extracts)(**{**extracts.__dict__, "itemkind2": extracts.itemkind2.withColumn(
        "policyno", F.when(F.hash("applyno") % 3 == 0, F.lit("P0")).otherwise(F.col("policyno")))})
    for src, once in ((extracts, True), (other, True), (with_one_application(extracts, "fee2", 3), False)):
        with monkeypatch.context() as m:
            few = rows(plain_wide_table(src))
            m.setattr(joins, "TASK_ROWS", 400)
            many = plain_wide_table(src)
            assert rows(many) == few
            text = many._jdf.queryExecution().executedPlan().toString()
            assert (text.count("shufflepartitionidpassthrough") == 4 and moved_by(many, "applyno") == 0) == once


def test_chains_of_a_plan_are_counted_in_one_job(spark, monkeypatch, extracts):
    from policylens.operators.joins import heavy_of_chain, heavy_of_chains
    from policylens.plans.plain import plain_wide_table

    staged, write = [], joins._written
    monkeypatch.setattr(joins, "_written", lambda df, name: staged.append(name) or write(df, name))
    plain_wide_table(extracts)
    assert staged.count("key-groups") == 1
    hot = with_one_application(extracts, "fee", 3)
    chains = [(extracts.copymain, "applyno", [Step(extracts.head), Step(s.fee)]) for s in (extracts, hot)]
    for one, alone in zip(heavy_of_chains(*chains), (heavy_of_chain(*c) for c in chains)):
        assert rows(one.table) == rows(alone.table) and one[1:] == alone[1:]
    assert [h.even for h in heavy_of_chains(*chains)] == [True, False]
