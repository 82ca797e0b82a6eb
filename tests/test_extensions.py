"""Claims ratio and no-claims discount: skew-safe prefix scan vs brute force."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from policylens.plans.extensions import claim_free_runs


def brute_force(rows):
    by_insured = {}
    for r in rows:
        by_insured.setdefault(r[1], []).append(r)
    out = {}
    for items in by_insured.values():
        items.sort(key=lambda r: (r[2] is not None, r[2], r[0]))
        last = 0
        for seq, r in enumerate(items, start=1):
            out[r[0]] = seq - last - 1
            if r[3]:
                last = seq
    return out


def test_hot_insured_spans_pieces(spark):
    rnd = random.Random(7)
    base = datetime(1997, 1, 1)
    rows = []
    for i in range(3000):
        insured = "HOT" if i % 3 != 0 else f"C{i % 40}"          # two thirds on one insured
        start = None if i % 401 == 0 else base + timedelta(days=rnd.randint(0, 900))
        rows.append((f"P{i:05d}", insured, start, rnd.random() < 0.15))
    df = spark.createDataFrame(rows, "policyno string, insuredcode string, startdate timestamp_ntz, claimed boolean")
    runs = claim_free_runs(df, pieces=6)
    assert runs.count() == len(rows)
    pieces = df.repartitionByRange(6, "insuredcode", "startdate", "policyno") \
        .where(F.col("insuredcode") == "HOT").select(F.spark_partition_id().alias("p")).distinct().count()
    assert pieces > 1, "the hot insured should be split over several pieces"
    got = {r["policyno"]: r["claim_free_run"] for r in runs.collect()}
    assert got == brute_force(rows)


def test_copies_of_one_policy_are_spread_and_exact(spark):
    base = datetime(1997, 1, 1)
    rows = [("P1", "A", base, False)] * 950 + [("P2", "A", base + timedelta(days=1), True)] * 230 \
        + [("P0", "A", base - timedelta(days=1), False), ("P3", "A", base + timedelta(days=2), False),
           ("Q1", "B", base, True), ("Q2", "B", base, False)]
    df = spark.createDataFrame(rows, "policyno string, insuredcode string, startdate timestamp_ntz, claimed boolean")
    got = sorted((r["policyno"], r["claim_free_run"]) for r in claim_free_runs(df, pieces=3, chunk=100).collect())
    expected = []
    by = {}
    for r in rows:
        by.setdefault(r[1], []).append(r)
    for items in by.values():
        items.sort(key=lambda r: (r[2], r[0]))
        last = 0
        for seq, r in enumerate(items, start=1):
            expected.append((r[0], seq - last - 1))
            if r[3]:
                last = seq
    assert got == sorted(expected)


def test_no_rows_lost_when_range_bounds_are_sampled(spark):
    """Large enough that range partitioning samples its bounds: the piece of a
    row must be the same in the local scan and in the per-piece summary."""
    from policylens.plans.extensions import ncd_coefficient
    from policylens.sources.adapter import sources_for
    src = sources_for(spark, "/root/testdata/sf0.1")
    assert src.policy.where(F.col("insuredcode").isNull()).count() > 0
    assert ncd_coefficient(src, pieces=16).count() == src.policy.count()


def _replace(src, **frames):
    return type(src)(**{**src.__dict__, **frames})


def test_paid_claims_are_counted_once_and_all(spark):
    """Two co-insurers double no claim; a claim counts though its policy is outside
    the filter; sums far beyond 10^13 hold."""
    from policylens.plans.extensions import claims_ratio
    from policylens.queries import WINDOW
    from policylens.sources.adapter import sources_for
    src = sources_for(spark, "/root/testdata/sf0.001")
    plain = {r["comcode"]: r.asDict() for r in claims_ratio(src, WINDOW).collect()}
    total = src.claims.where(WINDOW.contains(F.col("claimtime").substr(1, 19).try_cast("timestamp_ntz"))).count()
    assert total > 0
    doubled = _replace(src, policy_coins=src.policy_coins.unionByName(src.policy_coins))
    twice = {r["comcode"]: r.asDict() for r in claims_ratio(doubled, WINDOW).collect()}
    assert {c: r["claims_paid"] for c, r in twice.items()} == {c: r["claims_paid"] for c, r in plain.items()}
    outside = src.policy.limit(1).withColumn("policyno", F.lit("OUT")).withColumn("comcode", F.lit("ZZ"))
    for name in ("operatedate", "startdate", "enddate", "underwriteenddate"):
        outside = outside.withColumn(name, F.lit("1980-01-01 00:00:00"))
    claims = spark.createDataFrame([("OUT", "1997-05-05 00:00:00", 9e12)] * 50, "policyno string, claimtime string, paid double")
    more = _replace(src, policy=src.policy.unionByName(outside), claims=src.claims.unionByName(claims))
    got = {r["comcode"]: r.asDict() for r in claims_ratio(more, WINDOW).collect()}
    assert got["ZZ"]["claims_paid"] == 4.5e14 and got["ZZ"]["claims_ratio"] is None
