"""Indicators the original job only names: claims ratio and no-claims discount.

Both definitions are ours (the original has no code for them) and both need
a claims input: (policyno, claimtime text, paid).

* ``claims_ratio``: per company, paid claims dated in the window ÷ premium
  income (IND-16); null when the income is 0.  Claims are pre-aggregated per
  policy before the join, so a policy with a huge number of claims costs one
  row after the map-side partial aggregate.  All claims of the window count,
  whether or not their policy was written in it.
* ``ncd_coefficient``: per policy, the number of immediately preceding
  claim-free policies of the same insured (ordered by start date, then
  policyno) → grade = min(run, max grade) → coefficient from a table.  A policy
  without an insured keeps its row with a run of 0.  Claims are attached after
  copies of a policy are collapsed, by a join that spreads null and repeated policyno.  The run
  is a prefix scan per insured.  To keep one insured with a third of all
  policies from landing in one task, the scan is done in two levels: rows are
  range-partitioned on (insured, start, policyno), so a hot insured spans many
  partitions; each (insured, partition) piece is scanned locally; a small
  per-piece summary (at most one row per partition for any insured) carries
  the run across pieces.  Identical policy rows are collapsed with a
  multiplicity before the scan and re-expanded after it, so copies cannot
  pile up in one task either.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from policylens.functions.dates import typed_date
from policylens.functions.money import micros, sum_micros
from policylens.operators.indicators import policy_indicator_columns
from policylens.operators.joins import Step, salted_chain, salted_join
from policylens.operators.period import Period
from policylens.plans.policy import policies_with_shares
from policylens.session import ensure_checkpoint_dir
from policylens.sources.ingest import in_reach

MICROS_TOTAL = "decimal(38,0)"

# Fixed values (our definition): claim-free run → grade → coefficient.
NCD_COEFFICIENTS = {0: 1.0, 1: 0.9, 2: 0.8, 3: 0.7}


def claims_ratio(src, period: Period) -> DataFrame:
    """Per company: premium income of the window's policies, claims paid in the
    window on any of the company's policies, and their ratio.  Claims never
    meet the policies' co-insurance rows, so none is counted twice; claims on
    policies without a company or a record are in the null company's row."""
    claims = in_reach(src.claims, period)
    claims = claims.select("policyno", typed_date(claims, "claimtime").alias("claimtime"), "paid")
    paid = (claims.where(period.contains("claimtime"))
            .groupBy("policyno").agg(sum_micros(micros("paid")).alias("paid_micros")))
    company_of = src.policy.groupBy("policyno").agg(F.max("comcode").alias("comcode"))
    paid = salted_join(paid, company_of, "policyno", heavy="none").groupBy("comcode").agg(
        F.sum("paid_micros").alias("paid_micros"))
    income = policy_indicator_columns(period)["baofeishouru"]
    earned = policies_with_shares(src, period).groupBy("comcode").agg(sum_micros(micros(income)).alias("income_micros"))
    both = earned.select("comcode", F.col("income_micros").cast(MICROS_TOTAL).alias("income_micros"),
                         F.lit(0).cast(MICROS_TOTAL).alias("paid_micros")).unionByName(
        paid.select("comcode", F.lit(0).cast(MICROS_TOTAL).alias("income_micros"),
                    F.col("paid_micros").cast(MICROS_TOTAL).alias("paid_micros")))
    by_company = both.groupBy("comcode").agg(F.sum("income_micros").alias("i"), F.sum("paid_micros").alias("p"))
    income_d, paid_d = F.col("i").cast("double") / 1e6, F.col("p").cast("double") / 1e6
    return by_company.select(
        "comcode", income_d.alias("premium_income"), paid_d.alias("claims_paid"),
        F.when(income_d != 0, paid_d / income_d).alias("claims_ratio"))


# Copies of one policy row are expanded in pieces of this many rows.
COPY_CHUNK = 10_000


def claim_free_runs(policies: DataFrame, pieces: int, chunk: int = COPY_CHUNK) -> DataFrame:
    """Add ``claim_free_run`` to rows (policyno, insuredcode, startdate, claimed).

    Identical rows are first collapsed into one row with a multiplicity, so
    no group of copies reaches one task.  Two-level prefix scan over the
    collapsed rows, with positions weighted by the multiplicity: range
    partitions → local scan per (insured, piece) → carry across pieces from a
    bounded per-piece summary.  Then every copy gets its own row again:
    the first copy has the scanned run; a later copy follows its twin, so its
    run is 0 after a claimed twin and grows by one per copy otherwise."""
    return _collapsed_runs(policies.groupBy(*policies.columns).agg(F.count(F.lit(1)).alias("copies")), pieces, chunk)


def _collapsed_runs(collapsed: DataFrame, pieces: int, chunk: int = COPY_CHUNK) -> DataFrame:
    """``claim_free_runs`` of rows that carry their number of ``copies``."""
    order = ["startdate", "policyno"]
    cols = [c for c in collapsed.columns if c != "copies"]
    # The piece of a row comes from sampled range bounds; it is materialised
    # once (reliable checkpoint in the shared folder) so the local scan and the
    # per-piece summary below see the same assignment.
    ensure_checkpoint_dir(collapsed.sparkSession)
    ranged = (collapsed.repartitionByRange(pieces, "insuredcode", *order, "claimed")
              .withColumn("piece", F.spark_partition_id())
              .checkpoint(eager=True))
    w = Window.partitionBy("insuredcode", "piece").orderBy(*order, "claimed")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    # pos = position of this row's last copy within the piece
    local = (ranged.withColumn("pos", F.sum("copies").over(w.rowsBetween(Window.unboundedPreceding, 0)))
             .withColumn("last_claim_pos", F.max(F.when(F.col("claimed"), F.col("pos"))).over(before)))

    summary = local.groupBy("insuredcode", "piece").agg(
        F.sum("copies").alias("cnt"),
        F.max(F.when(F.col("claimed"), F.col("pos"))).alias("last_claim"))
    ws = Window.partitionBy("insuredcode").orderBy("piece")
    prev = ws.rowsBetween(Window.unboundedPreceding, -1)
    has_claim = F.col("last_claim").isNotNull()
    summary = (summary
               .withColumn("trail", F.col("cnt") - F.coalesce(F.col("last_claim"), F.lit(0)))
               .withColumn("cum", F.sum("cnt").over(ws.rowsBetween(Window.unboundedPreceding, 0))))
    summary = summary.select(
        "insuredcode", "piece",
        F.coalesce(F.sum("cnt").over(prev), F.lit(0)).alias("cum_before"),
        F.last(F.when(has_claim, F.col("trail")), ignorenulls=True).over(prev).alias("claim_trail"),
        F.last(F.when(has_claim, F.col("cum")), ignorenulls=True).over(prev).alias("claim_cum"))
    carry = F.when(F.col("claim_trail").isNull(), F.col("cum_before")).otherwise(
        F.col("claim_trail") + F.col("cum_before") - F.col("claim_cum"))
    summary = summary.select("insuredcode", "piece", carry.alias("carry"))

    joined = local.join(summary, ["insuredcode", "piece"], "inner")
    first_pos = F.col("pos") - F.col("copies") + 1
    first_run = F.when(F.col("last_claim_pos").isNotNull(), first_pos - F.col("last_claim_pos") - 1).otherwise(
        F.col("carry") + first_pos - 1)
    runs = joined.select(*cols, "copies", first_run.alias("first_run"))
    return _expand_copies(runs, cols, chunk)


def _expand_copies(runs: DataFrame, cols: list[str], chunk: int) -> DataFrame:
    """One output row per copy.  Every row is cut into pieces of ``chunk`` copies
    (almost all are one piece), the pieces are spread, and then expanded."""
    pieces = runs.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("copies") - 1) / chunk))))
    lo = F.col("chunk") * chunk
    hi = F.least(lo + chunk, F.col("copies")) - 1
    # by the whole row: many policies may have no number, or the same
    out = pieces.repartition(*cols, "chunk").select(
        *cols, "first_run", F.explode(F.sequence(lo, hi)).alias("copy"))
    run = (F.when(F.col("copy") == 0, F.col("first_run"))
           .when(F.col("claimed"), F.lit(0))
           .otherwise(F.col("first_run") + F.col("copy")))
    return out.select(*cols, run.cast("int").alias("claim_free_run"))


def ncd_coefficient(src, coefficients: dict[int, float] | None = None, pieces: int | None = None) -> DataFrame:
    coefficients = coefficients or NCD_COEFFICIENTS
    max_grade = max(coefficients)
    claimed = src.claims.groupBy("policyno").agg((F.count_if(F.col("paid") > 0) > 0).alias("claimed"))
    policies = src.policy.select("policyno", "insuredcode", typed_date(src.policy, "startdate").alias("startdate"))
    # copies of a policy are one row when its claims are joined, and the rows are
    # distinct, so that those of a hot policyno can be told apart
    rows = policies.groupBy(*policies.columns).agg(F.count(F.lit(1)).alias("copies"))
    rows = salted_chain(rows, "policyno", [Step(claimed, unique=True)], spread_by=["insuredcode", "startdate"],
                        salt_by=["insuredcode", "startdate"], count_left=src.policy).na.fill({"claimed": False})
    spark = policies.sparkSession
    pieces = pieces or int(spark.conf.get("spark.sql.shuffle.partitions"))
    known = F.col("insuredcode").isNotNull()
    # nobody is known to have had a policy before: a run of 0
    unknown = _expand_copies(rows.where(~known).withColumn("first_run", F.lit(0)), policies.columns + ["claimed"],
                             COPY_CHUNK).withColumn("claim_free_run", F.lit(0))
    runs = _collapsed_runs(rows.where(known), pieces).unionByName(unknown)
    grade = F.least(F.col("claim_free_run"), F.lit(max_grade))
    coef = F.lit(None).cast("double")
    for g in sorted(coefficients, reverse=True):
        coef = F.when(grade == g, F.lit(float(coefficients[g]))).otherwise(coef)
    return runs.select("policyno", "insuredcode", "claim_free_run", grade.alias("ncd_grade"),
                       coef.alias("ncd_coefficient"))
