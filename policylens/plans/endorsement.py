"""Endorsement roll-up (PIPE-1): one row of 14 indicators per policy.

Row-level definition (``endorsement_rows``): copy main ⟕ head on applyno,
keep rows passing the window filter, ⟕ fee ⟕ item kind ⟕ co-insurance on
applyno, fill missing values, evaluate the indicators per joined row, then
sum (max for the two marks) per policyno.  Duplicate right-side keys
multiply rows, and that multiplication is part of the result.

Scaled plan (``endorsement_rollup``) computes the same numbers without
materialising the fan-out:

* fee, item kind and co-insurance rows are aggregated per applyno together
  (partial aggregation before the one shuffle collapses a hot application to
  one row per map task), keeping counts and exact decimal sums by sign;
* exact copies of head rows are collapsed with a multiplicity;
* copy main, heads and these details are one chain of joins on applyno: the
  copy-main rows of a null or heavy applyno are spread once and stay so, and
  each joined row carries its multiplicities, so every indicator is a product
  of a gate, a decimal sum and integer counts (exact, by distributivity);
* the final ``groupBy(policyno)`` is a partial + final hash aggregate.

Exact decimals make the result independent of the order of addition; it
equals the row-level definition summed exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policylens.functions.dates import typed_date
from policylens.functions.money import (
    COUNT, MONEY_SUM, PART, PERCENT, WHOLE, from_micros, micros, money, shared_parts, sum_micros, sum_of_parts,
    whole_and_part,
)
from policylens.operators.indicators import (
    COUNT_INDICATORS, ENDORSEMENT_INDICATORS, MAX_INDICATORS, EndorsementGates, endorsement_indicator_columns,
)
from policylens.operators.joins import Heavy, Step, grouped_rows, heavy_of_chain, salted_chain
from policylens.operators.period import Period, endorsement_row_filter, snapshot_row_filter
from policylens.operators.records import copycoins_record, copymain_record, head_record
from policylens.sources.ingest import in_reach

HEAD_SOURCE_COLUMNS = ["applyno", "underwriteflag", "validdate", "endortype", "underwriteenddate"]
MISSING_ENDORSEMENT_SHARE = 1.0
ENDORSEMENT_FILL = {
    "coinsrate": MISSING_ENDORSEMENT_SHARE, "tuibaoflag": 0, "policycancelflag": 0, "decreaseNotcancelflag": 0,
    "chgpremium": 0.0, "underwriteflag": 0, "chgamount": 0.0,
}


def _head_step(src, where: Column, head: DataFrame | None = None) -> Step:
    """⟕ head on applyno (JN-1), then a filter.  Heavy keys are counted on the raw
    head extract (no dedupe pass needed)."""
    head = head_record(src.head) if head is None else head
    return Step(head, count_on=src.head, where=where, salt_by=["_head"] if "_head" in head.columns else None)


def _copies(src, period: Period) -> DataFrame:
    """Copy main without what starts after the window, as far as the layout shows: no
    window test holds for it."""
    return in_reach(src.copymain, period, since_start=False)


def _snapshots(src, period: Period) -> DataFrame:
    """Typed copy-main rows for which a window test can hold, before they are moved."""
    return copymain_record(_copies(src, period)).where(snapshot_row_filter(period))


def copy_with_head(src, period: Period, where: Column | None = None) -> DataFrame:
    """copy main ⟕ head on applyno (JN-1), filtered to the reporting window (FIL-1)
    or by ``where``."""
    if where is None:
        left, copies, where = _snapshots(src, period), _copies(src, period), endorsement_row_filter(period)
    else:
        left, copies = copymain_record(src.copymain), src.copymain
    return salted_chain(left, "applyno", [_head_step(src, where)], spread_by=["policyno"], count_left=copies)


def endorsement_rows(src, period: Period, missing_share: float = MISSING_ENDORSEMENT_SHARE) -> DataFrame:
    """Joined and filled endorsement rows (JN-1..4, FIL-1, PRJ-11), one per fan-out row."""
    fee = src.fee.select("applyno", "chgpremium", "chgamount", "currency")
    item = src.itemkind.select("applyno", "calculateflag")  # its currency duplicates the fee's
    coins = copycoins_record(src.copycoins)
    rows = salted_chain(_snapshots(src, period), "applyno",
                        [_head_step(src, endorsement_row_filter(period)), Step(fee), Step(item), Step(coins)], spread_by=["policyno"],
                        count_left=_copies(src, period))
    return rows.na.fill({**ENDORSEMENT_FILL, "coinsrate": missing_share})


def endorsement_indicator_rows(src, period: Period, missing_share: float = MISSING_ENDORSEMENT_SHARE) -> DataFrame:
    """IND-1..14 per joined row (row-level definition)."""
    cols = endorsement_indicator_columns(period)
    return endorsement_rows(src, period, missing_share).select("applyno", "policyno", *[v.alias(k) for k, v in cols.items()])


def rollup_rows(rows: DataFrame) -> DataFrame:
    """AGG-1 on indicator rows: sum, or max for the two marks."""
    aggs = [
        (F.max(c) if c in MAX_INDICATORS else F.sum(c)).alias(c) for c in ENDORSEMENT_INDICATORS
    ]
    return rows.groupBy("policyno").agg(*aggs)


# --- scaled plan -------------------------------------------------------------------------------

def _detail_rows(src, missing_share: float = MISSING_ENDORSEMENT_SHARE) -> DataFrame:
    """The fee, item and co-insurance rows of all applications beside each other."""
    percent = F.coalesce(F.col("coinsrate"), F.lit(100.0 * missing_share)).cast(PERCENT)
    fee = src.fee.select("applyno", F.lit("fee").alias("_of"),
                         *[micros(c).alias(f"_{c}") for c in ("chgpremium", "chgamount")])
    item = src.itemkind.select("applyno", F.lit("item").alias("_of"), (F.col("calculateflag") == "Y").alias("_counts"))
    coins = src.copycoins.select("applyno", F.lit("coins").alias("_of"), percent.alias("_percent"))
    return fee.unionByName(item, allowMissingColumns=True).unionByName(coins, allowMissingColumns=True)


def details_by_application(src, missing_share: float = MISSING_ENDORSEMENT_SHARE, heavy: Heavy | None = None) -> DataFrame:
    """One row per applyno from its fee, item and co-insurance rows: counts,
    counts and exact sums of fees by sign, items whose amount counts
    (calculateflag "Y"), and the exact sum of shares in percent (missing share
    → 100).  The three extracts go through one aggregate, one shuffle, in as many
    tasks as their rows need; what an application has no rows of is null."""
    p, a = F.col("_chgpremium"), F.col("_chgamount")

    def rows_of(kind: str) -> Column:
        return F.nullif(F.count_if(F.col("_of") == kind), F.lit(0))

    return grouped_rows(_detail_rows(src, missing_share), "applyno", [
        rows_of("fee").alias("n_fee"), F.count_if(p > 0).alias("n_prem_pos"), F.count_if(p < 0).alias("n_prem_neg"),
        sum_micros(F.when(p > 0, p)).alias("s_prem_pos"), sum_micros(F.when(p < 0, p)).alias("s_prem_neg"),
        sum_micros(p).alias("s_prem"),
        sum_micros(F.when(a > 0, a)).alias("s_amt_pos"), sum_micros(F.when(a < 0, a)).alias("s_amt_neg"),
        sum_micros(a).alias("s_amt"),
        rows_of("item").alias("n_item"), F.count_if("_counts").alias("n_item_y"),
        rows_of("coins").alias("n_coins"), F.sum("_percent").alias("s_percent")], heavy=heavy)


def head_with_multiplicity(head: DataFrame, heavy: Heavy | None = None) -> DataFrame:
    """Copies of a head row, with its dates parsed, collapse to one typed row with
    ``n_head``, and ``_head`` to tell it from the others."""
    dated = head.withColumns({c: typed_date(head, c) for c in ("validdate", "underwriteenddate")})
    grouped = grouped_rows(dated, HEAD_SOURCE_COLUMNS[0], [F.count(F.lit(1)).alias("n_head")], HEAD_SOURCE_COLUMNS[1:],
                           heavy)
    return head_record(grouped.withColumn("_head", F.xxhash64(*HEAD_SOURCE_COLUMNS)), "n_head", "_head")


def _dec_times(s: Column, count: Column) -> Column:
    """Exact sum × multiplicity (a ``COUNT``), as a 6-decimal amount."""
    return (F.coalesce(s, F.lit(0).cast(MONEY_SUM)) * count).cast(MONEY_SUM)


def chain_of_rollup(src, period: Period) -> tuple[DataFrame, str, list[Step]]:
    """The sides of the roll-up's chain whose keys are counted, for ``heavy_of_chain``."""
    rows = _detail_rows(src)
    return _copies(src, period), "applyno", [Step(src.head), Step(rows, unique=True, count_on=rows)]


def endorsement_rollup(src, period: Period, missing_share: float = MISSING_ENDORSEMENT_SHARE,
                       heavy: Heavy | None = None) -> DataFrame:
    """PIPE-1: one row per policyno with the 14 indicators (scaled plan).
    ``missing_share`` is the own share used when an application has no
    co-insurance row or a null share (1.0: the whole amount).  ``heavy``: what
    was found in ``chain_of_rollup``."""
    heavy = heavy_of_chain(*chain_of_rollup(src, period)) if heavy is None else heavy
    rows = salted_chain(_snapshots(src, period), "applyno",
                        [_head_step(src, endorsement_row_filter(period), head_with_multiplicity(src.head, heavy)),
                         Step(details_by_application(src, missing_share, heavy), unique=True, count_on=_detail_rows(src))],
                        spread_by=["policyno"], heavy=heavy)

    c = F.col

    def count(name: str, missing: int = 1) -> Column:
        return F.coalesce(c(name), F.lit(missing)).cast(COUNT)

    h, n_fee, n_item, n_y, n_coins = (count("n_head"), count("n_fee"), count("n_item"), count("n_item_y", 0),
                                      count("n_coins"))
    # Σ over co-insurance rows of the own share in percent: the shares when
    # co-insured, else 100 per row; a missing row counts as the missing share.
    missing = F.lit(100.0 * missing_share).cast(PERCENT).cast("decimal(30,8)")
    percents = F.when(c("coinsflag") == 1, F.coalesce(c("s_percent"), missing)).otherwise(
        (n_coins * 100).cast("decimal(30,8)"))
    # Missing head marks count as 0 (fill after the filter).
    rows = rows.na.fill({"underwriteflag": 0, "tuibaoflag": 0, "policycancelflag": 0, "decreaseNotcancelflag": 0})
    g = EndorsementGates(period)
    whole, part = whole_and_part(percents)
    # each gate, count and share once per row; the indicators only refer to them
    rows = rows.withColumns({
        "_h": h, "_n_fee": n_fee, "_n_item": n_item, "_n_y": n_y, "_n_coins": n_coins, "_whole": whole, "_part": part,
        "_original": g.original_kept & g.in_policy_window, "_increase": g.increase, "_surrender": g.surrender,
        "_cancel": g.cancel, "_other": g.other_reduction})
    h, n_fee, n_item, n_y, n_coins = (c(x) for x in ("_h", "_n_fee", "_n_item", "_n_y", "_n_coins"))

    def money_if(cond: Column, s: Column, mult: Column) -> tuple[Column, Column]:
        whole, part = shared_parts(_dec_times(s, mult), c("_whole"), c("_part"))
        return (F.when(cond, whole).otherwise(F.lit(0).cast(WHOLE)), F.when(cond, part).otherwise(F.lit(0).cast(PART)))

    def fee_sum(name: str) -> Column:
        return from_micros(F.coalesce(c(name), F.lit(0)))

    def count_if(cond: Column, mult: Column) -> Column:
        return F.when(cond, mult).otherwise(F.lit(0)).cast("decimal(38,0)")

    every_row = h * n_fee * n_item * n_coins
    per_fee = h * n_item * n_coins
    values = {
        "rawpremium": money_if(c("_original"), money("sumpremium"), h * n_fee * n_item),
        "increasecount": count_if(c("_increase"), count("n_prem_pos", 0) * per_fee),
        "decreasecount": count_if(c("_increase"), count("n_prem_neg", 0) * per_fee),
        "increasepremium": money_if(c("_increase"), fee_sum("s_prem_pos"), h * n_item),
        "decreasepremium": money_if(c("_increase"), fee_sum("s_prem_neg"), h * n_item),
        "increaseamount": money_if(c("_increase"), fee_sum("s_amt_pos"), h * n_y),
        "decreaseamount": money_if(c("_increase"), fee_sum("s_amt_neg"), h * n_y),
        "tuibaocount": count_if(c("_surrender"), every_row),
        "tuibaoamount": money_if(c("_surrender"), fee_sum("s_amt"), h * n_y),
        "tuibaopremium": money_if(c("_surrender"), fee_sum("s_prem"), h * n_item),
        "policycancelcount": F.when(c("_cancel"), 1).otherwise(0),
        "policycancelamount": money_if(c("_cancel"), fee_sum("s_amt"), h * n_y),
        "policycancelpremium": money_if(c("_cancel"), fee_sum("s_prem"), h * n_item),
        "decreasenotcancelcount": F.when(c("_other"), 1).otherwise(0),
    }
    # A row without fee rows has one filled fee row of 0; counts by sign are 0 then.
    columns = []
    for name, v in values.items():
        parts = [(f"{name}_whole", v[0]), (f"{name}_part", v[1])] if isinstance(v, tuple) else [(name, v)]
        columns += [x.alias(n) for n, x in parts]
    per_row = rows.select("policyno", *columns)

    aggs = []
    for name in ENDORSEMENT_INDICATORS:
        if name in MAX_INDICATORS:
            aggs.append(F.max(name).alias(name))
        elif name in COUNT_INDICATORS:
            aggs.append(F.sum(name).cast("long").alias(name))
        else:
            aggs.append(sum_of_parts(f"{name}_whole", f"{name}_part").alias(name))
    return per_row.groupBy("policyno").agg(*aggs)
