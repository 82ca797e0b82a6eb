"""Business indicators as column builders.

Endorsement side (IND-1..14) works on a joined row of copy main ⟕ head ⟕ fee
⟕ item kind ⟕ co-insurance; policy side (IND-15..19) on a policy row after
its co-insurance join.  Every builder is ``when(condition, value).otherwise(0)``
over null-free gates, so no row can fail.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from policylens.functions.dates import year_month_of_window
from policylens.functions.money import co_insured
from policylens.operators.period import Period

ENDORSEMENT_INDICATORS = [
    "rawpremium", "increasecount", "decreasecount", "increasepremium", "decreasepremium",
    "increaseamount", "decreaseamount", "tuibaocount", "tuibaoamount", "tuibaopremium",
    "policycancelcount", "policycancelamount", "policycancelpremium", "decreasenotcancelcount",
]
COUNT_INDICATORS = {"increasecount", "decreasecount", "tuibaocount", "policycancelcount", "decreasenotcancelcount"}
# Roll-up: these two are "did it ever happen" marks (max); all others are summed.
MAX_INDICATORS = ("policycancelcount", "decreasenotcancelcount")
POLICY_INDICATORS = ["qiandanbaofei", "baofeishouru", "baoxianjine", "zhongbaoshuliang", "timeYearMonth"]


class EndorsementGates:
    """The shared boolean gates of one joined endorsement row."""

    def __init__(self, period: Period):
        c = F.col
        self.in_policy_window = period.contains("policyValiddate")
        self.in_endorse_window = period.endorsement_in("maxValiddateAndWritedate", "startdate")
        self.in_surrender_window = period.surrender_in(
            "maxValiddateAndWritedate", "validdate", "prppunderwriteenddate", "startdate")
        self.approved_charged = (c("underwriteflag") == 1) & (c("chargeflag") == 1)
        self.original_kept = (
            (c("endorsetimes") == 0) & (c("policyunderwriteflag") == 1) & (c("chargeflag") == 1)
            & (c("cancelflag") == 1)
        )
        self.calculated = F.coalesce(c("calculateflag") == "Y", F.lit(False))
        self.increase = self.approved_charged & self.in_endorse_window
        self.surrender = self.approved_charged & (c("tuibaoflag") == 1) & self.in_surrender_window
        self.cancel = self.approved_charged & (c("policycancelflag") == 1) & self.in_surrender_window
        self.other_reduction = self.approved_charged & (c("decreaseNotcancelflag") == 1) & self.in_surrender_window


def _own(x: str) -> Column:
    return co_insured(F.coalesce(F.col(x), F.lit(0.0)), "coinsflag", "coinsrate")


def endorsement_indicator_columns(period: Period) -> dict[str, Column]:
    """IND-1..14 per joined row (the row-level definition)."""
    g = EndorsementGates(period)
    prem, amt = F.col("chgpremium"), F.col("chgamount")
    zero = F.lit(0.0)

    def when(cond: Column, value: Column, default: Column = zero) -> Column:
        return F.when(F.coalesce(cond, F.lit(False)), value).otherwise(default)

    one, none = F.lit(1), F.lit(0)
    return {
        "rawpremium": when(g.original_kept & g.in_policy_window, _own("sumpremium")),
        "increasecount": when((prem > 0) & g.increase, one, none),
        "decreasecount": when((prem < 0) & g.increase, one, none),
        "increasepremium": when((prem > 0) & g.increase, _own("chgpremium")),
        "decreasepremium": when((prem < 0) & g.increase, _own("chgpremium")),
        "increaseamount": when(g.calculated & (amt > 0) & g.increase, _own("chgamount")),
        "decreaseamount": when(g.calculated & (amt < 0) & g.increase, _own("chgamount")),
        "tuibaocount": when(g.surrender, one, none),
        "tuibaoamount": when(g.calculated & g.surrender, _own("chgamount")),
        "tuibaopremium": when(g.surrender, _own("chgpremium")),
        "policycancelcount": when(g.cancel, one, none),
        "policycancelamount": when(g.calculated & g.cancel, _own("chgamount")),
        "policycancelpremium": when(g.cancel, _own("chgpremium")),
        "decreasenotcancelcount": when(g.other_reduction, one, none),
    }


def policy_indicator_columns(period: Period) -> dict[str, Column]:
    """IND-15..19 on a policy row that carries ``coinsrate``."""
    c = F.col
    approved = (c("underwriteflag") == 1) & (c("chargeflag") == 1) & (c("cancelflag") == 0)
    written = approved & period.contains("maxOperatedateUnderwritedate")
    started = approved & period.contains("maxStartdateUnderwritedate")
    expiring = period.contains("enddate") & (c("underwriteflag") == 1) & (c("cancelflag") == 0)
    own_premium = co_insured(F.coalesce(c("sumpremium"), F.lit(0.0)), "coinsflag", "coinsrate")
    own_amount = co_insured(F.coalesce(c("sumamount"), F.lit(0.0)), "coinsflag", "coinsrate")
    return {
        "qiandanbaofei": F.when(written, own_premium).otherwise(0.0),
        "baofeishouru": F.when(started, own_premium).otherwise(0.0),
        "baoxianjine": F.when(started, own_amount).otherwise(0.0),
        "zhongbaoshuliang": F.when(expiring, 1).otherwise(0),
        "timeYearMonth": year_month_of_window("policyno", period.start),
    }
