"""The trial figures documented in FIXTURES.md §3 (sf0.01, window 1997-01-01 … 1999-01-01)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from policylens.plans import endorsement, policy
from policylens.queries import WINDOW
from policylens.sources.adapter import sources_for
from tests.conftest import SF_ORACLE


@pytest.fixture(scope="module")
def src(spark):
    return sources_for(spark, SF_ORACLE)


def nonzero(df, cols):
    return {c: df.where(F.col(c) != 0).count() for c in cols}


def test_endorsement_side_trial(src):
    rows = endorsement.endorsement_indicator_rows(src, WINDOW).cache()
    assert rows.count() == 29_685
    assert rows.select("policyno").distinct().count() == 7_319
    assert nonzero(rows, ["rawpremium", "increasecount", "decreasecount", "increaseamount", "tuibaocount",
                          "policycancelcount", "decreasenotcancelcount"]) == {
        "rawpremium": 2_211, "increasecount": 3_973, "decreasecount": 3_894, "increaseamount": 3_107,
        "tuibaocount": 795, "policycancelcount": 475, "decreasenotcancelcount": 754}
    total = endorsement.endorsement_rollup(src, WINDOW).agg(F.sum("increasepremium")).first()[0]
    assert round(total, 6) == 5_497_671.754894


def test_policy_side_trial(src):
    p = policy.policy_indicators(src, WINDOW).cache()
    assert p.count() == 6_720
    assert nonzero(p, ["qiandanbaofei", "baofeishouru", "zhongbaoshuliang", "cancelflag", "stopflag",
                       "Tuancheflag"]) == {
        "qiandanbaofei": 1_566, "baofeishouru": 1_565, "zhongbaoshuliang": 1_880, "cancelflag": 1_317,
        "stopflag": 658, "Tuancheflag": 1_704}
    assert (p.where(F.col("continueflag") == 1).count(), p.where(F.col("continueflag") == 2).count()) == (1_685, 1_643)
    sums = p.agg(*[F.sum(F.col(c).cast("decimal(20,6)")) for c in ("qiandanbaofei", "baofeishouru", "baoxianjine")])
    assert tuple(sums.first()) == (Decimal("311974727.027824"), Decimal("312951111.508924"),
                                   Decimal("3129511115.089250"))
