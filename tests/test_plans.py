"""Plan-shape checks: properties that matter at scale, read from explain()."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from policylens.plans import endorsement, extensions, plain, policy
from policylens.queries import WINDOW
from policylens.session import scratch_path
from policylens.sources.adapter import materialize_sources, sources_for
from tests.conftest import SF_SMALL

def plan_text(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.fixture(scope="module")
def extracts(spark):
    return materialize_sources(spark, sources_for(spark, SF_SMALL), scratch_path(spark, "plan-extracts"))


@pytest.fixture
def no_broadcast(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    old = {k: spark.conf.get(k, None) for k in keys}
    for k in keys:
        spark.conf.set(k, "-1")
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def exchanges(text: str) -> int:
    return len(re.findall(r"^\(\d+\) Exchange", text, flags=re.M))


def scans(text: str) -> int:
    return len(re.findall(r"^\(\d+\) Scan parquet", text, flags=re.M))


def with_hot_keys(spark, src):
    """The extracts with a third of the fees, heads, items and shares on one key each."""
    frames = {}
    for name, key in (("fee", "applyno"), ("head", "applyno"), ("itemkind", "applyno"), ("copycoins", "applyno"),
                      ("policy_coins", "proposalno"), ("vehicle", "proposalno"), ("profit2", "proposalno"),
                      ("head2", "policyno"), ("fee2", "applyno"), ("pmain2", "applyno"), ("itemkind2", "applyno")):
        df = getattr(src, name)
        hot = df.withColumn(key, F.when(F.xxhash64(*df.columns) % 3 == 0, F.lit("HOT")).otherwise(F.col(key)))
        path = scratch_path(spark, f"hot-{name}")
        hot.write.parquet(path)
        frames[name] = spark.read.schema(df.schema).parquet(path)
    return type(src)(**{**src.__dict__, **frames})


def test_plans_do_not_grow_with_hot_keys(spark, extracts, no_broadcast):
    """Exchanges: one per aggregate, per right side of a join, and per chain of
    joins on one key; heavy keys were counted and written before."""
    hot = with_hot_keys(spark, extracts)
    for job, most, most_scans in ((lambda s: endorsement.endorsement_rollup(s, WINDOW), 6, 8),
                                  (lambda s: policy.policy_wide_table(s, WINDOW), 13, 17),
                                  (plain.plain_wide_table, 10, 17)):
        plain_text, hot_text = plan_text(job(extracts)), plan_text(job(hot))
        assert (exchanges(plain_text), scans(plain_text)) == (exchanges(hot_text), scans(hot_text))
        assert exchanges(plain_text) <= most and scans(plain_text) <= most_scans, (
            exchanges(plain_text), scans(plain_text))


def test_scans_read_only_needed_columns(spark, extracts):
    text = plan_text(policy.premium_income_by_company(extracts, WINDOW))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    policy_scan = [set(re.findall(r"(\w+):", s)) for s in schemas if "operatedate" in s]
    assert policy_scan
    for cols in policy_scan:
        assert not cols & {"riskcode", "sumamount", "inputflag", "businessnature", "agentcode", "contractno",
                           "insuredcode"}, cols
