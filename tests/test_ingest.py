"""Typed extracts laid out by time: the same rows, read by window."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from policylens import schemas
from policylens.job import main
from policylens.operators.period import Period
from policylens.plans import endorsement, extensions, policy
from policylens.queries import PRIOR_WINDOW, WINDOW
from policylens.session import scratch_path
from policylens.sources import files
from policylens.sources.adapter import EXTRACT_SCHEMA_NAMES, materialize_sources, sources_for
from policylens.sources.ingest import BY_TIME, DATES, MONTH, in_reach, ingested, typed
from tests.conftest import SF_SMALL
from tests.test_plans import plan_text

ODD_DATES = ["1997/02/03 04:05:06", "  1997-02-03 ", "1997", "1997-02-30 00:00:00", "", None, "9999-12-31 23:59:59",
             "0001-01-01 00:00:00", "1998-01-01 00:00:00.123456789"]


def bag(df):
    return Counter(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def pair(spark):
    """Text extracts with odd text in the dates of some rows, and the same ingested."""
    src = materialize_sources(spark, sources_for(spark, SF_SMALL), scratch_path(spark, "text"))
    frames, values = dict(src.__dict__), F.array(*[F.lit(x) for x in ODD_DATES])
    for name, dates in DATES.items():
        df = frames[name]
        for i, c in enumerate(dates):
            pick = F.pmod(F.xxhash64(df.columns[0], F.lit(i)), F.lit(3 * len(ODD_DATES))).cast("int")
            df = df.withColumn(c, F.when(pick < len(ODD_DATES), F.get(values, pick)).otherwise(F.col(c)))
        path = scratch_path(spark, f"odd-{name}")
        df.write.parquet(path)
        frames[name] = spark.read.schema(df.schema).parquet(path)
    src = type(src)(**frames)
    return src, ingested(src)


@pytest.mark.parametrize("window", [WINDOW, PRIOR_WINDOW, Period.of("1997-02-03 00:00:00", "1997-02-04 00:00:00"),
                                    Period.of("2020-01-01 00:00:00", "2021-01-01 00:00:00")])
def test_same_rows_as_from_text(pair, window):
    text, kept = pair
    assert bag(policy.filtered_policies(kept, window)) == bag(policy.filtered_policies(text, window))
    assert bag(endorsement.copy_with_head(kept, window)) == bag(endorsement.copy_with_head(text, window))


def test_same_results_as_from_text(pair):
    text, kept = pair
    for job in (lambda s: endorsement.endorsement_rollup(s, WINDOW), lambda s: policy.policy_wide_table(s, WINDOW),
                lambda s: extensions.claims_ratio(s, WINDOW), extensions.ncd_coefficient):
        assert bag(job(kept)) == bag(job(text))


def test_rows_without_a_date_are_kept(pair):
    text, kept = pair
    for name in EXTRACT_SCHEMA_NAMES:
        assert getattr(kept, name).count() == getattr(text, name).count(), name
    assert kept.claims.where(F.col(MONTH).isNull()).count() > 0


def test_window_reaches_the_scan(pair):
    _, kept = pair
    narrow = Period.of("1997-03-01 00:00:00", "1997-04-01 00:00:00")
    plan = plan_text(policy.filtered_policies(kept, narrow))
    assert re.search(r"PartitionFilters: \[[^\]]*last_month#\d+ >= 199703", plan), plan
    assert re.search(r"PushedFilters: \[[^\]]*LessThanOrEqual\(first_date,1997-04-01\)", plan), plan
    # without the rows' own dates: only the folders that the window can touch
    read = in_reach(kept.claims, narrow).select(F.input_file_name().alias("f")).distinct().count()
    assert 0 < read < kept.claims.select(F.input_file_name().alias("f")).distinct().count()
    assert kept.claims.where((F.col(MONTH) < 199703) & F.col(MONTH).isNotNull()).count() > 0
    assert in_reach(kept.claims, narrow).where(F.col(MONTH) < 199703).count() == 0


def test_text_extracts_stay_whole(pair):
    text, _ = pair
    assert in_reach(text.policy, WINDOW) is text.policy


def test_hot_month_is_written_by_many_tasks(spark):
    """All rows in one month: pieces of the advisory size, not one file."""
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", None)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        src = sources_for(spark, SF_SMALL)
        claims = spark.range(0, 60_000, numPartitions=8).select(
            F.sha2(F.col("id").cast("string"), 256).alias("policyno"), F.lit("1997-05-06 00:00:00").alias("claimtime"),
            F.rand(1).alias("paid"))
        only = type(src)(**{k: claims if k == "claims" else None for k in src.__dict__})
        kept = ingested(only).claims
        assert kept.count() == 60_000
        per_file = [r["count"] for r in kept.groupBy(F.input_file_name()).count().collect()]
        assert len(per_file) >= 4 and max(per_file) <= 30_000
    finally:
        if old is None:
            spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        else:
            spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)


def test_empty_extracts(spark):
    src = sources_for(spark, SF_SMALL)
    empty = ingested(type(src)(**{k: v.where("false") for k, v in src.__dict__.items()}))
    assert policy.policy_wide_table(empty, WINDOW).count() == 0
    assert extensions.claims_ratio(empty, WINDOW).count() == 0


def test_ingest_job_then_windows(spark, capsys):
    src = sources_for(spark, SF_SMALL)
    base, kept = scratch_path(spark, "extracts"), scratch_path(spark, "typed")
    for name in EXTRACT_SCHEMA_NAMES:
        if name in ("vehicle", "company"):
            columns = getattr(schemas, f"{name.upper()}_COLUMNS")
            files.to_delimited_lines(getattr(src, name), columns, "|").write.text(f"{base}/{name}")
        else:
            getattr(src, name).write.json(f"{base}/{name}")
    assert main(["ingest", "--extracts", base, "--out", kept], spark=spark) == 0
    capsys.readouterr()
    for start, end in (("1997-01-01 00:00:00", "1999-01-01 00:00:00"), ("1995-06-01 00:00:00", "1995-07-01 00:00:00")):
        assert main(["wide", "--ingested", kept, "--out", scratch_path(spark, "wide"), "--start", start,
                     "--end", end], spark=spark) == 0
        _, count = capsys.readouterr().out.strip().split("\t")
        assert int(count) == policy.policy_wide_table(src, Period.of(start, end)).count()
    with pytest.raises(SystemExit):
        main(["plain", "--ingested", kept, "--out", kept], spark=spark)


def test_written_columns(pair):
    """Each typed date is a timestamp; the layout columns come last."""
    _, kept = pair
    for name in BY_TIME:
        assert getattr(kept, name).columns[-2:] == ["first_date", MONTH]
        assert all(dict(getattr(kept, name).dtypes)[c] == "timestamp_ntz" for c in DATES[name])
    assert typed(kept.head, "head").schema == kept.head.schema
