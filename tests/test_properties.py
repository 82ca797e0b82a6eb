"""Property tests: column builders against plain-Python models, and the scaled
roll-up against the row-level definition on random fan-out fixtures."""

import random
from datetime import datetime, timedelta

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from policylens import schemas
from policylens.functions import flags
from policylens.operators.indicators import ENDORSEMENT_INDICATORS
from policylens.operators.period import Period
from policylens.plans.endorsement import endorsement_indicator_rows, endorsement_rollup, rollup_rows

WINDOW = Period.of("1997-01-01 00:00:00", "1999-01-01 00:00:00")
S, E = WINDOW.start, WINDOW.end

flag_text = st.one_of(st.none(), st.text(alphabet="01YN 23", max_size=9))
dates = st.one_of(st.none(), st.sampled_from([S, E]),
                  st.datetimes(min_value=datetime(1996, 6, 1), max_value=datetime(1999, 6, 1)))


def py_flag_in(s, i, values):
    if s is None or i >= len(s):
        return 0
    return 1 if s[i].strip() in values else 0


@settings(max_examples=15, deadline=None)
@given(st.lists(flag_text, min_size=1, max_size=40), st.integers(min_value=0, max_value=8))
def test_flag_in_model(spark, values, index):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [r[0] for r in df.select(flags.flag_in("s", index, "1", "Y")).collect()]
    assert got == [py_flag_in(v, index, {"1", "Y"}) for v in values]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), st.sampled_from(["19", "19 ", " 19", "N1", "21", "10", "210", "2110", "58", ""]),
                          st.text(alphabet="0129N ", max_size=5)), min_size=1, max_size=40))
def test_endorsement_type_model(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "s string")
    got = [tuple(r) for r in df.select(
        flags.contains_any("s", "21", "10"), flags.in_set("s", ["19", "N1"]),
        flags.not_in_set_trimmed("s", ["19", "N1", "21", "10"])).collect()]
    expected = [(0, 0, 0) if v is None else
                (int("21" in v or "10" in v), int(v in ("19", "N1")), int(v.strip() not in ("19", "N1", "21", "10")))
                for v in values]
    assert got == expected


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(dates, dates, dates, dates), min_size=1, max_size=40))
def test_window_predicates_model(spark, rows):
    df = spark.createDataFrame(rows, "m timestamp_ntz, v timestamp_ntz, u timestamp_ntz, s timestamp_ntz")
    got = [tuple(r) for r in df.select(
        WINDOW.contains("m"), WINDOW.endorsement_in("m", "s"), WINDOW.surrender_in("m", "v", "u", "s")).collect()]

    def inside(d):
        return d is not None and S < d < E

    expected = []
    for m, v, u, s in rows:
        p2 = inside(m) and s is not None and s < E
        p3 = (None not in (v, u, s)) and inside(m) and inside(u) and inside(v) and inside(s) and u > s and v > s
        expected.append((inside(m), p2, p3))
    assert got == expected


def random_fixture(spark, seed, policies=60):
    rnd = random.Random(seed)

    def date_text(d):
        if d is None:
            return None
        return d.strftime("%Y/%m/%d %H:%M:%S") if rnd.random() < 0.5 else d.strftime("%Y-%m-%d %H:%M:%S")

    def some_date():
        r = rnd.random()
        if r < 0.05:
            return None
        if r < 0.1:
            return rnd.choice([S, E])
        return datetime(1996, 6, 1) + timedelta(days=rnd.randint(0, 1000))

    copy, head, fee, item, coins = [], [], [], [], []
    for p in range(policies):
        start = some_date()
        oth = rnd.choice([None, "000000Y", "000100Y", "000000N", "0000"])
        cflag = rnd.choice(["0", "1", "2", None])
        for a in range(rnd.randint(1, 4)):
            app = f"A{p}-{a}"
            for _ in range(1 if rnd.random() < 0.9 else 2):
                copy.append((app, f"P{p}", date_text(start), date_text(some_date()), float(a), oth,
                             rnd.choice([None, round(rnd.uniform(100, 5000), 2)]), round(rnd.uniform(1e3, 1e5), 2),
                             cflag, rnd.choice(["1", "3", "11", "2", None])))
            for _ in range(rnd.choice([0, 1, 1, 1, 2, 3])):
                row = (app, rnd.choice(["1", "2", None]), date_text(some_date()),
                       rnd.choice(["19", "N1", "21", "10", "58", "19 ", "2110", None]), date_text(some_date()))
                head.extend([row] * rnd.choice([1, 1, 2]))
            for _ in range(rnd.choice([0, 1, 1, 2, 3])):
                fee.append((app, rnd.choice([None, round(rnd.uniform(-500, 500), 4)]),
                            rnd.choice([None, float(rnd.randint(-20, 20) * 1000)]), "CNY"))
            for _ in range(rnd.choice([0, 1, 1, 2])):
                item.append((app, rnd.choice(["Y", "N", None]), "CNY", 0.0, 0.0, f"P{p}"))
            for _ in range(rnd.choice([0, 0, 1, 2])):
                coins.append((app, rnd.choice([None, float(rnd.randint(10, 90))])))
    from types import SimpleNamespace
    return SimpleNamespace(
        copymain=spark.createDataFrame(copy, schemas.COPYMAIN), head=spark.createDataFrame(head, schemas.HEAD),
        fee=spark.createDataFrame(fee, schemas.FEE), itemkind=spark.createDataFrame(item, schemas.ITEMKIND),
        copycoins=spark.createDataFrame(coins, schemas.COPYCOINS))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_scaled_rollup_equals_row_level_on_random_fan_out(spark, seed):
    src = random_fixture(spark, seed)
    scaled = {r["policyno"]: r for r in endorsement_rollup(src, WINDOW).collect()}
    naive = {r["policyno"]: r for r in rollup_rows(endorsement_indicator_rows(src, WINDOW)).collect()}
    assert scaled.keys() == naive.keys() and len(scaled) > 10
    for key in scaled:
        for c in ENDORSEMENT_INDICATORS:
            a, b = scaled[key][c], naive[key][c]
            assert a == pytest.approx(b, rel=1e-9, abs=1e-6), (seed, key, c, a, b)
    hot = endorsement_rollup(src, WINDOW).where(F.col("increasecount") + F.col("decreasecount") > 0).count()
    assert hot > 0
