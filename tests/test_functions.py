"""Expression tests: flags, dates, window predicates (hand-made edge rows)."""

from datetime import datetime

from pyspark.sql import functions as F

from policylens.functions import dates, flags
from policylens.functions.money import co_insured
from policylens.operators.period import Period


def one_col(spark, values, expr, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"s {dtype}")
    return [r[0] for r in df.select(expr(F.col("s"))).collect()]


def test_flag_in_handles_null_short_blank(spark):
    vals = [None, "", "1", "0000001", "000000Y", "000000 ", "000000y", "0000 0Y"]
    got = one_col(spark, vals, lambda c: flags.flag_in(c, 6, "Y"))
    assert got == [0, 0, 0, 0, 1, 0, 0, 1]


def test_flag_in_trims_the_character(spark):
    # a blank at the index trims to "" and matches nothing
    assert one_col(spark, [" 1", "1 "], lambda c: flags.flag_in(c, 1, "1")) == [1, 0]


def test_new_renew_transfer(spark):
    vals = [None, "0", "1", "2", "3", "", " "]
    assert one_col(spark, vals, lambda c: flags.new_renew_transfer(c, 0, "0", "1", "2")) == [0, 0, 1, 2, 0, 0, 0]


def test_endorsement_type_marks(spark):
    vals = [None, "19", "19 ", "N1", "21", "10", "210", "2110", "58", ""]
    surrender = one_col(spark, vals, lambda c: flags.contains_any(c, "21", "10"))
    cancel = one_col(spark, vals, lambda c: flags.in_set(c, ["19", "N1"]))
    other = one_col(spark, vals, lambda c: flags.not_in_set_trimmed(c, ["19", "N1", "21", "10"]))
    assert surrender == [0, 0, 0, 0, 1, 1, 1, 1, 0, 0]
    assert cancel == [0, 1, 0, 1, 0, 0, 0, 0, 0, 0]
    # "19 " trims to a cancellation type, so it is no "other reduction"
    assert other == [0, 0, 0, 0, 0, 0, 1, 1, 1, 1]


def test_is_null_flag(spark):
    assert one_col(spark, [None, "", "C1"], flags.is_null_flag) == [1, 0, 0]


def test_parse_ts_variants(spark):
    vals = ["1997/01/02 03:04:05", "1997-01-02 03:04:05.250", "1997-01-02", "bad", "2013-02-30 00:00:00", None]
    got = one_col(spark, vals, dates.parse_ts)
    assert got == [datetime(1997, 1, 2, 3, 4, 5), datetime(1997, 1, 2, 3, 4, 5, 250000), datetime(1997, 1, 2),
                   None, None, None]


def test_later_skips_nulls(spark):
    df = spark.createDataFrame(
        [(None, None), (None, "1997-01-02"), ("1997-01-03", None), ("1997-01-02", "1997-01-02"),
         ("1997/01/05 00:00:00", "1997-01-04 00:00:00")], "a string, b string")
    got = [r[0] for r in df.select(dates.later_of_text("a", "b")).collect()]
    assert got == [None, datetime(1997, 1, 2), datetime(1997, 1, 3), datetime(1997, 1, 2), datetime(1997, 1, 5)]


def test_pick_date_and_year_month(spark):
    df = spark.createDataFrame([(True, "k"), (False, None), (None, "k")], "t boolean, key string")
    df = df.select(dates.pick_date("t", F.lit(1), F.lit(2)).alias("d"),
                   dates.year_month_of_window("key", datetime(1997, 3, 5)).alias("ym"))
    assert [tuple(r) for r in df.collect()] == [(1, "1997-03"), (2, None), (2, "1997-03")]


def test_window_is_strict_and_null_false(spark):
    p = Period.of("1997-01-01 00:00:00", "1999-01-01 00:00:00")
    vals = [datetime(1997, 1, 1), datetime(1999, 1, 1), datetime(1997, 1, 1, 0, 0, 0, 1),
            datetime(1998, 12, 31, 23, 59, 59, 999999), None]
    df = spark.createDataFrame([(v,) for v in vals], "d timestamp_ntz")
    assert [r[0] for r in df.select(p.contains("d")).collect()] == [False, False, True, True, False]


def test_surrender_window_requires_dates_after_start(spark):
    p = Period.of("1997-01-01 00:00:00", "1999-01-01 00:00:00")
    row = (datetime(1998, 1, 1), datetime(1998, 1, 1), datetime(1998, 1, 1), datetime(1997, 6, 1))
    same = (datetime(1998, 1, 1), datetime(1998, 1, 1), datetime(1997, 6, 1), datetime(1997, 6, 1))
    nulls = (datetime(1998, 1, 1), None, datetime(1998, 1, 1), datetime(1997, 6, 1))
    df = spark.createDataFrame([row, same, nulls], "m timestamp_ntz, v timestamp_ntz, u timestamp_ntz, s timestamp_ntz")
    got = [r[0] for r in df.select(p.surrender_in("m", "v", "u", "s")).collect()]
    assert got == [True, False, False]


def test_endorsement_window_needs_start_before_end(spark):
    p = Period.of("1997-01-01 00:00:00", "1999-01-01 00:00:00")
    df = spark.createDataFrame(
        [(datetime(1998, 1, 1), datetime(1998, 12, 1)), (datetime(1998, 1, 1), datetime(1999, 1, 1)),
         (datetime(1998, 1, 1), None)], "m timestamp_ntz, s timestamp_ntz")
    assert [r[0] for r in df.select(p.endorsement_in("m", "s")).collect()] == [True, False, False]


def test_co_insured(spark):
    df = spark.createDataFrame([(100.0, 1, 0.3), (100.0, 0, 0.3), (100.0, 2, 0.3)], "x double, f int, r double")
    assert [r[0] for r in df.select(co_insured("x", "f", "r")).collect()] == [30.0, 100.0, 100.0]


def test_trim_removes_every_low_character(spark):
    vals = ["19", "19\t", " \x0019\r\n", "58\t", "\u00a019", None]
    got = one_col(spark, vals, lambda c: flags.not_in_set_trimmed(c, ["19", "N1", "21", "10"]))
    assert got == [0, 0, 0, 1, 1, 0]


DATES = {"2013-01-02 03:04:05": True, "2013/01/02 03:04:05.678": True, "2013-1-2": True, " 2013-01-02\t": True,
         "2013": False, "2013/5": False, "2013-01-02 03:04:05+08:00": False, "2013-01-02T03:04:05": False,
         "2013-02-30": False, "": False, "x": False}


def test_only_documented_date_shapes_are_dates(spark):
    from policylens.functions import dates
    got = one_col(spark, list(DATES), lambda c: dates.parse_ts(c).isNotNull())
    assert got == list(DATES.values())


def test_sql_functions_equal_the_builders(spark):
    """UDF-1..3: both statements of the rules on the same edge rows."""
    from datetime import datetime

    from policylens.functions import dates, money
    from policylens.functions.sql import register_sql_functions
    from policylens.operators.indicators import policy_indicator_columns
    from policylens.operators.period import Period
    register_sql_functions(spark)
    window = Period.of("2013-01-01 00:00:00", "2014-01-01 00:00:00")
    texts = [*DATES, None, "1", "\t1 ", "0Y", " Y", "19\t"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    pairs = [("pl_flag_in(s, 0, array('1', 'Y'))", flags.flag_in("s", 0, "1", "Y")),
             ("pl_flag_in(s, 1, array('Y'))", flags.flag_in("s", 1, "Y")),
             ("pl_char_at(s, 1)", flags.char_at("s", 1)), ("pl_parse_ts(s)", dates.parse_ts("s")),
             ("pl_in_window(pl_parse_ts(s), TIMESTAMP_NTZ '2013-01-01', TIMESTAMP_NTZ '2014-01-01')",
              window.contains(dates.parse_ts("s")))]
    for sql, column in pairs:
        for r in df.select(F.expr(sql).alias("a"), column.alias("b"), "s").collect():
            assert r["a"] == r["b"], (sql, r)
    days = [None, datetime(2013, 1, 1), datetime(2013, 6, 1), datetime(2014, 1, 1)]
    rows = [(u, c, x, 1 if i % 2 else 0, d, [None, 10.5][i % 2], 0.25)
            for u in (0, 1) for c in (0, 1) for x in (0, 1) for i, d in enumerate(days)]
    wide = spark.createDataFrame(rows, "underwriteflag int, chargeflag int, cancelflag int, coinsflag int, "
                                       "maxStartdateUnderwritedate timestamp_ntz, sumpremium double, coinsrate double")
    wide = wide.withColumns({"maxOperatedateUnderwritedate": F.col("maxStartdateUnderwritedate"), "policyno": F.lit("P"),
                             "enddate": F.col("maxStartdateUnderwritedate"), "sumamount": F.col("sumpremium")})
    cols = policy_indicator_columns(window)
    bounds = "TIMESTAMP_NTZ '2013-01-01', TIMESTAMP_NTZ '2014-01-01'"
    sql = {"baofeishouru": "pl_own_amount_in(sumpremium, coinsflag, coinsrate, underwriteflag, chargeflag, cancelflag, "
                           f"maxStartdateUnderwritedate, {bounds})",
           "zhongbaoshuliang": f"pl_expiring_in(enddate, underwriteflag, cancelflag, {bounds})"}
    for name, text in sql.items():
        for r in wide.select(F.expr(text).alias("a"), cols[name].alias("b")).collect():
            assert r["a"] == r["b"], name
    own = wide.select(F.expr("pl_own_share(sumpremium, coinsflag, coinsrate)").alias("a"),
                      money.co_insured("sumpremium", "coinsflag", "coinsrate").alias("b")).collect()
    assert all(r["a"] == r["b"] for r in own)
