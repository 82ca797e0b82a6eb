"""Registered queries: name → Spark callable, and name → oracle SQL.

Every query reads the driver's test tables (``sf_dir``) through the adapter,
runs over the whole tables, and aliases every output column to the name
used in its oracle SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from policylens.operators.indicators import POLICY_INDICATORS
from policylens.operators.period import Period
from policylens.oracle import Sql
from policylens.plans import endorsement as endo
from policylens.plans import policy as pol
from policylens.plans.policy import POLICY_INDICATOR_OUTPUT, WIDE_TABLE_OUTPUT
from policylens.sources.adapter import sources_for

# The reporting window of every registered query.
WINDOW = Period.of("1997-01-01 00:00:00", "1999-01-01 00:00:00")

QueryFn = Callable[[SparkSession, str], DataFrame]
_SPARK: dict[str, QueryFn] = {}
_SQL: dict[str, Callable[[Sql], str]] = {}


def register(name: str, sql: Callable[[Sql], str] | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        _SPARK[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def spark_queries() -> dict[str, QueryFn]:
    return dict(_SPARK)


def oracle_queries(period: Period = WINDOW) -> dict[str, str]:
    s = Sql(period)
    return {name: s.with_all(body(s)) for name, body in _SQL.items()}


def _cols(names) -> str:
    return ", ".join(names)


# --- pipelines ---------------------------------------------------------------------------------

@register("premium_income_by_company", lambda s: """
SELECT ps.comcode, co.comcname,
  CAST(SUM(CAST(CASE WHEN underwriteflag = 1 AND chargeflag = 1 AND cancelflag = 0 AND """
          + s.inside("maxStartdateUnderwritedate") + f""" THEN {s._own('sumpremium')} ELSE 0.0 END
       AS DECIMAL(20,6))) AS DOUBLE) AS premium_income,
  COUNT(*) AS policies
FROM policy_s ps LEFT JOIN company co ON ps.comcode = co.comcode
GROUP BY ps.comcode, co.comcname""")
def q_premium_income_by_company(spark, sf_dir):
    return pol.premium_income_by_company(sources_for(spark, sf_dir), WINDOW)


@register("endorsement_rollup", lambda s: "SELECT * FROM rollup")
def q_endorsement_rollup(spark, sf_dir):
    return endo.endorsement_rollup(sources_for(spark, sf_dir), WINDOW)


@register("policy_indicators", lambda s: f"SELECT {_cols(POLICY_INDICATOR_OUTPUT)} FROM policy_i")
def q_policy_indicators(spark, sf_dir):
    return pol.policy_indicators(sources_for(spark, sf_dir), WINDOW)


@register("policy_wide_table", lambda s: f"""
SELECT {_cols(WIDE_TABLE_OUTPUT)} FROM policy_i LEFT JOIN rollup USING (policyno)""")
def q_policy_wide_table(spark, sf_dir):
    return pol.policy_wide_table(sources_for(spark, sf_dir), WINDOW)


# --- flags, dates, projections -----------------------------------------------------------------

from policylens.functions.money import co_insured  # noqa: E402
from policylens.operators.columns import (  # noqa: E402
    add_date_by_flag, add_flag_char, add_later_date, cast_column, cast_to_timestamp, text_to_timestamp, width_guard,
)
from policylens.operators.indicators import endorsement_indicator_columns, policy_indicator_columns  # noqa: E402
from policylens.operators.records import copymain_record, head_record, policy_record  # noqa: E402
from policylens.plans.plain import PLAIN_WIDE_OUTPUT, plain_wide_table  # noqa: E402
from policylens.sources.ingest import ingested  # noqa: E402

POLICY_FLAGS = ["policyno", "underwriteflag", "chargeflag", "cancelflag", "coinsflag", "stopflag", "continueflag",
                "Tuancheflag"]


@register("flags_policy", lambda s: f"""
SELECT {_cols(POLICY_FLAGS)}, substring(othflag, 7, 1) AS charge_char FROM policy_r""")
def q_flags_policy(spark, sf_dir):
    rows = add_flag_char(policy_record(sources_for(spark, sf_dir).policy), "othflag", 6, "charge_char")
    return rows.select(*POLICY_FLAGS, "charge_char")


HEAD_FLAGS = ["applyno", "underwriteflag", "endortype", "tuibaoflag", "policycancelflag", "decreaseNotcancelflag"]
COPY_FLAGS = ["applyno", "coinsflag", "chargeflag", "policyunderwriteflag", "cancelflag"]


@register("flags_endorsement", lambda s: f"SELECT {_cols(HEAD_FLAGS)} FROM head_r")
def q_flags_endorsement(spark, sf_dir):
    """Endorsement header marks: underwriting, surrender, cancellation, other reduction."""
    return head_record(sources_for(spark, sf_dir).head).select(*HEAD_FLAGS)


@register("flags_copymain", lambda s: f"SELECT {_cols(COPY_FLAGS)} FROM copymain_r")
def q_flags_copymain(spark, sf_dir):
    """Flags of the policy snapshot per application (charge, co-insurance, underwriting, not cancelled)."""
    return copymain_record(sources_for(spark, sf_dir).copymain).select(*COPY_FLAGS)


@register("parse_and_later_date", lambda s: """
SELECT applyno, policyno,
  TRY_CAST(replace(underwriteenddate, '/', '-') AS TIMESTAMP) AS underwriteenddate,
  TRY_CAST(replace(validdate, '/', '-') AS TIMESTAMP) AS validdate,
  greatest(TRY_CAST(replace(validdate, '/', '-') AS TIMESTAMP),
           TRY_CAST(replace(underwriteenddate, '/', '-') AS TIMESTAMP)) AS later_date,
  TRY_CAST(underwriteflag AS INTEGER) AS underwriteflag,
  CASE WHEN contains(validdate, '/') THEN NULL ELSE TRY_CAST(validdate AS TIMESTAMP) END AS plain_cast
FROM head2""")
def q_parse_and_later_date(spark, sf_dir):
    df = sources_for(spark, sf_dir).head2.withColumn("plain_cast", F.col("validdate"))
    df = cast_to_timestamp(df, "plain_cast")                 # plain cast: slash text is not a date
    df = text_to_timestamp(text_to_timestamp(df, "underwriteenddate"), "validdate")
    df = add_later_date(df, "validdate", "underwriteenddate", "later_date")
    df = cast_column(df, "underwriteflag", "int")
    return df.select("applyno", "policyno", "underwriteenddate", "validdate", "later_date", "underwriteflag",
                     "plain_cast")


@register("date_by_flag", lambda s: """
SELECT policyno, CASE WHEN cancelflag = 1 THEN enddate ELSE startdate END AS chosen_date FROM policy_r""")
def q_date_by_flag(spark, sf_dir):
    df = policy_record(sources_for(spark, sf_dir).policy).withColumn("is_cancelled", F.col("cancelflag") == 1)
    return add_date_by_flag(df, "enddate", "startdate", "is_cancelled", "chosen_date").select("policyno", "chosen_date")


@register("window_month", lambda s: f"""
SELECT policyno, CASE WHEN policyno IS NOT NULL THEN '{s.p.start.strftime('%Y-%m')}' END AS timeYearMonth
FROM policy""")
def q_window_month(spark, sf_dir):
    cols = policy_indicator_columns(WINDOW)
    return sources_for(spark, sf_dir).policy.select("policyno", cols["timeYearMonth"].alias("timeYearMonth"))


# --- window predicates and filters -------------------------------------------------------------

@register("filter_in_window", lambda s: f"""
SELECT policyno, maxStartdateUnderwritedate FROM policy_r WHERE {s.inside('maxStartdateUnderwritedate')}""")
def q_filter_in_window(spark, sf_dir):
    df = policy_record(sources_for(spark, sf_dir).policy)
    return df.where(WINDOW.contains("maxStartdateUnderwritedate")).select("policyno", "maxStartdateUnderwritedate")


@register("filter_endorse_window", lambda s: f"""
SELECT applyno, policyno, maxValiddateAndWritedate, startdate
FROM copymain_r LEFT JOIN head_r USING (applyno)
WHERE {s.endorse_in('maxValiddateAndWritedate', 'startdate')}""")
def q_filter_endorse_window(spark, sf_dir):
    src = sources_for(spark, sf_dir)
    window = WINDOW.endorsement_in("maxValiddateAndWritedate", "startdate")
    return endo.copy_with_head(src, WINDOW, where=window).select(
        "applyno", "policyno", "maxValiddateAndWritedate", "startdate")


@register("filter_surrender_window", lambda s: f"""
SELECT applyno, policyno, maxValiddateAndWritedate, validdate, prppunderwriteenddate, startdate
FROM copymain_r LEFT JOIN head_r USING (applyno)
WHERE {s.surrender_in('maxValiddateAndWritedate', 'validdate', 'prppunderwriteenddate', 'startdate')}""")
def q_filter_surrender_window(spark, sf_dir):
    src = sources_for(spark, sf_dir)
    window = WINDOW.surrender_in("maxValiddateAndWritedate", "validdate", "prppunderwriteenddate", "startdate")
    return endo.copy_with_head(src, WINDOW, where=window).select(
        "applyno", "policyno", "maxValiddateAndWritedate", "validdate", "prppunderwriteenddate", "startdate")


@register("filter_endorsement_rows", lambda s: "SELECT * FROM ce_joined")
def q_filter_endorsement_rows(spark, sf_dir):
    return endo.copy_with_head(sources_for(spark, sf_dir), WINDOW)


# Policies that expire in an earlier window are kept too.
PRIOR_WINDOW = Period.of("1997-01-01 00:00:00", "1999-01-01 00:00:00", "1996-01-01 00:00:00", "1997-01-01 00:00:00")


@register("filter_policy_rows_prior", lambda s: f"SELECT * FROM policy_r WHERE {Sql(PRIOR_WINDOW).fil2()}")
def q_filter_policy_rows_prior(spark, sf_dir):
    return pol.filtered_policies(sources_for(spark, sf_dir), PRIOR_WINDOW)


@register("filter_policy_rows", lambda s: "SELECT * FROM policy_f")
def q_filter_policy_rows(spark, sf_dir):
    return pol.filtered_policies(sources_for(spark, sf_dir), WINDOW)


@register("ingested_policy_rows", lambda s: f"SELECT * FROM policy_r WHERE {Sql(PRIOR_WINDOW).fil2()}")
def q_ingested_policy_rows(spark, sf_dir):
    """The policies of two windows, read from typed extracts laid out by time (SRC-1, FIL-2)."""
    return pol.filtered_policies(ingested(sources_for(spark, sf_dir)), PRIOR_WINDOW)


@register("ingested_wide_table", lambda s: f"""
SELECT {_cols(WIDE_TABLE_OUTPUT)} FROM policy_i LEFT JOIN rollup USING (policyno)""")
def q_ingested_wide_table(spark, sf_dir):
    """The wide table of a window, from typed extracts laid out by time."""
    return pol.policy_wide_table(ingested(sources_for(spark, sf_dir)), WINDOW)


# --- co-insurance and indicators ---------------------------------------------------------------

@register("coinsurance_adjusted", lambda s: """
SELECT applyno, policyno, coinsflag, coinsrate, chgpremium,
  CASE WHEN coinsflag = 1 THEN chgpremium * coinsrate ELSE chgpremium END AS own_chgpremium
FROM endo_rows""")
def q_coinsurance_adjusted(spark, sf_dir):
    rows = endo.endorsement_rows(sources_for(spark, sf_dir), WINDOW)
    return rows.select("applyno", "policyno", "coinsflag", "coinsrate", "chgpremium",
                       co_insured("chgpremium", "coinsflag", "coinsrate").alias("own_chgpremium"))


@register("policy_shares", lambda s: """
SELECT policyno, proposalno, coinsflag, coinsrate,
  CASE WHEN coinsflag = 1 THEN sumpremium * coinsrate ELSE sumpremium END AS own_premium
FROM policy_s""")
def q_policy_shares(spark, sf_dir):
    rows = pol.policies_with_shares(sources_for(spark, sf_dir), WINDOW)
    return rows.select("policyno", "proposalno", "coinsflag", "coinsrate",
                       co_insured("sumpremium", "coinsflag", "coinsrate").alias("own_premium"))


IND_GROUPS = {
    "ind_raw_premium": ["rawpremium"],
    "ind_increase": ["increasecount", "increasepremium", "increaseamount"],
    "ind_decrease": ["decreasecount", "decreasepremium", "decreaseamount"],
    "ind_surrender": ["tuibaocount", "tuibaoamount", "tuibaopremium"],
    "ind_cancel": ["policycancelcount", "policycancelamount", "policycancelpremium"],
    "ind_other_reduction": ["decreasenotcancelcount"],
}


def _ind_query(names):
    def run(spark, sf_dir):
        cols = endorsement_indicator_columns(WINDOW)
        rows = endo.endorsement_rows(sources_for(spark, sf_dir), WINDOW)
        return rows.select("applyno", "policyno", *[cols[n].alias(n) for n in names])

    def sql(s: Sql) -> str:
        exprs = s.endorsement_indicator_exprs(exact=False)
        return "SELECT applyno, policyno, " + ", ".join(f"{exprs[n]} AS {n}" for n in names) + " FROM endo_gates"
    return run, sql


for _name, _inds in IND_GROUPS.items():
    _run, _sql = _ind_query(_inds)
    register(_name, _sql)(_run)


@register("ind_policy", lambda s: f"SELECT policyno, {_cols(POLICY_INDICATORS)} FROM policy_i")
def q_ind_policy(spark, sf_dir):
    rows = pol.policies_with_shares(sources_for(spark, sf_dir), WINDOW)
    return rows.withColumns(policy_indicator_columns(WINDOW)).select("policyno", *POLICY_INDICATORS)


# --- older job ---------------------------------------------------------------------------------

def _plain_sql(s: Sql) -> str:
    return f"""
SELECT {_cols(PLAIN_WIDE_OUTPUT)} FROM (
  SELECT policyno, proposalno, TRY_CAST(replace(startdate, '/', '-') AS TIMESTAMP) AS startdate,
    TRY_CAST(replace(enddate, '/', '-') AS TIMESTAMP) AS enddate,
    TRY_CAST(replace(underwriteenddate, '/', '-') AS TIMESTAMP) AS underwriteenddate,
    comcode, riskcode, sumpremium, sumamount,
    greatest(TRY_CAST(replace(startdate, '/', '-') AS TIMESTAMP),
             TRY_CAST(replace(underwriteenddate, '/', '-') AS TIMESTAMP)) AS validdate
  FROM policy2) pw
LEFT JOIN (
  SELECT applyno, endortype AS endortype1, policyno, riskcode AS riskcode1,
    TRY_CAST(replace(underwriteenddate, '/', '-') AS TIMESTAMP) AS underwriteenddate1,
    underwriteflag AS underwriteflag1, TRY_CAST(replace(validdate, '/', '-') AS TIMESTAMP) AS validdate1
  FROM head2) h USING (policyno)
LEFT JOIN (SELECT applyno, chgamount AS chgamount1, chgpremium AS chgpremium1, currency FROM fee2) f USING (applyno)
LEFT JOIN profit2 USING (proposalno)
LEFT JOIN vehicle2 USING (proposalno)
LEFT JOIN (SELECT applyno, chgpremium AS chgpremium3, coinsflag AS coinsflag1, othflag AS othflag2,
                  riskcode AS riskcode2 FROM pmain2) m USING (applyno)
LEFT JOIN (SELECT applyno, calculateflag, chgamount AS chgamount2, chgpremium AS chgpremium2, currency AS currency1,
                  policyno FROM itemkind2) i USING (applyno, policyno)"""


@register("plain_wide_table", _plain_sql)
def q_plain_wide_table(spark, sf_dir):
    return plain_wide_table(sources_for(spark, sf_dir))


@register("width_guard", lambda s: "SELECT * FROM policy2")
def q_width_guard(spark, sf_dir):
    src = sources_for(spark, sf_dir)
    kept = width_guard(src.policy2, 9)
    dropped = width_guard(src.policy2, 8)        # wrong width: no rows
    return kept.unionByName(dropped)


@register("result_count", lambda s: "SELECT COUNT(*) AS n_rows FROM policy_i LEFT JOIN rollup USING (policyno)")
def q_result_count(spark, sf_dir):
    from policylens.sources.sinks import row_count
    return row_count(pol.policy_wide_table(sources_for(spark, sf_dir), WINDOW))


# --- file sources and sinks (write, then read back what was written) ---------------------------

from policylens import schemas  # noqa: E402
from policylens.functions.sql import register_sql_functions  # noqa: E402
from policylens.session import scratch_path  # noqa: E402
from policylens.sources import files, sinks  # noqa: E402
from policylens.sources.adapter import Sources  # noqa: E402

DELIMITER = "|"


def _vehicle_lines(src) -> DataFrame:
    """Vehicle rows as delimited lines; some lines are malformed on purpose:
    an extra field (k % 50 = 1) or an empty last field (k % 50 = 2)."""
    k = F.substring("proposalno", 2, 21).cast("long")
    cols = [F.coalesce(F.col(c), F.lit("")) for c in schemas.VEHICLE_COLUMNS]
    last = F.when(k % 50 == 2, F.lit("")).otherwise(cols[-1])
    line = F.concat_ws(DELIMITER, *cols[:-1], last)
    line = F.when(k % 50 == 1, F.concat(line, F.lit(DELIMITER + "X"))).otherwise(line)
    return src.vehicle.select(line.alias("value"))


def _delimited(spark, sf_dir):
    src = sources_for(spark, sf_dir)
    vpath, cpath = scratch_path(spark, "vehicle-txt"), scratch_path(spark, "company-txt")
    _vehicle_lines(src).write.text(vpath)
    files.to_delimited_lines(src.company, schemas.COMPANY_COLUMNS, DELIMITER).write.text(cpath)
    sep = files.sniff_separator(spark, vpath, key_width=22)
    return (files.read_delimited(spark, vpath, schemas.VEHICLE_COLUMNS, sep),
            files.read_delimited(spark, cpath, schemas.COMPANY_COLUMNS, sep))


@register("delimited_roundtrip", lambda s: f"""
SELECT {_cols(schemas.VEHICLE_COLUMNS)} FROM vehicle WHERE CAST(substring(proposalno, 2) AS BIGINT) % 50 NOT IN (1, 2)""")
def q_delimited_roundtrip(spark, sf_dir):
    return _delimited(spark, sf_dir)[0]


@register("delimited_company_roundtrip", lambda s: f"SELECT {_cols(schemas.COMPANY_COLUMNS)} FROM company")
def q_delimited_company_roundtrip(spark, sf_dir):
    return _delimited(spark, sf_dir)[1]


@register("json_roundtrip", lambda s: "SELECT * FROM rollup")
def q_json_roundtrip(spark, sf_dir):
    """Endorsement extracts written as JSON lines, every tenth line again cut off
    in the middle, read back with explicit schemas and rolled up (SRC-1 feeding
    PIPE-1): broken lines are no rows, and each is in the rejects."""
    src = sources_for(spark, sf_dir)
    read = {}
    for name, schema in (("copymain", schemas.COPYMAIN), ("head", schemas.HEAD), ("fee", schemas.FEE),
                         ("itemkind", schemas.ITEMKIND), ("copycoins", schemas.COPYCOINS)):
        path = scratch_path(spark, f"{name}-json")
        text, line = getattr(src, name).select(F.to_json(F.struct("*")).alias("value")), F.col("value")
        half = F.when(F.pmod(F.xxhash64(line), F.lit(10)) == 0, F.expr("left(value, length(value) div 2)"))
        again = text.select(F.explode(F.array(line, half)).alias("value")).where(line.isNotNull())
        again.write.option("compression", "gzip").text(path)
        read[name], rejects = files.parse_json_checked(spark, path, schema, scratch_path(spark, f"{name}-parsed"))
        sinks.write_parquet(rejects, scratch_path(spark, f"{name}-rejects"))
    return endo.endorsement_rollup(_replace(src, **read), WINDOW)


def _replace(src: Sources, **frames) -> Sources:
    return Sources(**{**src.__dict__, **frames})


@register("csv_roundtrip", lambda s: f"""
SELECT {_cols(WIDE_TABLE_OUTPUT)} FROM policy_i LEFT JOIN rollup USING (policyno)""")
def q_csv_roundtrip(spark, sf_dir):
    """Wide table written as CSV under its window folder (SNK-1), compressed as the
    JSON lines of a round trip are, read back (SRC-2)."""
    wide = pol.policy_wide_table(sources_for(spark, sf_dir), WINDOW)
    path, _ = sinks.write_csv_per_window(wide, scratch_path(spark, "wide-csv"), WINDOW, compression="gzip")
    return files.read_csv(spark, path, wide.schema, sep=",")


@register("csv_caret_roundtrip", lambda s: f"SELECT {_cols(schemas.VEHICLE_COLUMNS)} FROM vehicle")
def q_csv_caret_roundtrip(spark, sf_dir):
    """Vehicle rows written with "^" between fields, read back as CSV with that separator (SRC-2)."""
    vehicle = sources_for(spark, sf_dir).vehicle.select(*schemas.VEHICLE_COLUMNS)
    path = scratch_path(spark, "vehicle-caret")
    vehicle.write.option("sep", "^").csv(path)
    return files.read_csv(spark, path, vehicle.schema, sep="^")


@register("parquet_roundtrip", _plain_sql)
def q_parquet_roundtrip(spark, sf_dir):
    """Plain wide table written as Parquet (SNK-2/3), read back."""
    plain = plain_wide_table(sources_for(spark, sf_dir))
    path, _ = sinks.write_parquet(plain, scratch_path(spark, "plain-parquet"), compression="zstd")
    return spark.read.parquet(path)


# --- SQL functions -----------------------------------------------------------------------------

SQL_VIEW = "policylens_policy_extract"


@register("sql_functions", lambda s: f"""
SELECT policyno,
  {_flag('othflag', 6, 'Y')} AS chargeflag,
  {_flag('coinsflag', 0, '1', '2')} AS coinsflag,
  substring(othflag, 1, 1) AS first_char,
  greatest(TRY_CAST(replace(underwriteenddate, '/', '-') AS TIMESTAMP),
           TRY_CAST(replace(startdate, '/', '-') AS TIMESTAMP)) AS validdate,
  COALESCE(greatest(TRY_CAST(replace(underwriteenddate, '/', '-') AS TIMESTAMP),
           TRY_CAST(replace(startdate, '/', '-') AS TIMESTAMP)) > {_ts(s.p.start)}
      AND greatest(TRY_CAST(replace(underwriteenddate, '/', '-') AS TIMESTAMP),
           TRY_CAST(replace(startdate, '/', '-') AS TIMESTAMP)) < {_ts(s.p.end)}, FALSE) AS started_in_window,
  CASE WHEN {_flag('coinsflag', 0, '1', '2')} = 1 THEN sumpremium * 0.5 ELSE sumpremium END AS half_share_premium,
  CASE WHEN policyno IS NOT NULL THEN '{s.p.start.strftime('%Y-%m')}' END AS timeYearMonth,
  {_amount(s, 'operatedate', 'sumpremium')} AS written_premium,
  {_amount(s, 'startdate', 'sumpremium')} AS premium_income,
  {_amount(s, 'startdate', 'sumamount')} AS sum_insured,
  CASE WHEN underwriteflag IN ('1', '3') AND {_flag('othflag', 3, '1')} = 0 AND {s.inside(_parse('enddate'))}
    THEN 1 ELSE 0 END AS expiring
FROM policy""")
def q_sql_functions(spark, sf_dir):
    """The same builders called by name from SQL text (UDF-1..3)."""
    register_sql_functions(spark)
    sources_for(spark, sf_dir).policy.createOrReplaceTempView(SQL_VIEW)
    start = WINDOW.start.strftime("%Y-%m-%d %H:%M:%S")
    end = WINDOW.end.strftime("%Y-%m-%d %H:%M:%S")
    approved = "CAST(underwriteflag IN ('1', '3') AS INT)"
    cancelled = "pl_flag_in(othflag, 3, array('1'))"

    def amount(day: str, column: str) -> str:
        return (f"pl_own_amount_in({column}, pl_flag_in(coinsflag, 0, array('1', '2')), 0.5D, {approved}, "
                f"pl_flag_in(othflag, 6, array('Y')), {cancelled}, "
                f"pl_later(pl_parse_ts(underwriteenddate), pl_parse_ts({day})), "
                f"TIMESTAMP_NTZ '{start}', TIMESTAMP_NTZ '{end}')")

    return spark.sql(f"""
        SELECT policyno,
          pl_flag_in(othflag, 6, array('Y')) AS chargeflag,
          pl_flag_in(coinsflag, 0, array('1', '2')) AS coinsflag,
          pl_char_at(othflag, 0) AS first_char,
          pl_later(pl_parse_ts(underwriteenddate), pl_parse_ts(startdate)) AS validdate,
          pl_in_window(pl_later(pl_parse_ts(underwriteenddate), pl_parse_ts(startdate)),
                       TIMESTAMP_NTZ '{start}', TIMESTAMP_NTZ '{end}') AS started_in_window,
          pl_own_share(sumpremium, pl_flag_in(coinsflag, 0, array('1', '2')), 0.5D) AS half_share_premium,
          pl_year_month(policyno, TIMESTAMP_NTZ '{start}') AS timeYearMonth,
          {amount('operatedate', 'sumpremium')} AS written_premium,
          {amount('startdate', 'sumpremium')} AS premium_income,
          {amount('startdate', 'sumamount')} AS sum_insured,
          pl_expiring_in(pl_parse_ts(enddate), {approved}, {cancelled},
                         TIMESTAMP_NTZ '{start}', TIMESTAMP_NTZ '{end}') AS expiring
        FROM {SQL_VIEW}""")


def _parse(column):
    from policylens.oracle import parse
    return parse(column)


def _amount(s: Sql, day: str, amount: str) -> str:
    """Written out: own half share of an approved, charged, kept policy whose later date is in the window."""
    later = f"greatest({_parse('underwriteenddate')}, {_parse(day)})"
    return (f"CASE WHEN underwriteflag IN ('1', '3') AND {_flag('othflag', 6, 'Y')} = 1 AND {_flag('othflag', 3, '1')} = 0 "
            f"AND {s.inside(later)} THEN CASE WHEN {_flag('coinsflag', 0, '1', '2')} = 1 THEN {amount} * 0.5 "
            f"ELSE {amount} END ELSE 0.0 END")


def _flag(col, index, *values):
    from policylens.oracle import flag_in
    return flag_in(col, index, *values)


def _ts(value):
    from policylens.oracle import ts
    return ts(value)


# --- indicators named but not coded in the original job (our definitions) ----------------------

from policylens.plans import extensions as ext  # noqa: E402


def _claims_ratio_sql(s: Sql) -> str:
    def mic(x):
        return f"round_even(COALESCE({x}, 0.0) * 1000000.0, 0)::BIGINT"
    income = ("CASE WHEN underwriteflag = 1 AND chargeflag = 1 AND cancelflag = 0 AND "
              + s.inside("maxStartdateUnderwritedate") + f" THEN {s._own('sumpremium')} ELSE 0.0 END")
    return f"""
SELECT comcode, premium_income, claims_paid,
  CASE WHEN premium_income <> 0 THEN claims_paid / premium_income END AS claims_ratio
FROM (
  SELECT comcode, CAST(SUM(i) AS DOUBLE) / 1e6 AS premium_income, CAST(SUM(p) AS DOUBLE) / 1e6 AS claims_paid
  FROM (
    SELECT comcode, {mic(income)} AS i, 0 AS p FROM policy_s
    UNION ALL
    SELECT policy.comcode, 0 AS i, {mic('paid')} AS p FROM claims LEFT JOIN policy USING (policyno)
    WHERE {s.inside(_parse('claimtime'))}) t
  GROUP BY comcode) t"""


@register("claims_ratio", _claims_ratio_sql)
def q_claims_ratio(spark, sf_dir):
    return ext.claims_ratio(sources_for(spark, sf_dir), WINDOW)


def _ncd_sql(s: Sql) -> str:
    coefs = " ".join(f"WHEN {g} THEN CAST({c} AS DOUBLE)" for g, c in sorted(ext.NCD_COEFFICIENTS.items()))
    top = max(ext.NCD_COEFFICIENTS)
    return f"""
SELECT policyno, insuredcode, CAST(run AS INTEGER) AS claim_free_run, CAST(LEAST(run, {top}) AS INTEGER) AS ncd_grade,
  CASE LEAST(run, {top}) {coefs} END AS ncd_coefficient
FROM (
  SELECT * EXCLUDE (run), CASE WHEN insuredcode IS NULL THEN 0 ELSE run END AS run FROM (SELECT *, seq - COALESCE(MAX(CASE WHEN claimed THEN seq END) OVER (
      PARTITION BY insuredcode ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) - 1 AS run
  FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY insuredcode ORDER BY startdate ASC NULLS FIRST, policyno) AS seq
    FROM (
      SELECT p.policyno, p.insuredcode, {_parse('p.startdate')} AS startdate,
        COALESCE(c.claimed, FALSE) AS claimed
      FROM policy p LEFT JOIN (
        SELECT policyno, COUNT(*) FILTER (WHERE paid > 0) > 0 AS claimed FROM claims GROUP BY policyno) c
      USING (policyno)) a) b) b2) c"""


@register("ncd_coefficient", _ncd_sql)
def q_ncd_coefficient(spark, sf_dir):
    return ext.ncd_coefficient(sources_for(spark, sf_dir))


# --- streaming ---------------------------------------------------------------------------------

from policylens.streaming.policy_stream import policy_extract_stream, read_sink, run_available  # noqa: E402


@register("stream_policy_indicators", lambda s: f"SELECT {_cols(POLICY_INDICATOR_OUTPUT)} FROM policy_i")
def q_stream_policy_indicators(spark, sf_dir):
    """Policy extracts written as JSON files in several parts, streamed
    through the policy plan into a Parquet sink, read back."""
    src = sources_for(spark, sf_dir)
    folder, sink = scratch_path(spark, "policy-stream-in"), scratch_path(spark, "policy-stream-out")
    src.policy.write.json(folder)
    run_available(policy_extract_stream(spark, folder), src, WINDOW, sink, scratch_path(spark, "policy-stream-ckpt"))
    return read_sink(spark, sink)
