"""Reference SQL (DuckDB dialect) for every registered query.

The same derivation of the extracts from the test tables as
``sources.adapter``, followed by the row-level definition of each operator:
joins that really fan out, indicators per joined row, then plain SQL
aggregates with exact decimals.  Used by the driver's correctness check and
by ``tests/``.
"""

from __future__ import annotations

from policylens.operators.period import Period
from policylens.sources.adapter import ENDORSEMENT_TYPES, UNDERWRITE_FLAGS


def _q(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)


def _txt(ts: str, key: str) -> str:
    return (f"CASE WHEN ({key}) % 2 = 0 THEN strftime({ts}, '%Y-%m-%d %H:%M:%S.%g') "
            f"ELSE strftime({ts}, '%Y/%m/%d %H:%M:%S') END")


def _days(ts: str, days: str) -> str:
    return f"({ts} + to_days(CAST({days} AS INTEGER)))"


def _pick(index: str, values) -> str:
    arms = " ".join(f"WHEN {i} THEN '{v}'" for i, v in enumerate(values))
    return f"CASE {index} {arms} END"


def trimmed(s: str) -> str:
    return f"regexp_replace({s}, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '', 'g')"


def parse(s: str) -> str:
    text = f"replace({trimmed(s)}, '/', '-')"
    return (f"CASE WHEN regexp_full_match({text}, '\\d{{4}}-\\d\\d?-\\d\\d?( \\d\\d?:\\d\\d?:\\d\\d?([.]\\d{{1,9}})?)?') "
            f"THEN TRY_CAST({text} AS TIMESTAMP) END")


def flag_in(s: str, index: int, *values: str) -> str:
    return f"COALESCE(CAST({trimmed(f'substring({s}, {index + 1}, 1)')} IN ({_q(values)}) AS INTEGER), 0)"


_PERCENT = "CASE WHEN k % 33 = 0 THEN CAST(33.33333333 AS DOUBLE) ELSE CAST(20 + k % 60 AS DOUBLE) END"


def _unless(matches: str, key: str) -> str:
    return f"CASE WHEN {matches} THEN {key} ELSE 'X' || substring({key}, 2) END"


def ts(value) -> str:
    return f"TIMESTAMP '{value.strftime('%Y-%m-%d %H:%M:%S.%f')}'"


class Sql:
    """SQL text builders for one reporting window."""

    def __init__(self, period: Period):
        self.p = period

    # -- window predicates ------------------------------------------------------------------
    def inside(self, d: str, period: Period | None = None) -> str:
        p = period or self.p
        return f"COALESCE(({d} > {ts(p.start)} AND {d} < {ts(p.end)}), FALSE)"

    def endorse_in(self, mvw: str, start: str) -> str:
        return f"({self.inside(mvw)} AND COALESCE({start} < {ts(self.p.end)}, FALSE))"

    def surrender_in(self, mvw: str, valid: str, uw: str, start: str) -> str:
        return (f"({self.inside(mvw)} AND {self.inside(uw)} AND {self.inside(valid)} AND {self.inside(start)} "
                f"AND COALESCE(({uw} > {start} AND {valid} > {start}), FALSE))")

    def fil1(self) -> str:
        return (f"({self.inside('policyValiddate')} OR {self.endorse_in('maxValiddateAndWritedate', 'startdate')} "
                f"OR {self.surrender_in('maxValiddateAndWritedate', 'validdate', 'prppunderwriteenddate', 'startdate')})")

    def fil2(self) -> str:
        return (f"({self.inside('maxOperatedateUnderwritedate')} OR {self.inside('maxStartdateUnderwritedate')} "
                f"OR {self.inside('enddate')} OR {self.inside('enddate', self.p.prior)})")

    # -- extracts derived from the test tables -------------------------------------------------
    @staticmethod
    def source_ctes() -> str:
        k = "k"
        return f"""
base AS (
  SELECT o.o_orderkey AS k, o.o_custkey, o.o_totalprice, o.o_orderdate, o.o_orderpriority, o.o_orderstatus,
         c.c_nationkey
  FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey),
policy_k AS (
  SELECT k,
    lpad(CAST(k AS VARCHAR), 22, '0') AS proposalno,
    'P' || CAST(k AS VARCHAR) AS policyno,
    CASE WHEN k % 2 = 0 THEN 'DAA' ELSE 'DZA' END AS riskcode,
    CAST(c_nationkey AS VARCHAR) AS comcode,
    CASE WHEN k % 89 = 0 THEN NULL ELSE {_txt(_days('o_orderdate', 'k % 11 - 5'), k)} END AS underwriteenddate,
    {_txt('o_orderdate', k)} AS startdate,
    CASE WHEN k % 101 = 0 THEN '2013' WHEN k % 103 = 0 THEN '2013/5' ELSE
      ({_txt(_days('o_orderdate', 'k % 40 - 20'), k)}) || CASE WHEN k % 107 = 0 THEN '+08:00' ELSE '' END END AS operatedate,
    {_pick('k % 6', UNDERWRITE_FLAGS)} AS underwriteflag,
    CASE WHEN o_orderpriority = '1-URGENT' THEN '1' WHEN o_orderpriority = '2-HIGH' THEN '2' ELSE '0' END AS coinsflag,
    o_totalprice AS sumpremium,
    o_totalprice * 10 AS sumamount,
    o_orderstatus AS inputflag,
    substring(o_orderpriority, 1, 1) AS businessnature,
    'AG' || CAST(o_custkey % 50 AS VARCHAR) AS agentcode,
    {_txt(_days('o_orderdate', '365'), k)} AS enddate,
    CASE WHEN k % 97 = 0 THEN NULL ELSE
      CAST(k % 4 AS VARCHAR) || '00' || CASE WHEN k % 5 = 0 THEN '1' ELSE '0' END || '0'
      || CASE WHEN k % 10 = 0 THEN '1' ELSE '0' END || CASE WHEN k % 7 = 0 THEN 'N' ELSE 'Y' END END AS othflag,
    CASE WHEN k % 4 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS contractno,
    CASE WHEN k % 83 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS insuredcode
  FROM base),
policy AS (SELECT * EXCLUDE (k) FROM policy_k),
apps AS (SELECT l_orderkey AS k, l_linenumber AS n, min(l_shipdate) AS sd FROM lineitem GROUP BY l_orderkey, l_linenumber),
copy_endorse AS (
  SELECT a.k, 'A' || CAST(a.k AS VARCHAR) || '-' || CAST(a.n AS VARCHAR) AS applyno, p.policyno, p.startdate,
         p.underwriteenddate, p.othflag, p.sumpremium, p.sumamount, p.coinsflag, p.underwriteflag,
         CAST(a.n AS DOUBLE) AS endorsetimes, p.riskcode
  FROM apps a JOIN policy_k p ON a.k = p.k),
copy_all AS (
  SELECT k, 'A' || CAST(k AS VARCHAR) || '-0' AS applyno, policyno, startdate, underwriteenddate, othflag,
         sumpremium, sumamount, coinsflag, underwriteflag, CAST(0.0 AS DOUBLE) AS endorsetimes, riskcode
  FROM policy_k
  UNION ALL SELECT * FROM copy_endorse),
copymain AS (
  SELECT applyno, policyno, startdate, underwriteenddate, endorsetimes, othflag, sumpremium, sumamount, coinsflag,
         underwriteflag FROM copy_all),
head_k AS (
  SELECT k, 'A' || CAST(k AS VARCHAR) || '-' || CAST(n AS VARCHAR) AS applyno,
    CASE WHEN (k + 2 * n) % 9 < 8 THEN '1' ELSE '2' END AS underwriteflag,
    {_txt(_days('sd', 'n % 3'), k)} AS validdate,
    {_pick('(k + n) % 8', ENDORSEMENT_TYPES)} AS endortype,
    {_txt(_days('sd', '-1'), k)} AS underwriteenddate
  FROM apps),
head AS (SELECT * EXCLUDE (k) FROM head_k),
fee AS (
  SELECT 'A' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS applyno,
    l_extendedprice * (l_discount - 0.05) AS chgpremium,
    (l_quantity - 25) * 1000 AS chgamount,
    'CNY' AS currency
  FROM lineitem),
item_base AS (
  SELECT k, 'A' || CAST(k AS VARCHAR) || '-' || CAST(n AS VARCHAR) AS applyno,
    CASE WHEN k % 13 = 0 THEN NULL WHEN n % 3 = 0 THEN 'N' ELSE 'Y' END AS calc1,
    'CNY' AS currency, CAST(n AS DOUBLE) * 100.0 AS chgamount, CAST(n AS DOUBLE) * 1.5 AS chgpremium,
    CASE WHEN k % 11 = 0 THEN 'X' ELSE 'P' END || CAST(k AS VARCHAR) AS policyno
  FROM (SELECT k, n FROM apps UNION ALL SELECT k, 0 AS n FROM policy_k) all_apps),
itemkind AS (
  SELECT applyno, calc1 AS calculateflag, currency, chgamount, chgpremium, policyno FROM item_base
  UNION ALL
  SELECT applyno, 'Y' AS calculateflag, currency, chgamount, chgpremium, policyno FROM item_base WHERE k % 17 = 0),
copycoins AS (SELECT {_unless('k % 3 = 0', 'applyno')} AS applyno, {_PERCENT} AS coinsrate FROM copy_all),
policy_coins AS (SELECT {_unless('k % 3 = 0', 'proposalno')} AS proposalno, {_PERCENT} / 100.0 AS coinsrate FROM policy_k),
company AS (
  SELECT CAST(n.n_nationkey AS VARCHAR) AS comcode, n.n_name AS comcname,
    'N' || CAST(n.n_nationkey AS VARCHAR) AS comshortname, lower(n.n_name) AS comename, r.r_name AS addresscname,
    lower(r.r_name) AS addressename, CAST(n.n_regionkey AS VARCHAR) AS comtype, '2' AS comlevel, '1' AS comkind
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey),
vehicle AS (
  SELECT {_unless('o_orderkey % 8 <> 0', "lpad(CAST(o_orderkey AS VARCHAR), 22, '0')")} AS proposalno,
    'C' || CAST(o_orderkey AS VARCHAR) AS carid,
    'L' || CAST(o_orderkey % 100000 AS VARCHAR) AS licenseno,
    'V' || lpad(CAST(o_orderkey AS VARCHAR), 16, '0') AS vinno,
    '02' AS licensetype,
    substring(o_orderpriority, 1, 1) AS usenaturecode,
    CAST(o_custkey * 10 AS VARCHAR) AS purchaseprice,
    CAST(o_orderkey % 7 + 2 AS VARCHAR) AS seatcount,
    '0' AS toncount, '1.6' AS exhaustscale,
    CAST(o_orderkey % 15 AS VARCHAR) AS useyears,
    'F42' AS clausetype, 'A0' AS carkindcode
  FROM orders),
policy2 AS (
  SELECT policyno, proposalno, startdate, enddate, underwriteenddate, comcode, riskcode, sumpremium, sumamount
  FROM policy),
head2 AS (
  SELECT applyno, endortype, 'P' || CAST(k AS VARCHAR) AS policyno,
    CASE WHEN k % 2 = 0 THEN 'DAA' ELSE 'DZA' END AS riskcode, underwriteenddate, underwriteflag, validdate
  FROM head_k),
fee2 AS (SELECT applyno, chgamount, chgpremium, currency FROM fee),
profit2 AS (
  SELECT {_unless('o_orderkey % 5 <> 1', "lpad(CAST(o_orderkey AS VARCHAR), 22, '0')")} AS proposalno, o_totalprice * 0.12 AS profit,
         CAST(0.12 AS DOUBLE) AS profitrate
  FROM orders),
vehicle2 AS (SELECT proposalno, licenseno FROM vehicle),
pmain2 AS (SELECT applyno, sumpremium * 0.01 AS chgpremium, coinsflag, othflag, riskcode FROM copy_endorse),
itemkind2 AS (SELECT applyno, calculateflag, chgamount, chgpremium, currency, policyno FROM itemkind),
claims AS (
  SELECT 'P' || CAST(l_orderkey AS VARCHAR) AS policyno, {_txt('l_shipdate', 'l_orderkey')} AS claimtime,
         CASE WHEN l_returnflag = 'R' THEN l_extendedprice * l_discount ELSE 0.0 END AS paid
  FROM lineitem)"""

    # -- typed records ----------------------------------------------------------------------
    @staticmethod
    def record_ctes() -> str:
        return f"""
copymain_r AS (
  SELECT applyno, policyno, {parse('startdate')} AS startdate, {parse('underwriteenddate')} AS policyunderwriteenddate,
    endorsetimes, othflag, sumpremium, sumamount,
    {flag_in('coinsflag', 0, '1', '2')} AS coinsflag,
    {flag_in('othflag', 6, 'Y')} AS chargeflag,
    greatest({parse('startdate')}, {parse('underwriteenddate')}) AS policyValiddate,
    {flag_in('underwriteflag', 0, '1', '3')} AS policyunderwriteflag,
    {flag_in('othflag', 3, '0')} AS cancelflag
  FROM copymain),
head_r AS (
  SELECT applyno, {flag_in('underwriteflag', 0, '1', '3')} AS underwriteflag, {parse('validdate')} AS validdate,
    endortype, {parse('underwriteenddate')} AS prppunderwriteenddate,
    greatest({parse('validdate')}, {parse('underwriteenddate')}) AS maxValiddateAndWritedate,
    COALESCE(CAST((contains(endortype, '21') OR contains(endortype, '10')) AS INTEGER), 0) AS tuibaoflag,
    COALESCE(CAST(endortype IN ('19', 'N1') AS INTEGER), 0) AS policycancelflag,
    COALESCE(CAST(NOT ({trimmed('endortype')} IN ('19', 'N1', '21', '10')) AS INTEGER), 0) AS decreaseNotcancelflag
  FROM head),
copycoins_r AS (SELECT applyno, coinsrate / 100 AS coinsrate, coinsrate AS percent FROM copycoins),
policy_r AS (
  SELECT proposalno, policyno, riskcode, comcode,
    {parse('underwriteenddate')} AS underwriteenddate, {parse('startdate')} AS startdate,
    greatest({parse('underwriteenddate')}, {parse('startdate')}) AS validdate,
    {parse('operatedate')} AS operatedate,
    COALESCE(CAST(underwriteflag IN ('1', '3') AS INTEGER), 0) AS underwriteflag,
    {flag_in('othflag', 6, 'Y')} AS chargeflag,
    {flag_in('othflag', 3, '1')} AS cancelflag,
    {flag_in('coinsflag', 0, '1', '2')} AS coinsflag,
    sumpremium, sumamount,
    {flag_in('othflag', 5, '1')} AS stopflag,
    inputflag, businessnature, agentcode,
    {parse('enddate')} AS enddate,
    CASE WHEN substring(othflag, 1, 1) = '0' THEN 0 WHEN substring(othflag, 1, 1) = '1' THEN 1
         WHEN substring(othflag, 1, 1) = '2' THEN 2 ELSE 0 END AS continueflag,
    othflag,
    greatest({parse('underwriteenddate')}, {parse('operatedate')}) AS maxOperatedateUnderwritedate,
    greatest({parse('underwriteenddate')}, {parse('startdate')}) AS maxStartdateUnderwritedate,
    CAST(contractno IS NULL AS INTEGER) AS Tuancheflag
  FROM policy)"""

    # -- pipelines --------------------------------------------------------------------------
    def endorsement_ctes(self) -> str:
        return f"""
ce_joined AS (SELECT * FROM copymain_r LEFT JOIN head_r USING (applyno) WHERE {self.fil1()}),
endo_raw AS (
  SELECT j.*, f.chgpremium, f.chgamount, f.currency, i.calculateflag, c.coinsrate, c.percent
  FROM ce_joined j LEFT JOIN fee f USING (applyno) LEFT JOIN itemkind i USING (applyno)
  LEFT JOIN copycoins_r c USING (applyno)),
endo_rows AS (
  SELECT * REPLACE (COALESCE(coinsrate, 1.0) AS coinsrate, COALESCE(percent, 100.0) AS percent, COALESCE(tuibaoflag, 0) AS tuibaoflag,
    COALESCE(policycancelflag, 0) AS policycancelflag, COALESCE(decreaseNotcancelflag, 0) AS decreaseNotcancelflag,
    COALESCE(chgpremium, 0.0) AS chgpremium, COALESCE(underwriteflag, 0) AS underwriteflag,
    COALESCE(chgamount, 0.0) AS chgamount)
  FROM endo_raw),
endo_gates AS (
  SELECT *,
    (underwriteflag = 1 AND chargeflag = 1) AS g_ok,
    {self.inside('policyValiddate')} AS t_policy,
    {self.endorse_in('maxValiddateAndWritedate', 'startdate')} AS t_endorse,
    {self.surrender_in('maxValiddateAndWritedate', 'validdate', 'prppunderwriteenddate', 'startdate')} AS t_surr,
    COALESCE(calculateflag = 'Y', FALSE) AS calc_y,
    (endorsetimes = 0 AND policyunderwriteflag = 1 AND chargeflag = 1 AND cancelflag = 1) AS orig_ok
  FROM endo_rows)"""

    @staticmethod
    def _own(x: str) -> str:
        return f"(CASE WHEN coinsflag = 1 THEN COALESCE({x}, 0.0) * coinsrate ELSE COALESCE({x}, 0.0) END)"

    @staticmethod
    def _own_dec(x: str) -> str:
        # the definition in exact decimals: amount times percent over 100, one row at a time
        m = f"CAST(round_even(COALESCE({x}, 0.0), 6) AS DECIMAL(20,6))"
        return (f"(CASE WHEN coinsflag = 1 THEN {m} * CAST(CAST(percent AS DECIMAL(14,8)) * 0.01 AS DECIMAL(16,10)) "
                f"ELSE {m} END)")

    def endorsement_indicator_exprs(self, exact: bool) -> dict[str, str]:
        own = self._own_dec if exact else self._own
        z = "CAST(0 AS DECIMAL(38,16))" if exact else "0.0"
        inc = "g_ok AND t_endorse"
        sur = "g_ok AND tuibaoflag = 1 AND t_surr"
        can = "g_ok AND policycancelflag = 1 AND t_surr"
        oth = "g_ok AND decreaseNotcancelflag = 1 AND t_surr"
        return {
            "rawpremium": f"CASE WHEN orig_ok AND t_policy THEN {own('sumpremium')} ELSE {z} END",
            "increasecount": f"CASE WHEN chgpremium > 0 AND {inc} THEN 1 ELSE 0 END",
            "decreasecount": f"CASE WHEN chgpremium < 0 AND {inc} THEN 1 ELSE 0 END",
            "increasepremium": f"CASE WHEN chgpremium > 0 AND {inc} THEN {own('chgpremium')} ELSE {z} END",
            "decreasepremium": f"CASE WHEN chgpremium < 0 AND {inc} THEN {own('chgpremium')} ELSE {z} END",
            "increaseamount": f"CASE WHEN calc_y AND chgamount > 0 AND {inc} THEN {own('chgamount')} ELSE {z} END",
            "decreaseamount": f"CASE WHEN calc_y AND chgamount < 0 AND {inc} THEN {own('chgamount')} ELSE {z} END",
            "tuibaocount": f"CASE WHEN {sur} THEN 1 ELSE 0 END",
            "tuibaoamount": f"CASE WHEN calc_y AND {sur} THEN {own('chgamount')} ELSE {z} END",
            "tuibaopremium": f"CASE WHEN {sur} THEN {own('chgpremium')} ELSE {z} END",
            "policycancelcount": f"CASE WHEN {can} THEN 1 ELSE 0 END",
            "policycancelamount": f"CASE WHEN calc_y AND {can} THEN {own('chgamount')} ELSE {z} END",
            "policycancelpremium": f"CASE WHEN {can} THEN {own('chgpremium')} ELSE {z} END",
            "decreasenotcancelcount": f"CASE WHEN {oth} THEN 1 ELSE 0 END",
        }

    def rollup_cte(self) -> str:
        exprs = self.endorsement_indicator_exprs(exact=True)
        per_row = ",\n    ".join(f"{v} AS {k}" for k, v in exprs.items())
        aggs = []
        for name in exprs:
            if name in ("policycancelcount", "decreasenotcancelcount"):
                aggs.append(f"MAX({name}) AS {name}")
            elif name.endswith("count"):
                aggs.append(f"CAST(SUM({name}) AS BIGINT) AS {name}")
            else:
                aggs.append(f"CAST(SUM({name}) AS DOUBLE) AS {name}")
        return f"""
endo_ind AS (SELECT policyno,
    {per_row}
  FROM endo_gates),
rollup AS (SELECT policyno, {", ".join(aggs)} FROM endo_ind GROUP BY policyno)"""

    def policy_ctes(self) -> str:
        p = self.p
        approved = "underwriteflag = 1 AND chargeflag = 1 AND cancelflag = 0"
        own_p, own_a = self._own("sumpremium"), self._own("sumamount")
        return f"""
policy_f AS (SELECT * FROM policy_r WHERE {self.fil2()}),
policy_s AS (
  SELECT pf.*, COALESCE(pc.coinsrate, 0.5) AS coinsrate
  FROM policy_f pf LEFT JOIN policy_coins pc ON pf.proposalno = pc.proposalno),
policy_i AS (
  SELECT ps.*, v.* EXCLUDE (proposalno), co.* EXCLUDE (comcode),
    CASE WHEN {approved} AND {self.inside('maxOperatedateUnderwritedate')} THEN {own_p} ELSE 0.0 END AS qiandanbaofei,
    CASE WHEN {approved} AND {self.inside('maxStartdateUnderwritedate')} THEN {own_p} ELSE 0.0 END AS baofeishouru,
    CASE WHEN {approved} AND {self.inside('maxStartdateUnderwritedate')} THEN {own_a} ELSE 0.0 END AS baoxianjine,
    CASE WHEN {self.inside('enddate')} AND underwriteflag = 1 AND cancelflag = 0 THEN 1 ELSE 0 END AS zhongbaoshuliang,
    CASE WHEN ps.policyno IS NOT NULL THEN '{p.start.strftime('%Y-%m')}' END AS timeYearMonth
  FROM policy_s ps LEFT JOIN vehicle v ON ps.proposalno = v.proposalno
  LEFT JOIN company co ON ps.comcode = co.comcode)"""

    def with_all(self, body: str) -> str:
        return ("WITH" + self.source_ctes() + "," + self.record_ctes() + "," + self.endorsement_ctes() + ","
                + self.rollup_cte() + "," + self.policy_ctes() + "\n" + body)
