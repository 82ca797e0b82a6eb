"""The rules as SQL functions, for SQL users (UDF-1..3).

The bodies state in SQL what the column builders build; a test holds the two
against each other on hand-made edge rows.

Registered as SQL user-defined functions (``CREATE TEMPORARY FUNCTION ...
RETURN <expr>``): Catalyst inlines their bodies, so calls stay inside
whole-stage code generation and no Python worker is involved.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from policylens.functions.dates import DATE_SHAPE

_INSIDE = "coalesce({d} > s AND {d} < e, false)"

SQL_FUNCTIONS = {
    "pl_trim": ("t STRING", "STRING", r"regexp_replace(t, '^[\\x00-\\x20]+|[\\x00-\\x20]+$', '')"),
    "pl_flag_in": (
        "t STRING, i INT, members ARRAY<STRING>", "INT",
        "coalesce(cast(array_contains(members, pl_trim(substring(t, i + 1, 1))) AS INT), 0)"),
    "pl_char_at": ("s STRING, i INT", "STRING", "substring(s, i + 1, 1)"),
    "pl_parse_ts": ("s STRING", "TIMESTAMP_NTZ", 
        f"CASE WHEN replace(pl_trim(s), '/', '-') RLIKE '{DATE_SHAPE}' "
        "THEN try_cast(replace(pl_trim(s), '/', '-') AS TIMESTAMP_NTZ) END"),
    "pl_later": ("a TIMESTAMP_NTZ, b TIMESTAMP_NTZ", "TIMESTAMP_NTZ", "greatest(a, b)"),
    "pl_in_window": (
        "d TIMESTAMP_NTZ, s TIMESTAMP_NTZ, e TIMESTAMP_NTZ", "BOOLEAN", _INSIDE.format(d="d")),
    "pl_own_share": ("x DOUBLE, flag INT, rate DOUBLE", "DOUBLE", "CASE WHEN flag = 1 THEN x * rate ELSE x END"),
    # premium or sum insured of an approved, charged, kept policy dated in the window
    "pl_own_amount_in": (
        "x DOUBLE, coins INT, rate DOUBLE, underwritten INT, charged INT, cancelled INT, d TIMESTAMP_NTZ, "
        "s TIMESTAMP_NTZ, e TIMESTAMP_NTZ", "DOUBLE",
        "CASE WHEN underwritten = 1 AND charged = 1 AND cancelled = 0 AND " + _INSIDE.format(d="d")
        + " THEN CASE WHEN coins = 1 THEN coalesce(x, 0D) * rate ELSE coalesce(x, 0D) END ELSE 0D END"),
    # an approved, kept policy that ends in the window
    "pl_expiring_in": (
        "d TIMESTAMP_NTZ, underwritten INT, cancelled INT, s TIMESTAMP_NTZ, e TIMESTAMP_NTZ", "INT",
        "CASE WHEN underwritten = 1 AND cancelled = 0 AND " + _INSIDE.format(d="d") + " THEN 1 ELSE 0 END"),
    "pl_year_month": (
        "k STRING, s TIMESTAMP_NTZ", "STRING", "CASE WHEN k IS NOT NULL THEN date_format(s, 'yyyy-MM') END"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions in this session."""
    for name, (params, returns, body) in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({params}) RETURNS {returns} RETURN {body}")
    return list(SQL_FUNCTIONS)
