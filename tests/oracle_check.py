"""Run registered queries in Spark and their oracle SQL in DuckDB, and compare.

Usage: python tests/oracle_check.py [sf_dir] [name ...]
Compares row count, column names, and the multiset of rows (floats rounded
to 6 significant decimals, and also exactly).
"""

from __future__ import annotations

import sys
import time

import duckdb
import pandas as pd

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations"]


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(df: pd.DataFrame, exact: bool) -> list[tuple]:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_numeric_dtype(df[c]) and not pd.api.types.is_bool_dtype(df[c]):
            df[c] = df[c].astype("float64")
        if pd.api.types.is_float_dtype(df[c]) and not exact:
            df[c] = df[c].round(6)
        if pd.api.types.is_datetime64_any_dtype(df[c]):
            df[c] = df[c].astype("datetime64[us]").astype(str)
    rows = [tuple(None if (isinstance(v, float) and v != v) or v is None or v is pd.NaT else v for v in r)
            for r in df.itertuples(index=False)]
    return sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark_df: pd.DataFrame, duck_df: pd.DataFrame) -> tuple[bool, bool, str]:
    if sorted(spark_df.columns) != sorted(duck_df.columns):
        return False, False, f"columns differ: {sorted(spark_df.columns)} vs {sorted(duck_df.columns)}"
    if len(spark_df) != len(duck_df):
        return False, False, f"rows {len(spark_df)} vs {len(duck_df)}"
    approx = _norm(spark_df, False) == _norm(duck_df, False)
    exact = _norm(spark_df, True) == _norm(duck_df, True)
    msg = ""
    if not approx:
        a, b = _norm(spark_df, False), _norm(duck_df, False)
        diff = [(x, y) for x, y in zip(a, b) if x != y][:2]
        msg = f"first diffs: {diff}"
    return approx, exact, msg


def main(argv):
    sys.path.insert(0, ".")
    from __spark_entry__ import oracle_sql, queries
    from policylens.session import local_session

    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    names = argv[2:] or list(queries())
    spark = local_session(8, 8)
    con = duck(sf_dir)
    sqls = oracle_sql()
    ok_all = True
    for name in names:
        t0 = time.time()
        sdf = queries()[name](spark, sf_dir).toPandas()
        t1 = time.time()
        if name not in sqls:
            print(f"{name:32s} rows={len(sdf)} (no oracle) spark={t1 - t0:.1f}s")
            continue
        ddf = con.execute(sqls[name]).fetchdf()
        approx, exact, msg = compare(sdf, ddf)
        ok_all &= approx
        print(f"{name:32s} rows={len(sdf)} approx={approx} exact={exact} spark={t1 - t0:.1f}s "
              f"duck={time.time() - t1:.1f}s {msg}"[:600])
    return 0 if ok_all else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv))
