"""Typed extracts: parsed once, kept as Parquet, read by window.

``write_ingested`` parses the dates of every extract once and writes it to a
shared folder; ``read_ingested`` gives the same rows as ``Sources`` for any
number of jobs.  Extracts with dates are laid out by time: ``last_month``
(yyyymm of a row's latest date) is the partition folder, and rows within a
file are in order of ``first_date`` (its earliest date).  ``in_reach`` turns
a reporting window into conditions on these two, so a job reads the folders
and row groups that its window can touch and not the whole history.

A month that holds most rows is written by many tasks, small months share
one (``REBALANCE``, which needs no sampling pass, so text is parsed once).
Text that is no date is null, as everywhere; a row without any date is kept,
in a folder of its own that no window reads.  An empty extract is written as
a folder without rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from policylens import schemas
from policylens.functions.dates import typed_date
from policylens.operators.period import Period
from policylens.session import scratch_path
from policylens.sources.adapter import EXTRACT_SCHEMA_NAMES, Sources

# Date columns that are parsed at ingest.  The other extracts have no dates,
# or are checked for their width by the older job and stay as they are.
DATES = {
    "policy": ["underwriteenddate", "startdate", "operatedate", "enddate"],
    "copymain": ["startdate", "underwriteenddate"],
    "head": ["validdate", "underwriteenddate"],
    "claims": ["claimtime"],
}
# Extracts that a window can be asked of by themselves, laid out by time.  An
# endorsement head counts whatever its dates are if its policy is in the window.
BY_TIME = ("policy", "copymain", "claims")
FIRST, MONTH = "first_date", "last_month"


def ingested_schema(name: str) -> T.StructType:
    fields = [T.StructField(f.name, T.TimestampNTZType() if f.name in DATES.get(name, ()) else f.dataType)
              for f in getattr(schemas, EXTRACT_SCHEMA_NAMES[name]).fields]
    if name in BY_TIME:
        fields += [T.StructField(FIRST, T.DateType()), T.StructField(MONTH, T.IntegerType())]
    return T.StructType(fields)


def _month(value: datetime) -> int:
    return value.year * 100 + value.month


def typed(df: DataFrame, name: str) -> DataFrame:
    """The extract with its dates parsed, and the two columns of its layout."""
    df = df.withColumns({c: typed_date(df, c) for c in DATES.get(name, ())})
    if name not in BY_TIME:
        return df
    dates = [F.col(c) for c in DATES[name]]
    first, last = (F.least(*dates), F.greatest(*dates)) if len(dates) > 1 else (dates[0], dates[0])
    return df.withColumns({FIRST: first.cast("date"), MONTH: F.year(last) * 100 + F.month(last)})


def write_ingested(src: Sources, base: str) -> None:
    """Each extract of ``src`` read and parsed once, into its folder of ``base``."""
    for name, df in src.__dict__.items():
        if df is None:
            continue
        rows = typed(df.select(*getattr(schemas, EXTRACT_SCHEMA_NAMES[name]).names), name)
        path = f"{base.rstrip('/')}/{name}"
        if name in BY_TIME:
            rows.hint("rebalance", MONTH).sortWithinPartitions(MONTH, FIRST).write.partitionBy(MONTH).parquet(path)
        else:
            rows.write.parquet(path)


def read_ingested(spark: SparkSession, base: str, names: list[str]) -> Sources:
    """The extracts ``names`` of a folder that ``write_ingested`` wrote."""
    return Sources(**{name: spark.read.schema(ingested_schema(name)).parquet(f"{base.rstrip('/')}/{name}")
                      if name in names else None for name in EXTRACT_SCHEMA_NAMES})


def ingested(src: Sources) -> Sources:
    """The extracts of ``src`` by way of a new folder: a job counts heavy keys and
    joins on single columns of it, and no text is parsed again."""
    given = [name for name, df in src.__dict__.items() if df is not None]
    spark = getattr(src, given[0]).sparkSession
    base = scratch_path(spark, "extracts")
    write_ingested(src, base)
    return read_ingested(spark, base, given)


def in_reach(df: DataFrame, *windows: Period, since_start: bool = True) -> DataFrame:
    """``df`` without rows that have no date in any of ``windows``, as far as the
    layout shows; an extract that was not ingested stays whole.  The exact test
    comes after it.  ``since_start=False`` keeps rows from before the windows."""
    if MONTH not in df.columns:
        return df
    keep = None
    for w in windows:
        one = F.col(FIRST) <= F.lit(w.end.date())
        if since_start:
            one = (F.col(MONTH) >= _month(w.start)) & one
        keep = one if keep is None else keep | one
    return df.where(keep)
