"""Date column builders.

Extract dates are text: ``yyyy-MM-dd HH:mm:ss[.fff]``, the same with ``/``,
or a bare date, with white space around or without.  They are parsed to
``TIMESTAMP_NTZ`` so no session time zone enters any comparison; all other
text (a year alone, an offset, a day that does not exist) becomes null.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from policylens.functions.flags import trimmed
from policylens.functions.util import as_col


# Fixed value: the accepted shapes, after "/" became "-".
DATE_SHAPE = r"^[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}( [0-9]{1,2}:[0-9]{1,2}:[0-9]{1,2}([.][0-9]{1,9})?)?$"


def parse_ts(s: Column | str) -> Column:
    """Text → timestamp_ntz: '/' becomes '-', text of another shape → null."""
    text = F.replace(trimmed(s), F.lit("/"), F.lit("-"))
    return F.when(text.rlike(DATE_SHAPE), text).try_cast("timestamp_ntz")


def typed_date(df: DataFrame, name: str) -> Column:
    """A date column of ``df``: as it is if it is typed (an ingested extract), its
    text parsed if not."""
    return F.col(name) if isinstance(df.schema[name].dataType, T.TimestampNTZType) else parse_ts(name)


def later(d1: Column | str, d2: Column | str) -> Column:
    """Later of two timestamps, skipping nulls (null only when both are null)."""
    return F.greatest(as_col(d1), as_col(d2))


def later_of_text(s1: Column | str, s2: Column | str) -> Column:
    """Parse two date texts and keep the later one."""
    return later(parse_ts(s1), parse_ts(s2))


def pick_date(tag: Column | str, d1: Column | str, d2: Column | str) -> Column:
    """``d1`` where the boolean ``tag`` is true, else ``d2`` (null tag → ``d2``)."""
    return F.when(as_col(tag), as_col(d1)).otherwise(as_col(d2))


def year_month_of_window(key: Column | str, window_start: datetime) -> Column:
    """The reporting window's ``yyyy-MM`` for rows with a key, null otherwise."""
    return F.when(as_col(key).isNotNull(), F.lit(window_start.strftime("%Y-%m")))


def ts_literal(value: datetime) -> Column:
    """A timestamp_ntz literal (folded by Catalyst)."""
    return F.lit(value.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")
