"""Money column builders.

Per-row amounts stay ``double``.  Amounts that are summed are exact: a
money addend is the nearest whole number of micro-units (10^-6, ties to
even), summed as a decimal; a share is a percentage with 8 decimals, its sum
over any number of rows a whole number of percents and a fraction of one.
An amount times such a sum is kept as these two parts, each exact and wide
enough for any corpus, and only the last sum is put together.  Sums
therefore do not depend on the order in which executors add them, and no
number of rows ends the job.  Aggregated results are returned as ``double``.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from policylens.functions.util import as_col

MONEY = T.DecimalType(20, 6)       # one money addend
MONEY_SUM = T.DecimalType(26, 6)   # a sum of addends times a row multiplicity
PERCENT = T.DecimalType(20, 8)     # a share in percent
COUNT = T.DecimalType(20, 0)       # a row count, or a product of counts
WHOLE = T.DecimalType(38, 8)       # MONEY_SUM times whole percents, in the unit of the amount
PART = T.DecimalType(36, 16)       # MONEY_SUM times a fraction of a percent
EXACT_BELOW = Decimal(10 ** 19)   # sums below this are put together without rounding


def co_insured(x: Column | str, coinsflag: Column | str, rate: Column | str) -> Column:
    """Own share of an amount: ``x * rate`` for a co-insured row (flag 1), else ``x``."""
    return F.when(as_col(coinsflag) == 1, as_col(x) * as_col(rate)).otherwise(as_col(x))


def micros(x: Column | str) -> Column:
    """A null-free money addend (null → 0) in whole micro-units."""
    return F.rint(F.coalesce(as_col(x).cast("double"), F.lit(0.0)) * 1e6).cast("long")


def from_micros(m: Column | str) -> Column:
    """Whole micro-units → an exact ``MONEY_SUM`` decimal."""
    return (as_col(m).cast(T.DecimalType(29, 0)) * F.lit(Decimal("0.000001"))).cast(MONEY_SUM)


def money(x: Column | str) -> Column:
    """A null-free money addend as an exact decimal (micro-unit rounding)."""
    return from_micros(micros(x))


def percent_to_fraction(x: Column | str) -> Column:
    return as_col(x) / 100


def sum_micros(m: Column | str) -> Column:
    """The sum of whole micro-units, for any number of rows."""
    return F.sum(as_col(m).cast(T.DecimalType(19, 0)))


def whole_and_part(percents: Column) -> tuple[Column, Column]:
    """A sum of percents as whole percents and the fraction of one."""
    whole = F.floor(percents)
    return whole.cast(COUNT), (percents - whole).cast(T.DecimalType(8, 8))


def shared_parts(amount: Column, whole: Column, part: Column) -> tuple[Column, Column]:
    """``amount`` (``MONEY_SUM``) times percents, over 100, in the same two parts."""
    hundredth = F.lit(Decimal("0.01"))
    return ((amount * whole).cast(T.DecimalType(35, 6)) * hundredth).cast(WHOLE), (amount * part * hundredth).cast(PART)


def sum_of_parts(whole: str, part: str) -> Column:
    """The sum of amounts kept in two parts, as ``double``."""
    a, b = F.sum(whole), F.sum(part)
    exact = (a.cast(T.DecimalType(28, 8)) + b.cast(PART)).cast("double")
    return F.when(F.abs(a) < EXACT_BELOW, exact).otherwise(a.cast("double") + b.cast("double"))
