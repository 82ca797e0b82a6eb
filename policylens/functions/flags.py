"""Flag column builders (packed positional flag strings and code sets).

Each builder returns a null-free ``int`` column.  Inputs that made the
original row functions throw (null text, an index past the end) give 0.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from policylens.functions.util import as_col


# Fixed value: the characters a trim removes, everything up to the space.
TRIMMED = "".join(map(chr, range(33)))


def trimmed(s: Column | str) -> Column:
    return F.btrim(as_col(s), F.lit(TRIMMED))


def char_at(s: Column | str, index: int) -> Column:
    """Character at 0-based ``index``; null for null text, "" past the end."""
    return F.substring(as_col(s), index + 1, 1)


def flag_in(s: Column | str, index: int, *values: str) -> Column:
    """1 when the trimmed character at ``index`` is one of ``values``, else 0."""
    return F.coalesce(trimmed(char_at(s, index)).isin(*values).cast("int"), F.lit(0))


def is_null_flag(s: Column | str) -> Column:
    """1 for a missing value (individual contract), 0 for a present one (fleet)."""
    return as_col(s).isNull().cast("int")


def new_renew_transfer(s: Column | str, index: int, new: str, renew: str, transfer: str) -> Column:
    """0 new, 1 renewal, 2 transfer, from the untrimmed character at ``index``; 0 otherwise."""
    ch = char_at(s, index)
    return F.when(ch == F.lit(new), 0).when(ch == F.lit(renew), 1).when(ch == F.lit(transfer), 2).otherwise(0)


def contains_any(s: Column | str, *parts: str) -> Column:
    """1 when the text contains any of ``parts`` as a substring, else 0."""
    c = as_col(s)
    hit = F.lit(False)
    for p in parts:
        hit = hit | F.contains(c, F.lit(p))
    return F.coalesce(hit.cast("int"), F.lit(0))


def in_set(s: Column | str, values: Iterable[str]) -> Column:
    """1 when the untrimmed value is exactly one of ``values``, else 0."""
    return F.coalesce(as_col(s).isin(*list(values)).cast("int"), F.lit(0))


def not_in_set_trimmed(s: Column | str, values: Iterable[str]) -> Column:
    """1 when the trimmed value is not one of ``values``; 0 for a member or null."""
    return F.coalesce((~trimmed(s).isin(*list(values))).cast("int"), F.lit(0))
