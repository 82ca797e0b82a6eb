"""Reporting window and the window predicates.

All bounds are strict: a date on either bound is outside.  Every predicate is
a null-free boolean column (a null date is outside), so it composes with
``&``/``|`` without three-valued surprises and can be evaluated right after
the scan.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from policylens.functions.dates import ts_literal
from policylens.functions.util import as_col


def _to_dt(value: datetime | str) -> datetime:
    if isinstance(value, datetime):
        return value
    return datetime.fromisoformat(value.replace("/", "-"))


@dataclass(frozen=True)
class Period:
    """Window ``(start, end)``; ``prior_*`` is the optional earlier window used
    by the policy filter for expiring policies (defaults to the same window)."""

    start: datetime
    end: datetime
    prior_start: datetime | None = None
    prior_end: datetime | None = None

    @classmethod
    def of(cls, start: datetime | str, end: datetime | str,
           prior_start: datetime | str | None = None, prior_end: datetime | str | None = None) -> Period:
        return cls(_to_dt(start), _to_dt(end),
                   None if prior_start is None else _to_dt(prior_start),
                   None if prior_end is None else _to_dt(prior_end))

    @property
    def prior(self) -> Period:
        return Period(self.prior_start or self.start, self.prior_end or self.end)

    # PRD-1
    def contains(self, d: Column | str) -> Column:
        """start < d < end; null → false."""
        d = as_col(d)
        return F.coalesce((d > ts_literal(self.start)) & (d < ts_literal(self.end)), F.lit(False))

    # PRD-2
    def endorsement_in(self, max_valid_write: Column | str, policy_start: Column | str) -> Column:
        """The endorsement's later of valid/underwrite date is in the window and
        the policy started before the window end."""
        start = as_col(policy_start)
        return self.contains(max_valid_write) & F.coalesce(start < ts_literal(self.end), F.lit(False))

    # PRD-3
    def surrender_in(self, max_valid_write: Column | str, validdate: Column | str,
                     underwriteenddate: Column | str, policy_start: Column | str) -> Column:
        """All four dates in the window, and valid and underwrite dates after the policy start."""
        start, valid, uw = as_col(policy_start), as_col(validdate), as_col(underwriteenddate)
        return (
            self.contains(max_valid_write) & self.contains(uw) & self.contains(valid) & self.contains(start)
            & F.coalesce((uw > start) & (valid > start), F.lit(False))
        )


# FIL-1
def endorsement_row_filter(period: Period) -> Column:
    """Keep a (copy main ⟕ head) row when the policy, the endorsement or the
    surrender window test holds.  Column names are those of the joined row."""
    return (
        period.contains("policyValiddate")
        | period.endorsement_in("maxValiddateAndWritedate", "startdate")
        | period.surrender_in("maxValiddateAndWritedate", "validdate", "prppunderwriteenddate", "startdate")
    )


def snapshot_row_filter(period: Period) -> Column:
    """What ``endorsement_row_filter`` asks of a copy-main row alone: no test holds
    for a row without it, whatever its head."""
    return period.contains("policyValiddate") | F.coalesce(F.col("startdate") < ts_literal(period.end), F.lit(False))


# FIL-2
def policy_row_filter(period: Period) -> Column:
    """Keep a policy written, started or expiring in the window (or expiring in
    the prior window)."""
    return (
        period.contains("maxOperatedateUnderwritedate")
        | period.contains("maxStartdateUnderwritedate")
        | period.contains("enddate")
        | period.prior.contains("enddate")
    )
