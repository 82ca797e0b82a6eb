"""policylens — motor-insurance policy analytics on PySpark.

Reads policy, endorsement, fee, co-insurance, vehicle and company extracts,
turns dates and packed flag strings into typed columns, evaluates
reporting-window rules, computes per-policy business indicators, rolls the
endorsements up to the policy and joins everything into one wide row per
policy.  Every step is a DataFrame column expression or a DataFrame operator,
so Catalyst and adaptive execution plan the whole job.
"""

from policylens.operators.period import Period

__all__ = ["Period"]
__version__ = "0.1.0"
