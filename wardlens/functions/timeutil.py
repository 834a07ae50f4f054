"""Time arithmetic on ``TIMESTAMP_NTZ`` columns (F1, F2).

Differences are exact microsecond counts taken as ``later - earlier`` (a
day-time interval, computed on wall-clock values with no time zone), so 24-hour
and 30-day edges are decided exactly and the session time zone never matters.
(``timestamp_diff`` would cast wall-clock values to instants in the session
zone, which moves times inside a daylight-saving gap by an hour.) Everything
stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def micros_between(later, earlier) -> Column:
    """Exact microseconds ``later - earlier`` as a long (NULL if either is NULL)."""
    interval = _col(later) - _col(earlier)
    return (interval.cast("interval second").cast("decimal(38,6)") * F.lit(1_000_000)).cast("long")


def days_between(later, earlier) -> Column:
    """Fractional days ``later - earlier`` (NULL if either side is NULL)."""
    return micros_between(later, earlier) / F.lit(MICROS_PER_DAY)


def plus_hours(ts, hours: int) -> Column:
    """``ts + hours`` as a timestamp of the same type."""
    return _col(ts) + F.make_dt_interval(F.lit(0), F.lit(hours))
