"""Small column helpers (P2, P3, F4-F6, F10) built from Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def indicator(cond: Column) -> Column:
    """1 when ``cond`` holds, else 0 (NULL condition counts as 0), as int."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def cap_upper(c, cap: float) -> Column:
    """``min(c, cap)`` that keeps NULL (``least`` would not)."""
    c = _col(c)
    return F.when(c > F.lit(cap), F.lit(float(cap))).otherwise(c)


def safe_ratio(num, den) -> Column:
    """``num / den`` with 0 or NULL denominators giving NULL (no ANSI error)."""
    return F.try_divide(_col(num).cast("double"), F.nullif(_col(den), F.lit(0)).cast("double"))


def rate_pct(num, den, digits: int = 1) -> Column:
    """Rounded percentage ``(100 * num) / den``, multiplied first as in SQL."""
    return F.round(safe_ratio(F.lit(100.0) * _col(num), den), digits)
