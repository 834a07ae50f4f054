"""Upper tail of the chi-square distribution.

:func:`chi2_sf_col` is a Spark column expression (no Python worker). With
h = x / 2 and Q(a, h) the regularised upper incomplete gamma function, the tail
is Q(dof / 2, h), and Q(a + 1, h) = Q(a, h) + h^a e^-h / Gamma(a + 1), so

  even dof 2m:   sum over i < m of h^i e^-h / i!
  odd dof 2m+1:  Q(1/2, h) + sum over i < m of h^(i + 1/2) e^-h / Gamma(i + 3/2)

Q(1/2, h) comes from its power series below h = 1.5 and from its continued
fraction, evaluated backwards over a fixed number of steps, from there on. All
sums are short: their length depends on the degrees of freedom only, and no
tail is a difference from one, so small tails keep their digits.

:func:`chi2_sf` is the same quantity in plain Python, from ``math.erfc``; the
tests use it as an independent check.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


_SERIES_STEPS, _FRACTION_STEPS = 60, 300


def _half_tail(h: Column) -> Column:
    """Q(1/2, h) for h > 0."""
    lead = F.exp(-h) * F.sqrt(h)
    # sum over n of h^n / Gamma(n + 3/2); each term is the one before times h / (n + 1/2)
    first = F.lit(2.0 / math.sqrt(math.pi))
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(_SERIES_STEPS)), F.struct(first.alias("t"), first.alias("s")),
        lambda acc, n: F.struct((acc["t"] * h / (n + F.lit(0.5))).alias("t"),
                                (acc["s"] + acc["t"] * h / (n + F.lit(0.5))).alias("s")))["s"]
    below = F.aggregate(
        F.sequence(F.lit(_FRACTION_STEPS), F.lit(1)), F.lit(0.0),
        lambda acc, k: k * (k - F.lit(0.5)) / (h + F.lit(0.5) + 2.0 * k - acc))
    fraction = lead / F.lit(math.sqrt(math.pi)) / (h + F.lit(0.5) - below)
    return F.when(h < 1.5, F.lit(1.0) - lead * series).otherwise(fraction)


def chi2_sf_col(x: Column, dof: Column) -> Column:
    """P(X >= x) for X ~ chi-square(dof); NULL for NULL input or dof < 1, 1 for x <= 0."""
    h = x / 2.0
    odd = (dof % 2).cast("double") / 2.0           # the sum's exponents are i + odd
    terms = F.floor(dof / 2).cast("int")
    start = odd * F.log(h) - h - F.when(odd > 0, F.lit(math.lgamma(1.5))).otherwise(F.lit(0.0))
    # Logarithm of each term from the one before; a term is exponentiated on its own.
    finite = F.aggregate(
        F.sequence(F.lit(1), F.greatest(terms, F.lit(1))), F.struct(start.alias("l"), F.lit(0.0).alias("s")),
        lambda acc, i: F.struct((acc["l"] + F.log(h) - F.log(i + odd)).alias("l"),
                                (acc["s"] + F.exp(acc["l"])).alias("s")))["s"]
    tail = F.when(terms > 0, finite).otherwise(F.lit(0.0)) + F.when(odd > 0, _half_tail(h)).otherwise(F.lit(0.0))
    return (F.when(x.isNull() | dof.isNull() | (dof < 1), F.lit(None).cast("double"))
            .when(x <= 0, F.lit(1.0))
            .otherwise(F.least(F.lit(1.0), tail)))


def chi2_sf(x: float | None, dof: int | None) -> float | None:
    """P(X >= x) for X ~ chi-square(dof), from the closed forms."""
    if x is None or dof is None or (isinstance(x, float) and math.isnan(x)) or dof < 1:
        return None
    if x <= 0:
        return 1.0
    h = x / 2.0
    if dof % 2 == 0:
        total, term = 0.0, 1.0
        for i in range(dof // 2):
            if i > 0:
                term = term * h / i
            total += term
        return math.exp(-h) * total
    total = 0.0
    for i in range((dof - 1) // 2):
        total += math.exp((i + 0.5) * math.log(h) - math.lgamma(i + 1.5))
    return math.erfc(math.sqrt(h)) + math.exp(-h) * total
