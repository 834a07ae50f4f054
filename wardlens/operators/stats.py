"""Chi-square test of independence on a mortality-by-group table.

The contingency table has one row per group with cells died = ``n_deaths``
and survived = ``n_admissions - n_deaths``. Column totals are window sums over
that table (one row per group), and the statistic is summed cell by cell:

  chi2 = sum over cells of max(|O - E| - y, 0)^2 / E

with Yates' correction y = min(0.5, |O - E|) for one degree of freedom (two
groups) and y = 0 otherwise. No large terms cancel, so it holds for any counts.

A zero margin or a negative cell (possible with double-counted deaths) gives a
NULL statistic and ``unreliable = true`` instead of a failed job. Values are
reported rounded to 6 decimals.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.functions.chisq import chi2_sf_col
from wardlens.schemas import MIN_EXPECTED_COUNT

REPORT_DIGITS = 6


def contingency_table(df: DataFrame, group_col: str | None = None,
                      deaths: str = "n_deaths", total: str = "n_admissions") -> DataFrame:
    """Died / survived counts per group."""
    keep = [group_col] if group_col else []
    return df.select(*keep, F.col(deaths).alias("died"),
                     (F.col(total) - F.col(deaths)).alias("survived"))


def mortality_significance_test(df: DataFrame, label: str, deaths: str = "n_deaths",
                                total: str = "n_admissions") -> DataFrame:
    """Q8: one row ``label, chi_square, dof, p_value, min_expected, unreliable``."""
    every = Window.partitionBy()
    d, r = F.col(deaths).cast("double"), F.col(total).cast("double")
    cells = df.select(d.alias("d"), (r - d).alias("s"), r.alias("r"), F.count(F.lit(1)).over(every).alias("g"),
                      F.sum(r).over(every).alias("n"), F.sum(d).over(every).alias("c_d"),
                      F.sum(r - d).over(every).alias("c_s"))
    yates = F.when(F.col("g") == 2, F.lit(0.5)).otherwise(F.lit(0.0))

    def cell(observed: str, margin: str):
        expected = F.col("r") * F.try_divide(F.col(margin), F.col("n"))
        off = F.greatest(F.abs(F.col(observed) - expected) - yates, F.lit(0.0))
        return F.try_divide(off * off, expected)

    agg = cells.agg(
        F.count(F.lit(1)).alias("g"), F.max("n").alias("n"), F.max("c_d").alias("c_d"), F.max("c_s").alias("c_s"),
        F.sum(cell("d", "c_d") + cell("s", "c_s")).alias("chi"), F.min("r").alias("r_min"),
        F.max((F.col("d") < 0) | (F.col("s") < 0) | (F.col("r") <= 0)).alias("bad_cell"))
    n, c_d, c_s = F.col("n"), F.col("c_d"), F.col("c_s")
    dof = (F.col("g") - 1).cast("int")
    invalid = F.coalesce(F.col("bad_cell"), F.lit(True)) | (c_d <= 0) | (c_s <= 0)
    stat = (F.when(invalid, F.lit(None).cast("double"))
            .when(dof == 0, F.lit(0.0))
            .otherwise(F.col("chi")))
    min_expected = F.when(invalid, F.lit(None).cast("double")).otherwise(
        F.col("r_min") * (F.least(c_d, c_s) / n))
    out = agg.select(
        F.lit(label).alias("label"),
        F.round(stat, REPORT_DIGITS).alias("chi_square"),
        dof.alias("dof"),
        stat.alias("_stat"),
        F.round(min_expected, REPORT_DIGITS).alias("min_expected"),
        (invalid | (min_expected < F.lit(MIN_EXPECTED_COUNT))).alias("unreliable"),
    )
    p = F.when(F.col("dof") == 0, F.lit(1.0)).otherwise(chi2_sf_col(F.col("_stat"), F.col("dof")))
    return out.select("label", "chi_square", "dof",
                      F.round(p, REPORT_DIGITS).alias("p_value"),
                      "min_expected", "unreliable")
