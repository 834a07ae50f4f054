"""Exact medians without gathering a column anywhere.

Spark's exact ``median`` aggregate merges every distinct value into one buffer
in one task. Here the values are counted (partially aggregated, so a value
that a third of the rows have costs one row per task), the counts of all
columns are put in order of (column, value) with running totals, and the
values whose running total covers the middle ranks are read off. There is one
path for every size.

:func:`median_row` is the same number as a plan: nothing runs while it is
built, so it can stand in a query as a scalar subquery. It selects the middle
ranks digit by digit (radix selection): doubles become 64-bit keys in the same
order, and each of four rounds counts the values that share the digits found so
far by their next 16 bits. A round's table has at most 65,536 rows per wanted
rank, so its window is small however many values there are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.plans.ordering import running_totals


def exact_medians(df: DataFrame, cols) -> dict[str, float | None]:
    """Medians of several columns, ignoring NULL and NaN; None for a column without values.

    The even case is ``(lo + hi) / 2``, as pandas and SQL engines compute it.
    ``df`` is read once; two rows per column come back.
    """
    cols = list(cols)
    if not cols:
        return {}
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("x"))
                                for i, c in enumerate(cols)])).alias("p")
    counts = (df.select(pairs).select("p.c", "p.x").where(F.col("x").isNotNull() & ~F.isnan("x"))
              .groupBy("c", "x").agg(F.count(F.lit(1)).alias("n")))
    ranked = running_totals(counts, ["c", "x"], ["n"])
    ends = ranked.groupBy("c").agg((F.min(F.col("cum_n") - F.col("n"))).alias("before"), F.sum("n").alias("m"))
    k = lambda half: F.col("before") + F.floor((F.col("m") - 1 + half) / 2)
    covers = lambda r: (r >= F.col("cum_n") - F.col("n")) & (r < F.col("cum_n"))
    middle = (ranked.join(F.broadcast(ends), "c").where(covers(k(0)) | covers(k(1)))
              .groupBy("c").agg(F.min("x").alias("lo"), F.max("x").alias("hi")))
    found = {r["c"]: (r["lo"] + r["hi"]) / 2.0 for r in middle.collect()}
    return {c: found.get(i) for i, c in enumerate(cols)}


def exact_median(df: DataFrame, col: str) -> float | None:
    """Median of one column (see :func:`exact_medians`)."""
    return exact_medians(df, [col])[col]


_DIGIT_BITS = 16


def _order_key(x: Column) -> Column:
    """A 64-bit key in the order of the doubles (one value, one key).

    The exponent and mantissa of a double's hexadecimal form make its IEEE bits;
    negative values count backwards. There is no cast from a double to its bits.
    """
    size = F.abs(x)
    text = F.format_string("%a", size)  # 0x1.8p3; 0x0.8p-1022 below the normal range
    lead, digits, exponent = (F.regexp_extract(text, r"^0x([01])\.([0-9a-f]+)p(-?\d+)$", g) for g in (1, 2, 3))
    mantissa = F.conv(F.rpad(digits, 13, "0"), 16, 10).cast("long")
    biased = F.when(lead == "1", exponent.try_cast("long") + 1023).otherwise(F.lit(0).cast("long"))
    bits = F.when(size == F.lit(float("inf")), F.lit(2047 << 52)).otherwise(biased * F.lit(1 << 52) + mantissa)
    return F.when(x < 0, -bits).otherwise(bits)


def median_row(df: DataFrame, cols) -> DataFrame:
    """One lazy row with the exact median of each column, NULL for a column without values.

    NULL and NaN are left out; the even case is ``(lo + hi) / 2``. ``df`` is read
    once: values are counted first, and all rounds read those counts.
    """
    cols = list(cols)
    pairs = F.explode(F.array(*[F.struct(F.lit(i).alias("c"), F.col(c).cast("double").alias("x"))
                                for i, c in enumerate(cols)])).alias("p")
    values = (df.select(pairs).select("p.c", "p.x").where(F.col("x").isNotNull() & ~F.isnan("x"))
              .groupBy("c", "x").agg(F.count(F.lit(1)).alias("n"))
              .select("c", "x", _order_key(F.col("x")).alias("key"), "n"))
    # The two middle ranks of each column; one row per column and rank, found so far down to ``head``.
    sizes = values.groupBy("c").agg(F.sum("n").alias("m"))
    wanted = sizes.select("c", F.explode(F.array(
        F.struct(F.lit(0).alias("t"), F.expr("(m - 1) div 2").alias("rank")),
        F.struct(F.lit(1).alias("t"), F.expr("m div 2").alias("rank")))).alias("w")).select(
        "c", "w.t", "w.rank", F.lit(0).cast("long").alias("head"))
    for low in range(64 - _DIGIT_BITS, -1, -_DIGIT_BITS):
        head = F.shiftright("key", low)  # keeps the sign, so heads are in the order of the keys
        above = F.shiftright(head, _DIGIT_BITS) if low < 64 - _DIGIT_BITS else F.lit(0).cast("long")
        heads = values.select("c", "x", "n", head.alias("next"), above.alias("head"))
        # At most two rows per column are wanted.
        counts = heads.join(F.broadcast(wanted.drop("x")), ["c", "head"]).groupBy("c", "t", "rank", "next").agg(
            F.sum("n").alias("n"), F.min("x").alias("x"))  # after the last round a head is one value
        upto = F.sum("n").over(Window.partitionBy("c", "t").orderBy("next").rowsBetween(Window.unboundedPreceding, 0))
        wanted = (counts.withColumn("upto", upto).where((F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n")))
                  .select("c", "t", (F.col("rank") - (F.col("upto") - F.col("n"))).alias("rank"), F.col("next").alias("head"), "x"))
    middle = wanted.groupBy("c").agg((F.min("x") + F.max("x")).alias("twice"))
    return middle.agg(*[F.max(F.when(F.col("c") == i, F.col("twice") / 2.0)).alias(c) for i, c in enumerate(cols)])
