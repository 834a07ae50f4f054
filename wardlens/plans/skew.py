"""Joins that stay balanced when one key holds a large share of the rows.

:func:`salted_join` splits the rows of each hot key on the big side over
``ceil(rows / rows_per_salt)`` sub-keys and copies the matching small-side
rows once per sub-key. Only hot keys are salted, so the small side grows by
at most ``big rows / rows_per_salt + hot keys`` rows in total, however large
the data. A row's salt is a hash of its columns, so a task that is repeated
gives every row the same salt. The hot keys are counted once while the plan is
built; with none, the plain join is returned. Where Spark may split skewed
join partitions itself (``spark.sql.adaptive.forceOptimizeSkewedJoin``), the
plain join needs neither the count nor the copies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlens.plans.ordering import hot_key_table

DEFAULT_JOIN_HOT_THRESHOLD = 1_000_000


def salted_join(big: DataFrame, small: DataFrame, keys: Sequence[str], *,
                condition=None, how: str = "inner", rows_per_salt: int | None = None,
                hot_threshold: int = DEFAULT_JOIN_HOT_THRESHOLD) -> DataFrame:
    """Equi-join ``big`` with ``small`` on ``keys`` plus an optional residual.

    ``condition`` is a callable ``(big_alias_col, small_alias_col) -> Column``
    taking column-getter functions, so it can refer to both sides without
    ambiguity. Only ``inner`` and ``left`` (big side preserved) are supported.
    The output has the big side's columns followed by the small side's non-key
    columns.
    """
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports how='inner' or 'left'")
    keys = list(keys)
    small_cols = [c for c in small.columns if c not in keys]
    if how == "left":
        # A NULL key never matches: those rows skip the shuffle and come out
        # with NULL small-side columns, so a huge NULL group cannot pile up in
        # one join task.
        no_key = None
        for k in keys:
            c = F.col(k).isNull()
            no_key = c if no_key is None else no_key | c
        unmatched = big.where(no_key).select(
            *big.columns, *[F.lit(None).cast(small.schema[c].dataType).alias(c) for c in small_cols])
        keyed = _salted(big.where(~no_key), small, keys, small_cols, condition, "left",
                        rows_per_salt, hot_threshold)
        return keyed.unionByName(unmatched)
    return _salted(big, small, keys, small_cols, condition, how, rows_per_salt, hot_threshold)


def _salted(big, small, keys, small_cols, condition, how, rows_per_salt, hot_threshold) -> DataFrame:
    bb0, ss0 = big.alias("_wl_big"), small.alias("_wl_small")

    def cond_for(extra_keys):
        cond: Column = F.lit(True)
        for k in keys + extra_keys:
            cond = cond & (F.col(f"_wl_big.{k}") == F.col(f"_wl_small.{k}"))
        if condition is not None:
            cond = cond & condition(lambda c: F.col(f"_wl_big.{c}"), lambda c: F.col(f"_wl_small.{c}"))
        return cond

    def project(joined):
        return joined.select(*[F.col(f"_wl_big.{c}").alias(c) for c in big.columns],
                             *[F.col(f"_wl_small.{c}").alias(c) for c in small_cols])

    hot_table = hot_key_table(big, keys, hot_threshold)
    if hot_table is None:  # nothing hot: the plain join
        return project(bb0.join(ss0, cond_for([]), how))
    per_salt = max(int(rows_per_salt or hot_threshold), 1)
    hot = hot_table.select(*keys, F.ceil(F.col("_wl_n") / F.lit(per_salt)).cast("int").alias("_wl_k"))

    b = big.join(hot, keys, "left").withColumn(
        "_wl_salt",
        F.when(F.col("_wl_k").isNotNull(), F.pmod(F.xxhash64(*big.columns), F.col("_wl_k")).cast("int"))
        .otherwise(F.lit(0)),
    ).drop("_wl_k")
    s = small.join(hot, keys, "left").withColumn(
        "_wl_salt",
        F.explode(F.when(F.col("_wl_k").isNotNull(), F.sequence(F.lit(0), F.col("_wl_k") - 1))
                  .otherwise(F.array(F.lit(0)))),
    ).drop("_wl_k")

    return project(b.alias("_wl_big").join(s.alias("_wl_small"), cond_for(["_wl_salt"]), how))
