"""Order-dependent computations that never funnel a big group into one task.

* :func:`keyed_sequence` - row number, previous and next values per key (W1-W3).
  Ordinary keys use one Window. Keys that hold more rows than a task budget
  ("hot" keys) are range-partitioned by (key, order); each slice is windowed on
  its own and the slice edges are stitched with a table of one row per slice
  and hot key in it.
* :func:`global_positions` - 0-based position in a total order.
* :func:`running_totals` - cumulative sums in a total order.
* :func:`keyed_running_totals` - cumulative sums per key, in one pass for all keys.

A slice is a range partition whose number is written down with its rows
(:func:`range_sliced`): the rows are range-partitioned once, stored with the
partition number as a column, and read back. All consumers therefore agree on
the slices whatever Spark prunes, reuses or retries, and neither the plan nor
the driver holds anything per slice or per key.

Order lists hold column names, ascending with NULLs first; a leading ``-``
(``"-score"``) orders a numeric column descending.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wardlens.session import materialize, shuffle_partitions

# A key with more rows than this is split across tasks.
DEFAULT_HOT_THRESHOLD = 2_000_000


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def _sort_exprs(order: Sequence[str]) -> list[Column]:
    """Ascending sort expressions; ``-c`` becomes ``-col(c)`` (numeric descending)."""
    return [-F.col(c[1:]) if c.startswith("-") else F.col(c) for c in order]


def _ranged(df: DataFrame, order: Sequence[str], slices: int) -> DataFrame:
    """``df`` range-partitioned by ``order``, with the partition's number as ``_wl_b`` (not yet written)."""
    return (df.repartitionByRange(max(1, int(slices)), *_sort_exprs(order))
            .withColumn("_wl_b", F.spark_partition_id()))


def range_sliced(df: DataFrame, order: Sequence[str], slices: int, name: str = "slices") -> DataFrame:
    """The rows of ``df`` with their slice number ``_wl_b``, ascending in ``order``.

    Written once (one run of the plan of ``df`` and its sampling pass), then
    read back: the number is data, so every later use sees the same slices.
    """
    return materialize(_ranged(df, order, slices), name)


def hot_key_table(df: DataFrame, keys: Sequence[str], threshold: int) -> DataFrame | None:
    """Keys with more than ``threshold`` rows and their row count ``_wl_n``; None when there is none.

    The per-key count is partially aggregated before its shuffle, so a hot key
    costs one row per map task. The table is written, not collected: it may
    have any number of rows (at most rows / threshold), and joins with it are
    planned from its real size.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_wl_n"))
    hot = materialize(counts.where(F.col("_wl_n") > F.lit(threshold)), "hot-keys")
    return None if hot.isEmpty() else hot


def join_null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join on ``keys`` where NULL matches NULL (a NULL key is a group too)."""
    r = right.select(*[F.col(c).alias(f"_wl_r_{c}") if c in keys else F.col(c) for c in right.columns])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_wl_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*[f"_wl_r_{k}" for k in keys])


def keyed_sequence(df: DataFrame, key, order: Sequence[str], *,
                   seq_col: str | None = "seq",
                   lag: Sequence[str] = (), lead: Sequence[str] = (),
                   hot_threshold: int = DEFAULT_HOT_THRESHOLD,
                   hot_partitions: int | None = None) -> DataFrame:
    """Add ``seq_col`` (1-based), ``prev_<c>`` for ``lag`` and ``next_<c>`` for ``lead``.

    ``order`` must be a total order within a key (end it with a unique column)
    for the result to be deterministic. Rows with a NULL key form one group, as
    in SQL window partitions. The per-key count runs once while the plan is
    built; when no key is hot the result is the plain one-window plan.
    """
    keys = _names(key)
    order = list(order)
    cols = df.columns

    def outputs(w, rn_name):
        out = []
        if rn_name:
            out.append(F.row_number().over(w).alias(rn_name))
        out += [F.lag(c).over(w).alias(f"prev_{c}") for c in lag]
        out += [F.lead(c).over(w).alias(f"next_{c}") for c in lead]
        return out

    def plain(frame):
        out = frame.select(*cols, *outputs(Window.partitionBy(*keys).orderBy(*order),
                                           seq_col or "_wl_seq"))
        return out if seq_col else out.drop("_wl_seq")

    hot = hot_key_table(df, keys, hot_threshold)
    if hot is None:  # nothing hot: one exchange, one window
        return plain(df)
    hot_rows_total = hot.agg(F.sum("_wl_n")).first()[0]
    hot = hot.select(*keys, F.lit(True).alias("_wl_hot"))
    tagged = join_null_safe(df, hot, keys, "left")

    # Ordinary keys: one window partition per key.
    cold = plain(tagged.where(F.col("_wl_hot").isNull()))

    # Hot keys: contiguous slices of (key, order), about hot_threshold rows each.
    parts = hot_partitions or max(shuffle_partitions(df.sparkSession),
                                  -(-hot_rows_total // max(hot_threshold, 1)))
    hot_rows = range_sliced(tagged.where(F.col("_wl_hot").isNotNull()).select(*cols),
                            [*keys, *order], parts, "hot-slices")
    wl = Window.partitionBy(*keys, "_wl_b").orderBy(*order)
    local = hot_rows.select(*cols, "_wl_b", *outputs(wl, "_wl_rn"))
    position = F.struct(*order)
    slices = hot_rows.groupBy(*keys, "_wl_b").agg(
        F.count(F.lit(1)).alias("_wl_cnt"),
        *[F.max_by(c, position).alias(f"_wl_last_{c}") for c in lag],
        *[F.min_by(c, position).alias(f"_wl_first_{c}") for c in lead],
    )
    # One row per slice of a key: the window holds slices, not rows.
    ws = Window.partitionBy(*keys).orderBy("_wl_b")
    slices = slices.select(
        *keys, "_wl_b", "_wl_cnt",
        F.coalesce(F.sum("_wl_cnt").over(ws.rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("_wl_off"),
        *[F.lag(f"_wl_last_{c}").over(ws).alias(f"_wl_pl_{c}") for c in lag],
        *[F.lead(f"_wl_first_{c}").over(ws).alias(f"_wl_nf_{c}") for c in lead],
    )
    stitched = join_null_safe(local, slices, [*keys, "_wl_b"], "inner")
    rn = F.col("_wl_rn")
    hot_out = stitched.select(
        *cols,
        *([(rn + F.col("_wl_off")).cast("int").alias(seq_col)] if seq_col else []),
        *[F.when(rn == 1, F.col(f"_wl_pl_{c}")).otherwise(F.col(f"prev_{c}")).alias(f"prev_{c}")
          for c in lag],
        *[F.when(rn == F.col("_wl_cnt"), F.col(f"_wl_nf_{c}")).otherwise(F.col(f"next_{c}"))
          .alias(f"next_{c}") for c in lead],
    )
    return cold.unionByName(hot_out)


def _offsets(sizes: DataFrame, value_cols: Sequence[str]) -> DataFrame:
    """Exclusive prefix sums and grand totals over a table with one row per slice."""
    w_before = Window.orderBy("_wl_b").rowsBetween(Window.unboundedPreceding, -1)
    w_all = Window.partitionBy()
    return sizes.select(
        "_wl_b",
        *[F.coalesce(F.sum(c).over(w_before), F.lit(0)).alias(f"{c}_off") for c in value_cols],
        *[F.sum(c).over(w_all).alias(f"{c}_all") for c in value_cols],
    )


def global_positions(df: DataFrame, order: Sequence[str], pos_col: str = "pos",
                     partitions: int | None = None) -> DataFrame:
    """Add ``pos_col``: the row's 0-based position in ``order`` (a total order).

    Rows are cut into ``partitions`` contiguous slices (see module docstring);
    each slice is numbered by its own window and shifted by the sizes of the
    slices before it, from a table of one row per slice.
    """
    parts = partitions or shuffle_partitions(df.sparkSession)
    cols = df.columns
    sliced = range_sliced(df, order, parts, "positions")
    local = sliced.select(*cols, "_wl_b", (F.row_number().over(
        Window.partitionBy("_wl_b").orderBy(*_sort_exprs(order))) - 1).alias("_wl_i"))
    sizes = sliced.groupBy("_wl_b").agg(F.count(F.lit(1)).alias("_wl_c"))
    offs = _offsets(sizes, ["_wl_c"])
    return (local.join(F.broadcast(offs), "_wl_b")
            .select(*cols, (F.col("_wl_c_off") + F.col("_wl_i")).alias(pos_col)))


def running_totals(df: DataFrame, order: Sequence[str], sum_cols: Sequence[str],
                   partitions: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum in ``order``) and ``total_<c>`` per column."""
    parts = partitions or shuffle_partitions(df.sparkSession)
    cols = df.columns
    sliced = range_sliced(df, order, parts, "totals")
    wl = (Window.partitionBy("_wl_b").orderBy(*_sort_exprs(order))
          .rowsBetween(Window.unboundedPreceding, 0))
    local = sliced.select(*cols, "_wl_b", *[F.sum(c).over(wl).alias(f"_wl_cum_{c}") for c in sum_cols])
    sizes = sliced.groupBy("_wl_b").agg(*[F.sum(c).alias(f"_wl_s_{c}") for c in sum_cols])
    offs = _offsets(sizes, [f"_wl_s_{c}" for c in sum_cols])
    return local.join(F.broadcast(offs), "_wl_b").select(
        *cols,
        *[(F.col(f"_wl_cum_{c}") + F.col(f"_wl_s_{c}_off")).alias(f"cum_{c}") for c in sum_cols],
        *[F.col(f"_wl_s_{c}_all").alias(f"total_{c}") for c in sum_cols],
    )


def keyed_running_totals(df: DataFrame, key, order: Sequence[str], sum_cols: Sequence[str],
                         partitions: int | None = None) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum in ``order`` within the key) and ``total_<c>`` (of the key) per column.

    The segmented form of :func:`running_totals`: rows are range-partitioned by
    (key, order), so a key covers a run of slices, however many rows it has, and
    a slice may hold many keys. Sums start anew at each key inside a slice; what
    the key holds in earlier slices is carried in from a table of one row per
    slice and key in it. NULL keys form one group.
    """
    keys = _names(key)
    cols = df.columns
    sliced = range_sliced(df, [*keys, *order], partitions or shuffle_partitions(df.sparkSession), "keyed-totals")
    within = (Window.partitionBy("_wl_b", *keys).orderBy(*_sort_exprs(order))
              .rowsBetween(Window.unboundedPreceding, 0))
    local = sliced.select(*cols, "_wl_b", *[F.sum(c).over(within).alias(f"_wl_cum_{c}") for c in sum_cols])
    held = sliced.groupBy("_wl_b", *keys).agg(*[F.sum(c).alias(f"_wl_s_{c}") for c in sum_cols])
    before = Window.partitionBy(*keys).orderBy("_wl_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = held.select(
        "_wl_b", *keys,
        *[F.coalesce(F.sum(f"_wl_s_{c}").over(before), F.lit(0)).alias(f"_wl_off_{c}") for c in sum_cols],
        *[F.sum(f"_wl_s_{c}").over(Window.partitionBy(*keys)).alias(f"_wl_all_{c}") for c in sum_cols])
    return join_null_safe(local, carry, [*keys, "_wl_b"], "inner").select(
        *cols,
        *[(F.col(f"_wl_cum_{c}") + F.col(f"_wl_off_{c}")).alias(f"cum_{c}") for c in sum_cols],
        *[F.col(f"_wl_all_{c}").alias(f"total_{c}") for c in sum_cols],
    )
