"""Patient-grouped, label-stratified folds (M5, M6).

Contract: no group in two folds, every row in exactly one fold, positives per
fold as even as the group sizes allow, the same folds on every run.

Method ``ordered`` (default): aggregate rows to groups, order the groups by
(positives desc, rows desc, md5(seed | key)) and deal them round-robin:
fold = position mod k. The position comes from :func:`global_positions`
(sampled slices + per-slice offsets), never from a one-partition window.
Method ``even`` (what training uses): greedy, like the reference's grouped
stratified folds, but over the histogram of group signatures (positives, rows).
Groups of one signature are alike, so the driver deals counts of them, largest
positives first, each to the fold with the fewest positives (groups without
positives: the fewest rows), and the groups of a signature are split by rank
into one interval per fold. The driver sees signatures, never groups.
Method ``hash``: fold = md5(seed | key) mod k, for when even positives per
fold matter less than one pass.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.plans.ordering import global_positions
from wardlens.schemas import N_CV_SPLITS, RANDOM_SEED
from wardlens.session import materialize


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Rows per label value."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def fold_count(df: DataFrame, label: str, n_splits: int = N_CV_SPLITS) -> tuple[int, int, int]:
    """M6: ``(n_classes, smallest_class, folds)`` with folds = min(n_splits, smallest class).

    Brings back one row per class (two for a binary label).
    """
    rows = class_counts(df.where(F.col(label).isNotNull()), label).collect()
    counts = [r["n"] for r in rows]
    smallest = min(counts) if counts else 0
    return len(counts), smallest, min(n_splits, smallest)


def cv_splits(df: DataFrame, label: str, n_splits: int = N_CV_SPLITS) -> DataFrame:
    """M6 as a one-row DataFrame: ``n_classes, min_class_count, n_splits``."""
    counts = class_counts(df.where(F.col(label).isNotNull()), label)
    return counts.agg(
        F.count(F.lit(1)).alias("n_classes"),
        F.min("n").alias("min_class_count"),
        F.least(F.lit(n_splits).cast("long"), F.min("n")).alias("n_splits"),
    )


def _group_hash(group_col: str, seed: int) -> F.Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(group_col).cast("string")))


def deal_signatures(signatures: Sequence[tuple[int, int, int]], k: int) -> list[tuple[int, int, int, list[int]]]:
    """Greedy dealing of ``(positives, rows, groups)`` over ``k`` folds: ``(positives, rows, groups before, ends)``.

    ``ends[f]`` is where fold ``f``'s share of the signature's groups ends, by
    rank. Every group goes to the fold with the fewest positives, then rows, then
    the lowest number; without positives, the fewest rows count first. Runs of
    groups that would go round the same folds again are dealt at once, so the
    work follows the signatures and not the groups.
    """
    positives, rows, out, before = [0] * k, [0] * k, [], 0
    for pos, size, count in sorted(signatures, key=lambda s: (-s[0], -s[1])):
        load, step = (positives, pos) if pos else (rows, size)
        given, left = [0] * k, count
        while left:
            order = sorted(range(k), key=lambda f: (load[f], rows[f], f))
            # The lowest folds that lie within one step take one group each before any takes a second.
            m = sum(load[f] - load[order[0]] < step for f in order)
            room = left // m if m == k else min(left // m, (load[order[m]] - load[order[m - 1]]) // step)
            for f, n in [(f, room) for f in order[:m]] if room else [(order[0], 1)]:
                given[f] += n
                positives[f] += n * pos
                rows[f] += n * size
                left -= n
        out.append((pos, size, before, list(itertools.accumulate(given))))
        before += count
    return out


def _even_folds(groups: DataFrame, group_col: str, k: int) -> DataFrame:
    groups = materialize(groups.withColumn("n_pos", F.coalesce("n_pos", F.lit(0).cast("long"))), "fold-groups")
    signatures = groups.groupBy("n_pos", "n_rows").agg(F.count(F.lit(1)).alias("n")).collect()
    dealt = groups.sparkSession.createDataFrame(
        deal_signatures([tuple(r) for r in signatures], k), "n_pos long, n_rows long, _before long, _ends array<long>")
    ranked = global_positions(groups, ["-n_pos", "-n_rows", "_h"], "_pos")
    rank = F.col("_pos") - F.col("_before")
    return ranked.join(dealt, ["n_pos", "n_rows"]).select(
        group_col, "n_rows", "n_pos", F.size(F.filter("_ends", lambda e: e <= rank)).cast("int").alias("fold"))


def grouped_folds(df: DataFrame, group_col: str, label: str, k: int, *,
                  seed: int = RANDOM_SEED, method: str = "ordered") -> DataFrame:
    """One row per group: ``group_col, n_rows, n_pos, fold``."""
    if k < 1:
        raise ValueError("k must be at least 1")
    groups = (df.groupBy(group_col)
              .agg(F.count(F.lit(1)).alias("n_rows"),
                   F.sum(F.col(label).cast("long")).alias("n_pos"))
              .withColumn("_h", _group_hash(group_col, seed)))
    if method == "hash":
        bucket = F.conv(F.substring("_h", 1, 15), 16, 10).cast("long")
        return groups.select(group_col, "n_rows", "n_pos", F.pmod(bucket, F.lit(k)).cast("int").alias("fold"))
    if method == "even":
        return _even_folds(groups, group_col, k)
    if method != "ordered":
        raise ValueError("method must be 'ordered', 'even' or 'hash'")
    ranked = global_positions(groups, ["-n_pos", "-n_rows", "_h"], "_pos")
    return ranked.select(group_col, "n_rows", "n_pos",
                         F.pmod(F.col("_pos"), F.lit(k)).cast("int").alias("fold"))


def assign_folds(df: DataFrame, folds: DataFrame, group_col: str) -> DataFrame:
    """Attach ``fold`` to every row; NULL group keys match their own group."""
    f = folds.select(F.col(group_col).alias("_g"), "fold")
    return df.join(f, df[group_col].eqNullSafe(f["_g"])).drop("_g")


def fold_balance(df_with_fold: DataFrame, group_col: str, label: str) -> DataFrame:
    """Rows, positives and groups per fold."""
    return df_with_fold.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum(F.col(label).cast("long")).alias("n_pos"),
        F.count_distinct(group_col).alias("n_groups"),
    )
