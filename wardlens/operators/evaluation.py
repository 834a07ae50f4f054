"""Evaluation tables for a scored fold.

Everything is computed from grouped counts, so only a handful of rows (per
class, per cell, per distinct score) ever exist; the ROC running sums use
sliced running totals (:func:`running_totals`), not a one-partition window.
"""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardlens.plans.ordering import keyed_running_totals, running_totals

LABEL, PRED, SCORE = "label", "prediction", "score"


def with_probability(pred: DataFrame, col: str = SCORE) -> DataFrame:
    """Positive-class probability as a double column."""
    return pred.withColumn(col, vector_to_array("probability")[1])


def _zero_div(num, den):
    return F.coalesce(F.try_divide(num, den), F.lit(0.0))


def classification_report(pred: DataFrame, label: str = LABEL, prediction: str = PRED) -> DataFrame:
    """Precision, recall, F1 and support per class, then accuracy, macro and weighted averages.

    Classes are those present in the labels or the predictions; an undefined
    ratio is 0. Columns: ``class, precision, recall, f1_score, support``.
    """
    # One pass over the predictions: counts per (label, prediction) cell, then
    # each cell feeds its label's support and its prediction's predicted count.
    cells = (pred.groupBy(F.col(label).cast("double").alias("l"), F.col(prediction).cast("double").alias("p"))
             .agg(F.count(F.lit(1)).alias("n")))
    n = F.col("n")
    roles = F.explode(F.array(
        F.struct(F.col("l").alias("c"), n.alias("t"), F.lit(0).cast("long").alias("p"),
                 F.when(F.col("l") == F.col("p"), n).otherwise(F.lit(0)).cast("long").alias("tp")),
        F.struct(F.col("p").alias("c"), F.lit(0).cast("long").alias("t"), n.alias("p"),
                 F.lit(0).cast("long").alias("tp")),
    )).alias("r")
    per_class = (cells.select(roles).select("r.*")
                 .groupBy("c").agg(F.sum("t").alias("support"), F.sum("p").alias("predicted"),
                                   F.sum("tp").alias("tp")))
    precision = _zero_div(F.col("tp"), F.col("predicted"))
    recall = _zero_div(F.col("tp"), F.col("support"))
    rows = per_class.select(
        F.col("c").cast("int").cast("string").alias("class"),
        precision.alias("precision"), recall.alias("recall"),
        _zero_div(2 * precision * recall, precision + recall).alias("f1_score"),
        F.col("support").cast("long").alias("support"), "tp",
    )
    # Summary rows from window totals over the per-class table (one row per
    # class, so the window is tiny); one consumer, one explode.
    w = Window.partitionBy()
    wsum = lambda c: F.sum(F.col(c) * F.col("support")).over(w)
    totals = rows.select(
        "*", F.sum("support").over(w).alias("_n"), F.sum("tp").over(w).alias("_tp"),
        F.avg("precision").over(w).alias("_mp"), F.avg("recall").over(w).alias("_mr"),
        F.avg("f1_score").over(w).alias("_mf"), wsum("precision").alias("_wp"),
        wsum("recall").alias("_wr"), wsum("f1_score").alias("_wf"),
        (F.row_number().over(w.orderBy("class")) == 1).alias("_first"))
    n_all = F.col("_n")
    acc = _zero_div(F.col("_tp"), n_all)
    first = F.col("_first")

    def row(name, p, r, f, support):
        return F.struct(name.alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), support.cast("long").alias("support"))

    out = totals.select(F.explode(F.array(
        row(F.col("class"), F.col("precision"), F.col("recall"), F.col("f1_score"), F.col("support")),
        F.when(first, row(F.lit("accuracy"), acc, acc, acc, n_all)),
        F.when(first, row(F.lit("macro avg"), F.col("_mp"), F.col("_mr"), F.col("_mf"), n_all)),
        F.when(first, row(F.lit("weighted avg"), _zero_div(F.col("_wp"), n_all),
                          _zero_div(F.col("_wr"), n_all), _zero_div(F.col("_wf"), n_all), n_all)),
    )).alias("r"))
    return out.where(F.col("r").isNotNull()).select("r.*")


def confusion_counts(pred: DataFrame, label: str = LABEL, prediction: str = PRED) -> DataFrame:
    """The 2 x 2 cells for labels 0 and 1, zeros included."""
    spark = pred.sparkSession
    grid = spark.createDataFrame([(0, 0), (0, 1), (1, 0), (1, 1)], "actual int, predicted int")
    counts = (pred.groupBy(F.col(label).cast("int").alias("actual"),
                           F.col(prediction).cast("int").alias("predicted"))
              .agg(F.count(F.lit(1)).alias("n")))
    return (grid.join(counts, ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n")))


def roc_points(pred: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """The curve's start, then one ROC point per distinct score, highest score first.

    Columns: ``threshold, tp, fp, tpr, fpr``. Counts per distinct score, then
    running sums in descending score order. The start (0, 0) lies above every
    score; its threshold is NULL. No rows give no points.
    """
    per_score = pred.groupBy(F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label)).cast("long")).alias("neg"))
    cum = running_totals(per_score, ["-threshold"], ["pos", "neg"])
    none = F.lit(0).cast("long")
    start = cum.agg(F.max("total_pos").alias("total_pos"), F.max("total_neg").alias("total_neg")).where(
        "total_pos is not null").select(F.lit(None).cast("double").alias("threshold"), none.alias("cum_pos"),
                                        none.alias("cum_neg"), "total_pos", "total_neg")
    return start.unionByName(cum.select(F.col("threshold").cast("double").alias("threshold"), *start.columns[1:])).select(
        "threshold",
        F.col("cum_pos").alias("tp"), F.col("cum_neg").alias("fp"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("total_pos")).alias("tpr"),
        F.try_divide(F.col("cum_neg").cast("double"), F.col("total_neg")).alias("fpr"),
    )


def rank_auc(pred: DataFrame, label: str = LABEL, score: str = SCORE) -> DataFrame:
    """ROC-AUC as the Mann-Whitney statistic with tied scores averaged.

    AUC = sum over distinct scores of neg_s * (2 * pos_at_or_above_s - pos_s) / (2 * P * N),
    taken over per-score counts with running sums. The numerator is summed as
    an exact integer, so the result does not depend on summation order. NULL
    when a class is absent.
    """
    per_score = pred.groupBy(F.col(score).alias("s")).agg(
        F.sum(F.col(label).cast("long")).alias("pos"),
        F.sum((1 - F.col(label)).cast("long")).alias("neg"))
    return rank_auc_of_counts(per_score)


def rank_auc_of_counts(per_score: DataFrame) -> DataFrame:
    """M17 from the positives and negatives per distinct score (``s, pos, neg``)."""
    cum = running_totals(per_score, ["-s"], ["pos"])
    # 19-digit factors: their products and the sum of those still fit 38 digits.
    twice = F.col("neg").cast("decimal(19,0)") * (F.lit(2) * F.col("cum_pos") - F.col("pos")).cast("decimal(19,0)")
    return cum.agg(
        F.try_divide(F.sum(twice).cast("double"),
                     F.lit(2.0) * F.max("total_pos").cast("double") * F.sum("neg").cast("double")).alias("auc"),
        F.max("total_pos").alias("n_pos"),
        F.sum("neg").alias("n_neg"),
    )


def rank_auc_by(pred: DataFrame, by, label: str = LABEL, score: str = SCORE, n: str | None = None) -> DataFrame:
    """M17 per group, all groups in one job: ``by, auc, n_pos, n_neg``; ``n`` names how many rows a row stands for.

    The same exact sum as :func:`rank_auc`, with running sums per group
    (:func:`keyed_running_totals`). A group with one class gets a NULL AUC (T12).
    """
    by = [by] if isinstance(by, str) else list(by)
    rows = F.col(n) if n else F.lit(1)
    per_score = pred.groupBy(*by, F.col(score).alias("_s")).agg(
        F.sum((F.col(label) * rows).cast("long")).alias("_pos"), F.sum(((1 - F.col(label)) * rows).cast("long")).alias("_neg"))
    cum = keyed_running_totals(per_score, by, ["-_s"], ["_pos"])
    twice = (F.col("_neg").cast("decimal(19,0)")
             * (F.lit(2) * F.col("cum__pos") - F.col("_pos")).cast("decimal(19,0)"))
    return cum.groupBy(*by).agg(
        F.try_divide(F.sum(twice).cast("double"),
                     F.lit(2.0) * F.max("total__pos").cast("double") * F.sum("_neg").cast("double")).alias("auc"),
        F.max("total__pos").alias("n_pos"), F.sum("_neg").alias("n_neg"))


def fold_rank_auc(pred: DataFrame, fold: str = "fold", label: str = LABEL, score: str = SCORE) -> DataFrame:
    """One row per fold, ``fold, auc, n_pos, n_neg``, with the mean and population std of all folds.

    ``mean_auc`` and ``std_auc`` leave out folds without an AUC and are summed
    in fold order, so every run gives the same digits.
    """
    folds = rank_auc_by(pred, fold, label, score)
    known = F.expr(f"transform(filter(array_sort(collect_list(struct({fold}, auc)) OVER ()), x -> x.auc IS NOT NULL), x -> x.auc)")
    # A window over the fold table: one row per fold.
    rows = folds.withColumn("_known", known)
    total = lambda f: F.aggregate("_known", F.lit(0.0), lambda s, x: s + f(x))
    rows = rows.withColumn("mean_auc", F.try_divide(total(lambda x: x), F.size("_known")))
    spread = total(lambda x: (x - F.col("mean_auc")) * (x - F.col("mean_auc")))
    return rows.withColumn("std_auc", F.sqrt(F.try_divide(spread, F.size("_known")))).drop("_known")


def auc_table(pred: DataFrame) -> DataFrame:
    """One-row ROC-AUC table of a scored fold."""
    return rank_auc(pred).select("auc")


def feature_importance(forest_model, features: list[str]) -> DataFrame:
    """``feature, importance`` sorted by importance (one row per feature)."""
    spark = SparkSession.getActiveSession()
    imp = forest_model.featureImportances.toArray().tolist()
    rows = [(f, float(v)) for f, v in zip(features, imp)]
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), F.asc("feature")))


INTERCEPT = "(intercept)"


def logistic_gradient(model, rows: DataFrame, features: list[str], label: str = LABEL, weight: str = "weight") -> DataFrame:
    """M10 as a certificate: ``feature, gradient`` of the training loss at the fitted coefficients.

    The loss is the weighted mean log loss plus half the squared coefficients
    times the regularisation (the intercept goes free). It is convex, so a model
    is the best one exactly when every gradient is 0. One aggregate over the
    non-zero entries of the rows, whatever the number of features.
    """
    entries = F.expr("""transform(CASE WHEN v.type = 0 THEN v.indices
                                       WHEN size(v.values) > 0 THEN sequence(0, size(v.values) - 1)
                                       ELSE CAST(array() AS array<int>) END,
                                  (i, n) -> struct(i AS index, r * v.values[n] AS term))""")
    residual = F.col(weight) * (vector_to_array(F.col(model.getProbabilityCol()))[1] - F.col(label))
    whole = lambda i, c: F.array(F.struct(F.lit(i).alias("index"), F.col(c).alias("term")))
    scored = model.transform(rows).select(F.unwrap_udt(model.getFeaturesCol()).alias("v"), residual.alias("r"),
                                          F.col(weight).cast("double").alias("w"))
    sums = (scored.select(F.explode(F.concat(entries, whole(-1, "r"), whole(-2, "w"))).alias("e"))
            .groupBy("e.index").agg(F.sum("e.term").alias("total")))
    # As many rows as the model has coefficients.
    pulls = [(i, f, float(b) * model.getRegParam()) for i, (f, b) in enumerate(zip(features, model.coefficients, strict=True))]
    named = rows.sparkSession.createDataFrame([*pulls, (-1, INTERCEPT, 0.0)], "index int, feature string, pull double")
    mass = sums.where("index = -2").select("total").scalar()
    return (named.join(sums, "index", "left")
            .select("feature", (F.coalesce("total", F.lit(0.0)) / mass + F.col("pull")).alias("gradient")))
