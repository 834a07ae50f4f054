"""Design matrix and model fitting.

Categoricals are one-hot encoded with the first sorted level dropped, like
``get_dummies(drop_first=True)``: levels come from the whole frame, the
encoder is fitted once outside cross-validation, and an unseen or missing
level gives all-zero indicators (equal to the dropped baseline). Models are
fitted on the sparse vector of :mod:`wardlens.operators.levels`, whose encoder
is a pipeline stage, so a saved model scores raw admission rows;
:func:`design_matrix` shows the same matrix as columns.

Fits run on executors (``pyspark.ml``); the driver loop only walks folds and
grid points.
"""

from __future__ import annotations

import json
import statistics
from dataclasses import dataclass, field

from pyspark import keyword_only
from pyspark.ml import Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlens.operators.levels import VectorFeatures, fit_levels
from wardlens.schemas import (FEATURE_COLS_CATEGORICAL, FEATURE_COLS_NUMERIC, LEAKY_COLUMNS,
                              MORTALITY_TARGET, N_CV_SPLITS, RANDOM_SEED, READMISSION_TARGET,
                              RF_PARAM_GRID, UNLIMITED_DEPTH_DEFAULT)
from wardlens.session import one_task_per_file

MAX_LEVELS = 10_000
DEFAULT_TREES = 100
# Statistics of one group of nodes while a forest is fitted; several fits run at a time.
FIT_MEMORY_MB = 128
# Deeper forests keep each row's node per tree (4 bytes a tree and row, cached once more per level);
# down to this depth walking from the root is quicker and needs no memory.
NODE_CACHE_DEPTH = 5
LABEL, WEIGHT, FOLD = "label", "weight", "fold"


# ---------------------------------------------------------------------------
# M4 leakage guard
# ---------------------------------------------------------------------------

def check_no_leakage(numeric=FEATURE_COLS_NUMERIC, categorical=FEATURE_COLS_CATEGORICAL) -> None:
    """Raise if a whole-stay column (known only at discharge) is used as a feature."""
    leaked = LEAKY_COLUMNS.intersection([*numeric, *categorical])
    if leaked:
        raise ValueError(f"whole-stay columns must not be features: {sorted(leaked)}")


# ---------------------------------------------------------------------------
# M1-M3 model frames
# ---------------------------------------------------------------------------

def model_frame(df: DataFrame, target: str = MORTALITY_TARGET, *, group_col: str = "subject_id",
                id_col: str | None = "hadm_id", numeric=FEATURE_COLS_NUMERIC,
                categorical=FEATURE_COLS_CATEGORICAL) -> DataFrame:
    """Listed columns that exist, rows with a target, target as int ``label``."""
    check_no_leakage(numeric, categorical)
    wanted = [group_col, *([id_col] if id_col else []), *numeric, *categorical]
    cols = [c for c in wanted if c in df.columns]
    return (df.where(F.col(target).isNotNull())
            .select(*cols, F.col(target).cast("int").alias(LABEL)))


def merge_target(features: DataFrame, target_df: DataFrame) -> DataFrame:
    """Attach ``readmit_30d`` on (subject_id, hadm_id), inner join."""
    return features.join(target_df.select("subject_id", "hadm_id", READMISSION_TARGET),
                         ["subject_id", "hadm_id"], "inner")


def readmission_frame(features_with_target: DataFrame, **kw) -> DataFrame:
    """M2: survivors only (death rows dropped), then rows with a known label."""
    survivors = features_with_target.where(F.col(MORTALITY_TARGET) == 0)
    return model_frame(survivors, READMISSION_TARGET, **kw)


# ---------------------------------------------------------------------------
# M1 one-hot encoding
# ---------------------------------------------------------------------------

def category_levels(df: DataFrame, columns, max_levels: int = MAX_LEVELS) -> dict[str, list[str]]:
    """Sorted non-NULL levels per categorical column, all columns in one job.

    (column, level) pairs are made distinct (partial aggregation first) and at
    most ``max_levels * columns + 1`` of them are brought back, so the driver
    side stays bounded; a column with more than ``max_levels`` levels is an
    error.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return {}
    cap = max_levels * len(present)
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("c"), F.col(c).cast("string").alias("v")) for c in present
    ])).alias("p")).select("p.c", "p.v").where(F.col("v").isNotNull()).distinct()
    rows = pairs.limit(cap + 1).collect()
    if len(rows) > cap:
        raise ValueError(f"a categorical column has more than {max_levels} levels")
    out: dict[str, list[str]] = {c: [] for c in present}
    for r in rows:
        out[r["c"]].append(r["v"])
    for c in present:
        if len(out[c]) > max_levels:
            raise ValueError(f"{c} has more than {max_levels} levels")
        out[c].sort()
    return out


def indicator_name(col: str, level: str) -> str:
    return f"{col}_{level}".replace(".", "_").replace("`", "_")


class IndicatorEncoder(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """0/1 double columns ``<col>_<level>`` for every level but the first; drops the inputs."""

    levels = Param(Params._dummy(), "levels", "JSON object: column -> sorted levels",
                   typeConverter=TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, levels=None):
        super().__init__()
        self._setDefault(levels="{}")
        self._set(**self._input_kwargs)

    def level_map(self) -> dict[str, list[str]]:
        return json.loads(self.getOrDefault(self.levels))

    def output_columns(self) -> list[str]:
        lv = self.level_map()
        return [indicator_name(c, v) for c in self.getInputCols() for v in lv.get(c, [])[1:]]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        lv = self.level_map()
        new = []
        for c in self.getInputCols():
            for v in lv.get(c, [])[1:]:
                expr = (F.when(F.col(c).cast("string") == F.lit(v), F.lit(1.0)).otherwise(F.lit(0.0))
                        if c in dataset.columns else F.lit(0.0))
                new.append(expr.alias(indicator_name(c, v)))
        keep = [F.col(c) for c in dataset.columns if c not in self.getInputCols()]
        return dataset.select(*keep, *new)


def fit_encoder(df: DataFrame, categorical=FEATURE_COLS_CATEGORICAL) -> IndicatorEncoder:
    present = [c for c in categorical if c in df.columns]
    return IndicatorEncoder(inputCols=present, levels=json.dumps(category_levels(df, present)))


def design_matrix(frame: DataFrame, encoder: IndicatorEncoder | None = None) -> DataFrame:
    """M1: numerics pass through, categoricals become indicator columns."""
    enc = encoder or fit_encoder(frame)
    return enc.transform(frame)


def feature_columns(encoded: DataFrame, numeric=FEATURE_COLS_NUMERIC,
                    encoder: IndicatorEncoder | None = None) -> list[str]:
    nums = [c for c in numeric if c in encoded.columns]
    return nums + (encoder.output_columns() if encoder else [])


# ---------------------------------------------------------------------------
# M9 balanced class weights
# ---------------------------------------------------------------------------

def class_weights(frame: DataFrame, label: str = LABEL) -> DataFrame:
    """One row per class: ``label, n, weight`` with weight = rows / (classes * n)."""
    counts = frame.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy()  # over the per-class table: one row per class
    return counts.select(label, "n", (F.sum("n").over(w) / (F.count(F.lit(1)).over(w) * F.col("n")))
                         .alias(WEIGHT))


def with_class_weights(frame: DataFrame, label: str = LABEL) -> DataFrame:
    """Attach the balanced weight; the class table has one row per class."""
    return frame.join(F.broadcast(class_weights(frame, label).select(label, WEIGHT)), label)


# ---------------------------------------------------------------------------
# M8, M10-M14 estimators, cross-validation, grid search
# ---------------------------------------------------------------------------

def _depth(d, unlimited: int = UNLIMITED_DEPTH_DEFAULT):
    """Forest depth; an unlimited depth (None) maps to ``unlimited`` (Spark allows up to 30)."""
    return int(unlimited) if d is None else int(d)


def classifier(kind: str, *, n_train: int | None = None, params: dict | None = None,
               unlimited_depth: int = UNLIMITED_DEPTH_DEFAULT):
    """``lr``: L2 logistic regression with C = 1 (regParam = 1 / sum of weights).
    ``rf``: random forest, sqrt feature subsets, seed 42; maxDepth None means
    ``unlimited_depth``."""
    params = params or {}
    if kind == "lr":
        return LogisticRegression(featuresCol="features", labelCol=LABEL, weightCol=WEIGHT,
                                  maxIter=1000, regParam=1.0 / max(n_train or 1, 1),
                                  elasticNetParam=0.0, standardization=False, family="binomial")
    if kind == "rf":
        depth = _depth(params.get("maxDepth", None), unlimited_depth)
        return RandomForestClassifier(
            featuresCol="features", labelCol=LABEL, weightCol=WEIGHT, seed=RANDOM_SEED,
            featureSubsetStrategy="sqrt", maxMemoryInMB=FIT_MEMORY_MB, cacheNodeIds=depth > NODE_CACHE_DEPTH,
            numTrees=int(params.get("numTrees", DEFAULT_TREES)), maxDepth=depth,
            minInstancesPerNode=int(params.get("minInstancesPerNode", 1)))
    raise ValueError(f"unknown classifier {kind!r}")


def fold_classifier(kind: str, n_train: int, params: dict | None = None, prepared=None):
    """:func:`classifier` for the fits of a cross-validation; a forest is grown on cells of binned rows, which
    fits on the same rows share as ``prepared``."""
    from wardlens.operators.cells import CellForest

    clf = classifier(kind, n_train=n_train, params=params)
    return CellForest(clf, prepared) if kind == "rf" else clf


def model_pipeline(features: list[str], clf) -> Pipeline:
    """Assemble -> standardise -> classify.

    ``features`` are columns, or a :class:`VectorFeatures` that names a vector
    column. Columns are centred and scaled; a vector is scaled only, so it stays
    sparse: centring moves nothing but the intercept, which is not penalised,
    and a forest's splits do not see it.
    """
    if isinstance(features, VectorFeatures):
        return Pipeline(stages=[
            StandardScaler(inputCol=features.column, outputCol="features", withMean=False, withStd=True), clf])
    return Pipeline(stages=[
        VectorAssembler(inputCols=features, outputCol="features_raw", handleInvalid="keep"),
        StandardScaler(inputCol="features_raw", outputCol="features", withMean=True, withStd=True),
        clf,
    ])


def fit_model(features: list[str], clf, rows: DataFrame) -> PipelineModel:
    """:func:`model_pipeline` fitted on ``rows``, a task for each file of the prepared data.

    A forest's fit keeps a count per row and tree, many times the row's size on
    disk, so what a task holds must not follow the size that files pack to.
    """
    with one_task_per_file(rows.sparkSession):
        return model_pipeline(features, clf).fit(rows)


def standardise(frame: DataFrame, columns) -> DataFrame:
    """M8: ``columns`` centred and scaled to sample standard deviation 1; a constant column becomes 0.

    NULLs stay NULL and do not count. One aggregate over all columns.
    """
    columns = list(columns)
    stats = frame.agg(*[f(c).alias(f"{c}_{n}") for c in columns for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()

    def scaled(c):
        mean, std = stats[f"{c}_m"], stats[f"{c}_s"]
        value = (F.col(c) - F.lit(mean)) / F.lit(std) if std else F.when(F.col(c).isNotNull(), F.lit(0.0))
        return value.cast("double").alias(c)

    return frame.select(*[scaled(c) if c in columns else F.col(c) for c in frame.columns])


def held_out_split(data: DataFrame, held_out: int = 0) -> DataFrame:
    """Every row with ``held_out``, whether it belongs to the fold that the report is made on."""
    return data.withColumn("held_out", F.col(FOLD) == F.lit(held_out))


def fold_label_counts(data: DataFrame) -> dict[int, dict[int, int]]:
    """Rows per (fold, label) in one job: ``{fold: {label: n}}`` (k x classes entries)."""
    out: dict[int, dict[int, int]] = {}
    for r in data.groupBy(FOLD, LABEL).agg(F.count(F.lit(1)).alias("n")).collect():
        out.setdefault(r[FOLD], {})[r[LABEL]] = r["n"]
    return out


def training_counts(counts: dict[int, dict[int, int]], held_out: int | None) -> dict[int, int]:
    """Rows per label in every fold but ``held_out`` (in all folds for None)."""
    out: dict[int, int] = {}
    for fold, per in counts.items():
        if fold != held_out:
            for label, n in per.items():
                out[label] = out.get(label, 0) + n
    return out


def training_rows(data: DataFrame, counts: dict[int, dict[int, int]], held_out: int | None) -> DataFrame:
    """The rows outside fold ``held_out``, with balanced weights of these rows alone (M9)."""
    per = training_counts(counts, held_out)
    weight = F.lit(None).cast("double")
    for label, n in per.items():
        weight = F.when(F.col(LABEL) == label, F.lit(sum(per.values()) / (len(per) * n))).otherwise(weight)
    rows = data if held_out is None else data.where(F.col(FOLD) != held_out)
    return rows.withColumn(WEIGHT, weight)


def _can_score(counts: dict[int, dict[int, int]], fold: int) -> bool:
    """Whether the fold's rows and the rows outside it both hold two classes."""
    return len(counts.get(fold, {})) > 1 and len(training_counts(counts, fold)) > 1


def _fit_without(data: DataFrame, features: list[str], clf_of, counts: dict, fold: int) -> PipelineModel:
    """The pipeline fitted on the rows outside ``fold``; ``clf_of(rows trained on)`` gives the classifier."""
    n = sum(training_counts(counts, fold).values())
    return fit_model(features, clf_of(n), training_rows(data, counts, fold))


def fits_at_a_time(data: DataFrame, parallelism: int) -> int:
    """How many fits fill the cores four times, ``parallelism`` at most.

    A fit keeps its rows cached, so fits beside one that fills the cores alone
    gain nothing and push each other's rows out of memory.
    """
    with one_task_per_file(data.sparkSession):
        tasks = max(1, data.rdd.getNumPartitions())
    return max(1, min(parallelism, 4 * data.sparkSession.sparkContext.defaultParallelism // tasks))


def fold_scores(data: DataFrame, features: list[str], kind: str, k: int, params: dict | None = None,
                counts: dict | None = None, parallelism: int = 4) -> DataFrame | None:
    """``fold, label, score, n``: the score of ``n`` rows by the model of the other folds; ``parallelism`` fits at a time.

    Folds that cannot be scored (one class) are left out; None when there is no other.
    """
    from wardlens.operators.cells import CellForestModel
    from wardlens.operators.evaluation import with_probability
    from wardlens.operators.grid import run_jobs

    counts = counts if counts is not None else fold_label_counts(data)
    models: dict[int, PipelineModel] = {}

    def fit(fold):
        models[fold] = _fit_without(data, features, lambda n: fold_classifier(kind, n, params), counts, fold)

    run_jobs(data.sparkSession, [f for f in range(k) if _can_score(counts, f)], fit, fits_at_a_time(data, parallelism))
    scored = None
    for fold in sorted(models):
        rows, last = data.where(F.col(FOLD) == fold), models[fold].stages[-1]
        if isinstance(last, CellForestModel):
            rows = last.scores(PipelineModel(stages=models[fold].stages[:-1]).transform(rows), [last.size], LABEL).select(
                F.lit(fold).alias(FOLD), LABEL, F.col("scores")[0].alias("score"), "n")
        else:
            rows = with_probability(models[fold].transform(rows)).select(FOLD, LABEL, "score", F.lit(1).cast("long").alias("n"))
        scored = rows if scored is None else scored.unionByName(rows)
    return scored


def fold_aucs(data: DataFrame, features: list[str], kind: str, k: int,
              params: dict | None = None, counts: dict | None = None, parallelism: int = 4) -> DataFrame:
    """ROC-AUC per held-out fold, all folds ranked in one job; NULL (not 0) for a fold with one class."""
    from wardlens.operators.evaluation import rank_auc_by

    folds = data.sparkSession.range(k).select(F.col("id").cast("int").alias(FOLD))
    scored = fold_scores(data, features, kind, k, params, counts, parallelism)
    if scored is None:
        return folds.withColumn("auc", F.lit(None).cast("double"))
    return folds.join(rank_auc_by(scored, FOLD, n="n").select(FOLD, "auc"), FOLD, "left")


def auc_summary(aucs: DataFrame, model_name: str) -> DataFrame:
    """Mean and population std of the fold AUCs that exist."""
    return aucs.agg(F.lit(model_name).alias("model"), F.count("auc").alias("n_folds"),
                    F.avg("auc").alias("mean_auc"), F.stddev_pop("auc").alias("std_auc"))


def grid_search(data: DataFrame, features: list[str], k: int, grid: dict | None = None,
                parallelism: int = 4, unlimited_depth: int = UNLIMITED_DEPTH_DEFAULT,
                counts: dict | None = None, results_dir: str | None = None) -> tuple[dict, DataFrame]:
    """Pick the forest setting with the best mean fold AUC.

    Returns the best setting and a table of every setting: mean and population
    std over the folds that have an AUC, and the AUC of each fold (NULL for a
    fold with one class). A setting without any AUC ranks last; of equal ones
    the first wins.

    Settings that differ only in tree count and depth are read from one fit
    (:mod:`wardlens.operators.grid`); ``parallelism`` fits run at a time. AUCs
    are kept in ``results_dir`` (by default a folder in the checkpoint folder,
    named after the data and the search), so a search that was broken off goes on
    where it stopped and a finished one is only read.
    """
    from wardlens.operators.cells import Prepared
    from wardlens.operators.grid import ResultTable, RESULT_SCHEMA, data_fingerprint, grid_settings, search_results, shared_fits
    from wardlens.session import ensure_checkpoint_dir

    spark = data.sparkSession
    counts = counts if counts is not None else fold_label_counts(data)
    settings = grid_settings(grid or RF_PARAM_GRID, lambda d: _depth(d, unlimited_depth))
    if results_dir is None:
        name = data_fingerprint(data, features, k, settings, RANDOM_SEED, "cells")
        results_dir = f"{ensure_checkpoint_dir(spark).rstrip('/')}/wardlens-grid-{name}"
    fits = shared_fits(settings, default_trees=DEFAULT_TREES, default_depth=_depth(None, unlimited_depth))

    prepared = {fold: Prepared() for fold in range(k)}

    def fit_fold(params, fold):
        if not _can_score(counts, fold):
            return None
        fitted = _fit_without(data, features, lambda n: fold_classifier("rf", n, params, prepared[fold]), counts, fold)
        return fitted.stages[-1], PipelineModel(stages=fitted.stages[:-1]).transform(data.where(F.col(FOLD) == fold))

    found = search_results(ResultTable(spark, results_dir, RESULT_SCHEMA), settings, fits, range(k), fit_fold,
                           fits_at_a_time(data, parallelism))
    aucs = {(r["setting"], r["fold"]): r["auc"] for r in found.collect()}  # settings x folds
    rows = []
    for i, setting in enumerate(settings):
        per = [aucs[i, f] for f in range(k)]
        known = [a for a in per if a is not None]
        rows.append((json.dumps(setting, sort_keys=True), statistics.fmean(known) if known else None,
                     statistics.pstdev(known) if known else None, per))
    table = spark.createDataFrame(
        rows, "params string, mean_auc double, std_auc double, fold_aucs array<double>")
    best = max(range(len(rows)), key=lambda i: -1.0 if rows[i][1] is None else rows[i][1])
    return settings[best], table


# ---------------------------------------------------------------------------
# M21 train, evaluate, save
# ---------------------------------------------------------------------------

@dataclass
class TrainResult:
    model: PipelineModel | None
    importances: DataFrame | None
    tables: dict[str, DataFrame] = field(default_factory=dict)
    best_params: dict | None = None
    n_splits: int = 0
    skipped_reason: str | None = None


# Rows that a task of a fit gets: the first figure up to FIT_PARTITIONS tasks, at most the second beyond
# (every task of a fit sends the statistics of all nodes, so their number should not grow without need).
ROWS_PER_FIT_PARTITION, MOST_ROWS_PER_FIT_PARTITION = 20_000, 100_000
FIT_PARTITIONS = 16


def fit_partitions(n_rows: int) -> int:
    """Files, and so tasks, that fits read ``n_rows`` rows from."""
    return max(1, min(-(-n_rows // ROWS_PER_FIT_PARTITION), FIT_PARTITIONS), -(-n_rows // MOST_ROWS_PER_FIT_PARTITION))


def prepare(frame: DataFrame, k_max: int = N_CV_SPLITS, group_col: str = "subject_id"):
    """Encode, weight and fold a model frame; returns (data, encoder, features, k) or reason."""
    from wardlens.operators.folds import assign_folds, grouped_folds
    from wardlens.session import materialize

    # The model frame is narrow (one row per admission, a few columns); writing
    # it once means the class counts, levels, folds and every fit below read
    # these files instead of re-running the feature plan.
    frame = materialize(frame, "model-frame")
    counts = [r["n"] for r in frame.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n")).collect()]
    if len(counts) < 2:
        return None, "only one class in the target"
    k = min(k_max, min(counts))
    if k < 2:
        return None, f"smallest class has {min(counts)} rows; at least 2 are needed for folds"
    encoder = fit_levels(frame)
    encoded = with_class_weights(encoder.transform(frame))
    folds = grouped_folds(frame, group_col, LABEL, k, method="even")
    # Fits pass over the data many times: give them parallel tasks of bounded size.
    data = materialize(assign_folds(encoded, folds, group_col), "model-data", fit_partitions(sum(counts)))
    return (data, encoder, encoder.feature_names(), k), None


def train_and_evaluate(frame: DataFrame, *, save_path: str | None = None, grid: dict | None = None,
                       k_max: int = N_CV_SPLITS, refit_all: bool = False,
                       group_col: str = "subject_id", parallelism: int = 4,
                       unlimited_depth: int = UNLIMITED_DEPTH_DEFAULT,
                       results_dir: str | None = None) -> TrainResult:
    """Baseline + tuned forest with grouped folds, held-out fold 0 report, save.

    ``frame`` comes from :func:`model_frame` or :func:`readmission_frame`. With
    one class (M7) nothing is fitted or written. The saved model is refitted on
    folds other than 0 unless ``refit_all``. ``unlimited_depth`` is the
    forest depth used for a grid value of None (30, Spark's limit, by default);
    ``results_dir`` is where the search keeps its finished fits.
    """
    from wardlens.operators import evaluation as ev
    from wardlens.session import materialize

    prepared, reason = prepare(frame, k_max, group_col)
    if prepared is None:
        return TrainResult(None, None, skipped_reason=reason)
    data, encoder, features, k = prepared

    counts = fold_label_counts(data)
    lr_aucs = fold_aucs(data, features, "lr", k, counts=counts, parallelism=parallelism)
    best, grid_table = grid_search(data, features, k, grid, parallelism, unlimited_depth, counts, results_dir)
    # The search has scored the best setting on these folds already.
    rf_aucs = grid_table.where(F.col("params") == json.dumps(best, sort_keys=True)).select(
        F.posexplode("fold_aucs").alias("fold", "auc"))

    train = training_rows(data, counts, None if refit_all else 0)
    test = data.where(F.col(FOLD) == 0)
    fitted = fit_model(features, classifier("rf", params=best), train)
    model = PipelineModel(stages=[encoder, *fitted.stages])
    # Four tables read the held-out scores: score once.
    pred = materialize(ev.with_probability(fitted.transform(test)).select(ev.LABEL, ev.PRED, ev.SCORE),
                       "held-out-scores")

    tables = {
        "cv_scores": auc_summary(lr_aucs, "logistic_regression").unionByName(
            auc_summary(rf_aucs, "random_forest")),
        "fold_auc_lr": lr_aucs,
        "fold_auc_rf": rf_aucs,
        "grid": grid_table,
        "classification_report": ev.classification_report(pred),
        "confusion": ev.confusion_counts(pred),
    }
    if len([c for c, n in counts.get(0, {}).items() if n > 0]) > 1:
        tables["held_out_auc"] = ev.auc_table(pred)
        tables["roc"] = ev.roc_points(pred)
    importances = ev.feature_importance(fitted.stages[-1], features)
    if save_path:
        from wardlens.sources.models import save_model
        save_model(model, save_path)
    return TrainResult(model, importances, tables, best, k)
