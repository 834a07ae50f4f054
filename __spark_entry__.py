"""

Every query reads the driver's tables through the hospital-shaped stand-in
views of :mod:`wardlens.sources.standin` and runs the library operator over
the whole tables. The oracle SQL builds the same stand-in views as CTEs over
the pre-registered tables and states each query independently in SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wardlens.sources import standin

SMOKE_DIR = "/root/testdata/sf0.001"


def _tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return standin.standin_tables(spark, sf_dir)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the admission-level feature table on sf0.001."""
    from wardlens.operators.features import build_cohort_features

    return build_cohort_features(_tables(spark, SMOKE_DIR))


# --------------------------------------------------------------------------
# Spark queries
# --------------------------------------------------------------------------

def q_cohort_summary(spark, d):
    from wardlens.operators.descriptive import cohort_summary
    t = _tables(spark, d)
    return cohort_summary(t["patients"], t["admissions"])


def q_los_by_careunit(spark, d):
    from wardlens.operators.descriptive import length_of_stay_by_careunit
    return length_of_stay_by_careunit(standin.icustays(spark, d))


def q_top_diagnoses(spark, d):
    from wardlens.operators.descriptive import top_diagnoses
    return top_diagnoses(standin.diagnoses_icd(spark, d), standin.d_icd_diagnoses(spark, d), 10)


def q_mortality_by_admission_type(spark, d):
    from wardlens.operators.descriptive import mortality_by_admission_type
    return mortality_by_admission_type(standin.admissions(spark, d))


def q_mortality_by_careunit(spark, d):
    from wardlens.operators.descriptive import mortality_by_careunit
    return mortality_by_careunit(standin.admissions(spark, d), standin.icustays(spark, d))


def q_mortality_by_careunit_dedup(spark, d):
    from wardlens.operators.descriptive import mortality_by_careunit
    return mortality_by_careunit(standin.admissions(spark, d), standin.icustays(spark, d), dedup=True)


def q_mortality_chi_square(spark, d):
    from wardlens.operators.descriptive import mortality_by_admission_type
    from wardlens.operators.stats import mortality_significance_test
    q4 = mortality_by_admission_type(standin.admissions(spark, d), sort=False)
    return mortality_significance_test(q4, "mortality by admission type")


def q_readmission_intervals(spark, d):
    from wardlens.operators.sequences import readmission_intervals
    return readmission_intervals(standin.admissions(spark, d))


def q_readmission_target(spark, d):
    from wardlens.operators.sequences import readmission_target
    return readmission_target(standin.admissions(spark, d))


def q_event_gaps(spark, d):
    from wardlens.operators.sequences import event_gaps
    return event_gaps(standin.events(spark, d))


def q_lab_window_24h(spark, d):
    from wardlens.operators.features import lab_window
    return lab_window(standin.labevents(spark, d), standin.admissions(spark, d))


def q_icu_rollup(spark, d):
    from wardlens.operators.features import icu_rollup
    return icu_rollup(standin.icustays(spark, d))


def q_diagnosis_rollup(spark, d):
    from wardlens.operators.features import diagnosis_rollup
    return diagnosis_rollup(standin.diagnoses_icd(spark, d))


def q_cohort_base(spark, d):
    from wardlens.operators.features import cohort_base
    return cohort_base(_tables(spark, d))


def _scratch(spark, name):
    import uuid
    from wardlens.session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/wardlens-{name}-{uuid.uuid4().hex}"


def q_cohort_base_store(spark, d):
    """The feature base over a published store: every join reads co-located buckets."""
    from wardlens.operators.features import cohort_base
    from wardlens.sources.store import open_store, publish_store
    store = _scratch(spark, "store")
    publish_store(_tables(spark, d), store)
    return cohort_base(open_store(spark, store))


def q_load_quality(spark, d):
    """Rows and uncastable values per column of CSV tables with damaged values and quoted line breaks."""
    from pyspark.sql import functions as F
    from wardlens.sources.store import load_quality
    from wardlens.sources.tables import load_and_publish
    t, folder = _tables(spark, d), _scratch(spark, "csv")
    damaged = lambda c, every, bad: F.when(F.col("hadm_id") % every == 0, F.lit(bad)).otherwise(F.col(c).cast("string"))
    text = {"ADMISSIONS": t["admissions"].withColumns({"subject_id": damaged("subject_id", 101, "x1"),
                                                       "admittime": damaged("admittime", 103, "soon")}),
            "PATIENTS": t["patients"],
            "D_ICD_DIAGNOSES": t["d_icd_diagnoses"].withColumn("short_title", F.concat("short_title", F.lit('\nsecond "line"')))}
    for name, df in text.items():
        df.write.option("header", True).option("escape", '"').option("quoteAll", True).csv(f"{folder}/{name}.csv")
    load_and_publish(spark, folder, f"{folder}/store")
    return load_quality(spark, f"{folder}/store")


def q_cohort_features(spark, d):
    from wardlens.operators.features import build_cohort_features
    return build_cohort_features(_tables(spark, d))


def q_cohort_features_gaps(spark, d):
    """The feature table over tables with NULL times, keys and units: every fill meets rows."""
    from wardlens.operators.features import build_cohort_features
    return build_cohort_features(standin.gap_tables(spark, d))


def q_top_diagnoses_gaps(spark, d):
    """Most frequent codes where a third of the diagnoses have none in the dictionary."""
    from wardlens.operators.descriptive import top_diagnoses
    t = standin.gap_tables(spark, d)
    return top_diagnoses(t["diagnoses_icd"], t["d_icd_diagnoses"], 200)


def q_cohort_feature_report(spark, d):
    from wardlens.operators.features import build_cohort_features, feature_report
    return feature_report(build_cohort_features(_tables(spark, d)))


def _features(spark, d):
    from wardlens.operators.features import build_cohort_features
    return build_cohort_features(_tables(spark, d))


def _mortality_frame(spark, d):
    from wardlens.operators.modeling import model_frame
    return model_frame(_features(spark, d))


def _formula_scored(spark, d):
    """Rule score on the feature table: share of abnormal labs in the first 24 h."""
    from pyspark.sql import functions as F
    frame = _mortality_frame(spark, d)
    score = F.col("pct_abnormal_labs_24h") / F.lit(100.0)
    return frame.select("subject_id", "hadm_id", "label", score.alias("score"),
                        F.when(score >= F.lit(0.5), F.lit(1.0)).otherwise(F.lit(0.0)).alias("prediction"))


def q_label_join(spark, d):
    from wardlens.operators.modeling import merge_target
    from wardlens.operators.sequences import readmission_target
    return merge_target(_features(spark, d),
                        readmission_target(standin.admissions(spark, d), sort=False))


def q_readmission_cohort(spark, d):
    from wardlens.operators.modeling import readmission_frame
    return readmission_frame(q_label_join(spark, d))


def q_design_matrix(spark, d):
    from wardlens.operators.modeling import design_matrix
    return design_matrix(_mortality_frame(spark, d))


def q_design_matrix_sparse(spark, d):
    """The non-zero entries of the design matrix, with one more column of a level per admission day."""
    from pyspark.sql import functions as F
    from wardlens.operators.levels import design_matrix_sparse
    days = standin.admissions(spark, d).select("hadm_id", F.to_date("admittime").cast("string").alias("admit_day"))
    frame = _mortality_frame(spark, d).join(days, "hadm_id")
    return design_matrix_sparse(frame, categorical=["gender", "admission_type", "first_icu_careunit", "admit_day"])


def q_class_weights(spark, d):
    from wardlens.operators.modeling import class_weights
    return class_weights(_mortality_frame(spark, d))


def q_cv_splits(spark, d):
    from wardlens.operators.folds import cv_splits
    return cv_splits(_mortality_frame(spark, d), "label")


def q_grouped_folds(spark, d):
    from wardlens.operators.folds import fold_count, grouped_folds
    frame = _mortality_frame(spark, d)
    _, _, k = fold_count(frame, "label")
    return grouped_folds(frame, "subject_id", "label", k)


def q_even_folds(spark, d):
    """Grouped folds dealt greedily by positives (the folds that training uses)."""
    from wardlens.operators.folds import fold_count, grouped_folds
    frame = _mortality_frame(spark, d)
    return grouped_folds(frame, "subject_id", "label", fold_count(frame, "label")[2], method="even")


def q_fold_balance(spark, d):
    from wardlens.operators.folds import assign_folds, fold_balance
    frame = _mortality_frame(spark, d)
    return fold_balance(assign_folds(frame, q_grouped_folds(spark, d), "subject_id"), "subject_id", "label")


def q_confusion_counts(spark, d):
    from wardlens.operators.evaluation import confusion_counts
    return confusion_counts(_formula_scored(spark, d))


def q_classification_report(spark, d):
    from wardlens.operators.evaluation import classification_report
    return classification_report(_formula_scored(spark, d))


def q_roc_points(spark, d):
    from wardlens.operators.evaluation import roc_points
    return roc_points(_formula_scored(spark, d))


def q_rank_auc(spark, d):
    from wardlens.operators.evaluation import rank_auc
    return rank_auc(_formula_scored(spark, d))


def q_load_report(spark, d):
    from wardlens.sources.tables import load_report
    return load_report(_tables(spark, d))


def q_fold_rank_auc(spark, d):
    """Rank AUC of the rule score on each grouped fold, with mean and population std."""
    from wardlens.operators.evaluation import fold_rank_auc
    from wardlens.operators.folds import assign_folds
    scored = _formula_scored(spark, d)
    return fold_rank_auc(assign_folds(scored, q_grouped_folds(spark, d), "subject_id"))


# An unlimited forest depth as the queries read it (SURVEY T13; 30, Spark's limit, is the library's default).
_UNLIMITED_DEPTH = 10


def q_grid_table(spark, d):
    """All 36 settings of the grid on the grouped folds; finished fits are kept in the checkpoint folder."""
    from wardlens.operators.modeling import grid_search, prepare
    (data, _, features, k), _ = prepare(_mortality_frame(spark, d))
    return grid_search(data, features, k, unlimited_depth=_UNLIMITED_DEPTH)[1]


# The setting of the grid that the queries below fit; grid_table fits all of them.
_SMALL_FOREST = {"numTrees": 100, "maxDepth": 5, "minInstancesPerNode": 1}


def q_cv_scores(spark, d):
    """Fold ROC-AUC summary of the baseline and a forest on the grouped folds."""
    from wardlens.operators.modeling import auc_summary, fold_aucs, prepare
    (data, _, features, k), _ = prepare(_mortality_frame(spark, d))
    return auc_summary(fold_aucs(data, features, "lr", k), "logistic_regression").unionByName(
        auc_summary(fold_aucs(data, features, "rf", k, _SMALL_FOREST), "random_forest"))


def q_all_descriptive(spark, d):
    """Q9: rows of every descriptive query, run over one set of tables."""
    from functools import reduce
    from pyspark.sql import functions as F
    from wardlens.operators.descriptive import run_all_descriptive_queries
    parts = [df.agg(F.lit(name).alias("name"), F.count(F.lit(1)).alias("n_rows"))
             for name, df in run_all_descriptive_queries(_tables(spark, d)).items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def q_standardised(spark, d):
    """M8: the numeric features, centred and scaled, to six decimals."""
    from pyspark.sql import functions as F
    from wardlens.operators.modeling import standardise
    from wardlens.schemas import FEATURE_COLS_NUMERIC
    from wardlens.session import materialize
    frame = materialize(_mortality_frame(spark, d).select("hadm_id", *FEATURE_COLS_NUMERIC), "numeric")
    scaled = standardise(frame, FEATURE_COLS_NUMERIC)
    return scaled.select("hadm_id", *[F.round(F.col(c), 6).alias(c) for c in FEATURE_COLS_NUMERIC])


def q_held_out_split(spark, d):
    """Rows and positives inside and outside the held-out fold."""
    from pyspark.sql import functions as F
    from wardlens.operators.folds import assign_folds
    from wardlens.operators.modeling import held_out_split
    split = held_out_split(assign_folds(_mortality_frame(spark, d), q_even_folds(spark, d), "subject_id"))
    return split.groupBy("held_out").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.col("label").cast("long")).alias("n_pos"),
                                         F.count_distinct("subject_id").alias("n_groups"))


def q_one_class_guard(spark, d):
    """M7: training on admissions with one outcome is refused."""
    from pyspark.sql import functions as F
    from wardlens.operators.modeling import train_and_evaluate
    alive = _mortality_frame(spark, d).where("label = 0")
    refused = train_and_evaluate(alive).skipped_reason is not None
    return alive.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(refused).alias("refused"))


def q_saved_scores(spark, d):
    """Scores of the saved and loaded baseline, against those of the fitted one."""
    from pyspark.ml import PipelineModel
    from pyspark.sql import functions as F
    from wardlens.operators.modeling import (classifier, fit_model, fold_label_counts, model_frame, prepare,
                                             training_counts, training_rows)
    from wardlens.operators.scoring import score_admissions
    from wardlens.session import materialize
    from wardlens.sources.models import load_model, save_model
    table = materialize(_features(spark, d), "features")
    (data, encoder, features, _k), _ = prepare(model_frame(table))
    counts = fold_label_counts(data)
    fitted = fit_model(features, classifier("lr", n_train=sum(training_counts(counts, 0).values())),
                       training_rows(data, counts, 0))
    model = PipelineModel(stages=[encoder, *fitted.stages])
    path = save_model(model, _scratch(spark, "model"))
    both = score_admissions(load_model(path), table).join(
        score_admissions(model, table, out_col="before"), ["subject_id", "hadm_id"])
    return both.agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("risk") == F.col("before")).alias("n_equal"),
                    F.count_if(F.col("risk").between(0.0, 1.0)).alias("n_probabilities"),
                    (F.max("risk") > F.min("risk")).alias("ranks"))


# Fits end at 5e-7 on these tables.
_GRADIENT_LIMIT = 1e-5


def q_lr_certificate(spark, d):
    """Whether the fitted baseline is the minimum of its training loss, per coefficient."""
    from pyspark.sql import functions as F
    from wardlens.operators.evaluation import logistic_gradient
    from wardlens.operators.modeling import (classifier, fit_model, fold_label_counts, prepare, training_counts,
                                             training_rows)
    (data, _, features, _k), _ = prepare(_mortality_frame(spark, d))
    counts = fold_label_counts(data)
    rows = training_rows(data, counts, None)
    fitted = fit_model(features, classifier("lr", n_train=sum(training_counts(counts, None).values())), rows)
    scaled = fitted.stages[0].transform(rows)
    return logistic_gradient(fitted.stages[-1], scaled, features).select(
        "feature", (F.abs("gradient") < _GRADIENT_LIMIT).alias("at_minimum"))


def q_feature_importance(spark, d):
    """Forest fitted on folds other than 0; importance per design-matrix column."""
    from wardlens.operators.evaluation import feature_importance
    from wardlens.operators.modeling import (classifier, fit_model, fold_label_counts, prepare,
                                             training_rows)
    (data, _, features, _k), _ = prepare(_mortality_frame(spark, d))
    fitted = fit_model(features, classifier("rf", params=_SMALL_FOREST), training_rows(data, fold_label_counts(data), 0))
    return feature_importance(fitted.stages[-1], features)


def q_score_admissions(spark, d):
    """Fit, save, load the mortality model and score every admission of the feature table."""
    import uuid
    from pyspark.ml import PipelineModel
    from wardlens.operators.modeling import (classifier, fit_model, fold_label_counts, model_frame, prepare,
                                             training_rows)
    from wardlens.operators.scoring import score_admissions
    from wardlens.session import ensure_checkpoint_dir, materialize
    from wardlens.sources.models import load_model, save_model
    table = materialize(_features(spark, d), "features")
    (data, encoder, features, _k), _ = prepare(model_frame(table))
    fitted = fit_model(features, classifier("rf", params=_SMALL_FOREST), training_rows(data, fold_label_counts(data), 0))
    path = f"{ensure_checkpoint_dir(spark)}/wardlens-models/{uuid.uuid4().hex}"
    save_model(PipelineModel(stages=[encoder, *fitted.stages]), path)
    return score_admissions(load_model(path), table)


def q_mortality_chi_square_careunit(spark, d):
    from wardlens.operators.descriptive import mortality_by_careunit
    from wardlens.operators.stats import mortality_significance_test
    q5 = mortality_by_careunit(standin.admissions(spark, d), standin.icustays(spark, d), sort=False)
    return mortality_significance_test(q5, "mortality by care unit")


def q_contingency_table(spark, d):
    from wardlens.operators.descriptive import mortality_by_admission_type
    from wardlens.operators.stats import contingency_table
    q4 = mortality_by_admission_type(standin.admissions(spark, d), sort=False)
    return contingency_table(q4, "admission_type")


def q_readmission_summary(spark, d):
    from wardlens.operators.sequences import readmission_intervals, readmission_summary
    return readmission_summary(readmission_intervals(standin.admissions(spark, d), sort=False))


def _llm():
    """The training-data queries, or None where that subpackage is not installed."""
    try:
        from wardlens.llm import queries as llm
    except ModuleNotFoundError as e:
        if e.name is None or not e.name.startswith("wardlens.llm"):
            raise
        return None
    return llm


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    llm = _llm()
    return {
        **(llm.QUERIES if llm else {}),
        "cohort_summary": q_cohort_summary,
        "los_by_careunit": q_los_by_careunit,
        "top_diagnoses": q_top_diagnoses,
        "mortality_by_admission_type": q_mortality_by_admission_type,
        "mortality_by_careunit": q_mortality_by_careunit,
        "mortality_by_careunit_dedup": q_mortality_by_careunit_dedup,
        "mortality_chi_square": q_mortality_chi_square,
        "readmission_intervals": q_readmission_intervals,
        "readmission_target": q_readmission_target,
        "event_gaps": q_event_gaps,
        "lab_window_24h": q_lab_window_24h,
        "icu_rollup": q_icu_rollup,
        "diagnosis_rollup": q_diagnosis_rollup,
        "cohort_base": q_cohort_base,
        "cohort_base_store": q_cohort_base_store,
        "load_quality": q_load_quality,
        "cohort_features": q_cohort_features,
        "cohort_features_gaps": q_cohort_features_gaps,
        "top_diagnoses_gaps": q_top_diagnoses_gaps,
        "cohort_feature_report": q_cohort_feature_report,
        "label_join": q_label_join,
        "readmission_cohort": q_readmission_cohort,
        "design_matrix": q_design_matrix,
        "design_matrix_sparse": q_design_matrix_sparse,
        "class_weights": q_class_weights,
        "cv_splits": q_cv_splits,
        "grouped_folds": q_grouped_folds,
        "even_folds": q_even_folds,
        "fold_balance": q_fold_balance,
        "confusion_counts": q_confusion_counts,
        "classification_report": q_classification_report,
        "roc_points": q_roc_points,
        "rank_auc": q_rank_auc,
        "load_report": q_load_report,
        "fold_rank_auc": q_fold_rank_auc,
        "grid_table": q_grid_table,
        "lr_certificate": q_lr_certificate,
        "all_descriptive": q_all_descriptive,
        "standardised": q_standardised,
        "held_out_split": q_held_out_split,
        "one_class_guard": q_one_class_guard,
        "saved_scores": q_saved_scores,
        "cv_scores": q_cv_scores,
        "feature_importance": q_feature_importance,
        "score_admissions": q_score_admissions,
        "mortality_chi_square_careunit": q_mortality_chi_square_careunit,
        "contingency_table": q_contingency_table,
        "readmission_summary": q_readmission_summary,
    }


# --------------------------------------------------------------------------
# DuckDB oracles
# --------------------------------------------------------------------------

# The stand-in mapping of wardlens.sources.standin, in SQL.
_STANDIN = """
patients AS (
  SELECT c_custkey AS subject_id,
         CASE WHEN c_mktsegment IN ('AUTOMOBILE', 'BUILDING', 'FURNITURE') THEN 'M' ELSE 'F' END AS gender,
         CAST(DATE '1890-01-01' + CAST((c_custkey * 37) % 36500 AS INTEGER) AS TIMESTAMP) AS dob
  FROM customer),
admissions AS (
  SELECT o_custkey AS subject_id, o_orderkey AS hadm_id, o_orderdate AS admittime,
         o_orderdate + to_hours(CAST((o_orderkey * 7) % 240 AS BIGINT)) AS dischtime,
         o_orderpriority AS admission_type, o_orderstatus AS admission_location,
         'I' || CAST(o_custkey % 4 AS VARCHAR) AS insurance,
         'E' || CAST(o_custkey % 5 AS VARCHAR) AS ethnicity,
         CAST(o_orderstatus = 'P' AS INTEGER) AS hospital_expire_flag
  FROM orders),
icustays AS (
  SELECT l_orderkey AS hadm_id,
         CAST(('0x' || substr(md5(concat_ws('|', l_orderkey, l_linenumber, l_partkey, l_suppkey)), 1, 15)) AS BIGINT) AS icustay_id,
         l_returnflag || l_linestatus AS first_careunit, l_shipdate AS intime, l_quantity AS los
  FROM lineitem),
diagnoses_icd AS (
  SELECT l_orderkey AS hadm_id, l_linenumber AS seq_num, CAST(l_partkey AS VARCHAR) AS icd9_code
  FROM lineitem),
d_icd_diagnoses AS (
  SELECT CAST(p_partkey AS VARCHAR) AS icd9_code, p_name AS short_title FROM part),
labevents AS (
  SELECT l_orderkey AS hadm_id, l_shipdate AS charttime,
         CASE WHEN l_linestatus = 'O' THEN 'abnormal' END AS flag
  FROM lineitem)
"""

_DAYS = "86400000000.0::DOUBLE"

# Every feature from its definition, one admission at a time: an admission's stays, codes and
# labs as lists, which the columns are then read from. ``t`` is put before the table names.
_LISTS = """
stays AS (SELECT hadm_id, list({{'t': intime, 'i': icustay_id, 'u': first_careunit, 'd': los}} ORDER BY intime, icustay_id) AS s
          FROM {t}icustays GROUP BY hadm_id),
codes AS (SELECT hadm_id, len(list_distinct(list(icd9_code))) AS n FROM {t}diagnoses_icd GROUP BY hadm_id),
labs AS (SELECT hadm_id, list({{'t': charttime, 'a': flag IS NOT DISTINCT FROM 'abnormal'}}) AS x
         FROM {t}labevents WHERE hadm_id IS NOT NULL GROUP BY hadm_id),
rows AS (
  SELECT a.*, p.gender, date_diff('microsecond', p.dob, a.admittime) / 86400000000.0::DOUBLE AS age_days,
         CASE WHEN p.dob IS NOT NULL  -- least() skips a NULL
              THEN least(date_diff('microsecond', p.dob, a.admittime) / 86400000000.0::DOUBLE / 365.25, 90.0) END AS age,
         date_diff('microsecond', a.admittime, a.dischtime) / 86400000000.0::DOUBLE AS stay, stays.s, codes.n AS codes,
         list_filter(labs.x, lambda v: v.t <= a.admittime + INTERVAL 1 DAY) AS seen
  FROM {t}admissions a JOIN {t}patients p USING (subject_id)
  LEFT JOIN stays USING (hadm_id) LEFT JOIN codes USING (hadm_id) LEFT JOIN labs USING (hadm_id)),
middle AS (
  SELECT (st[(len(st) + 1) // 2] + st[len(st) // 2 + 1]) / 2 AS stay, (ag[(len(ag) + 1) // 2] + ag[len(ag) // 2 + 1]) / 2 AS age
  FROM (SELECT list(stay ORDER BY stay) FILTER (stay IS NOT NULL) AS st, list(age ORDER BY age) FILTER (age IS NOT NULL) AS ag
        FROM rows))"""

_FEATURES = """
features AS (
  SELECT subject_id, hadm_id, admission_type, admission_location, insurance, ethnicity, hospital_expire_flag, gender,
         COALESCE(stay, (SELECT stay FROM middle)) AS hospital_los_days, COALESCE(len(s), 0) AS n_icu_stays,
         COALESCE(list_sum(list_transform(s, lambda v: v.d)), 0) AS total_icu_los_days,
         COALESCE(s[1].u, 'No_ICU_Stay') AS first_icu_careunit, COALESCE(codes, 0) AS n_diagnoses,
         COALESCE(len(seen), 0) AS n_lab_results_24h, COALESCE(age, (SELECT age FROM middle)) AS age_years,
         CASE WHEN len(seen) > 0 THEN 100.0::DOUBLE * len(list_filter(seen, lambda v: v.a)) / len(seen) ELSE 0 END
           AS pct_abnormal_labs_24h
  FROM rows)"""

_BASE = """
SELECT subject_id, hadm_id, admission_type, admission_location, insurance, ethnicity, hospital_expire_flag, gender,
       age_days, stay AS hospital_los_days, len(s) AS n_icu_stays,
       list_sum(list_transform(s, lambda v: v.d)) AS total_icu_los_days, s[1].u AS first_icu_careunit, codes AS n_diagnoses,
       CASE WHEN len(seen) > 0 THEN len(seen) END AS n_lab_results_24h,
       CASE WHEN len(seen) > 0 THEN len(list_filter(seen, lambda v: v.a)) END AS n_abnormal_labs_24h
FROM rows"""


_TARGET = f"""
target AS (
  SELECT subject_id, hadm_id, hospital_expire_flag, dischtime,
         date_diff('microsecond', dischtime, LEAD(admittime) OVER w) / {_DAYS} AS days_to_next_admission,
         CASE WHEN LEAD(admittime) OVER w IS NULL THEN NULL
              WHEN date_diff('microsecond', dischtime, LEAD(admittime) OVER w) / {_DAYS} <= 30 THEN 1
              ELSE 0 END AS readmit_30d
  FROM admissions WINDOW w AS (PARTITION BY subject_id ORDER BY admittime, hadm_id))"""

_FRAME = """
frame AS (
  SELECT subject_id, hadm_id, age_years, n_lab_results_24h, pct_abnormal_labs_24h, gender,
         admission_type, first_icu_careunit, CAST(hospital_expire_flag AS INTEGER) AS label
  FROM features WHERE hospital_expire_flag IS NOT NULL)"""

_FOLDS = """
groups AS (
  SELECT subject_id, COUNT(*) AS n_rows, CAST(SUM(CAST(label AS BIGINT)) AS BIGINT) AS n_pos,
         md5(concat_ws('|', '42', CAST(subject_id AS VARCHAR))) AS h
  FROM frame GROUP BY subject_id),
kk AS (SELECT LEAST(5, MIN(n)) AS k FROM (SELECT label, COUNT(*) AS n FROM frame GROUP BY label)),
folds AS (
  SELECT subject_id, n_rows, n_pos,
         CAST((ROW_NUMBER() OVER (ORDER BY n_pos DESC, n_rows DESC, h) - 1) % k AS INTEGER) AS fold
  FROM groups, kk)"""

# Greedy folds, one group at a time: the whole state of the folds is carried from group to group.
_EVEN = """
ranked AS (SELECT *, row_number() OVER (PARTITION BY n_pos, n_rows ORDER BY h) - 1 AS place FROM groups),
queue AS (SELECT n_pos, n_rows, row_number() OVER (ORDER BY n_pos DESC, n_rows DESC, h) AS i FROM groups),
start AS (SELECT list({'p': 0::BIGINT, 'r': 0::BIGINT, 'f': f}) AS state FROM range((SELECT k FROM kk)) t(f)),
dealt AS (
  WITH RECURSIVE walk AS (
    SELECT 0::BIGINT AS i, state, NULL::BIGINT AS n_pos, NULL::BIGINT AS n_rows, NULL::BIGINT AS fold FROM start
    UNION ALL
    SELECT q.i, list_transform(w.state, lambda x: CASE WHEN x.f = w.f
                 THEN {'p': x.p + q.n_pos, 'r': x.r + q.n_rows, 'f': x.f} ELSE x END), q.n_pos, q.n_rows, w.f
    FROM (SELECT walk.i, walk.state, n.n_pos AS np,
                 list_min(list_transform(walk.state, lambda x:
                    {'a': CASE WHEN n.n_pos > 0 THEN x.p ELSE 0 END, 'b': x.r, 'f': x.f})).f AS f
          FROM walk JOIN queue n ON n.i = walk.i + 1) w JOIN queue q ON q.i = w.i + 1)
  SELECT n_pos, n_rows, fold, COUNT(*) AS n FROM walk WHERE i > 0 GROUP BY n_pos, n_rows, fold),
ends AS (
  SELECT s.n_pos, s.n_rows, x.f AS fold,
         SUM(COALESCE(d.n, 0)) OVER (PARTITION BY s.n_pos, s.n_rows ORDER BY x.f) AS until
  FROM (SELECT DISTINCT n_pos, n_rows FROM groups) s, range((SELECT k FROM kk)) x(f)
  LEFT JOIN dealt d ON d.n_pos = s.n_pos AND d.n_rows = s.n_rows AND d.fold = x.f),
even AS (
  SELECT g.subject_id, g.n_rows, g.n_pos, CAST(COUNT(e.fold) AS INTEGER) AS fold
  FROM ranked g LEFT JOIN ends e ON e.n_pos = g.n_pos AND e.n_rows = g.n_rows AND e.until <= g.place
  GROUP BY g.subject_id, g.n_rows, g.n_pos)"""

_SCORED = """
scored AS (
  SELECT subject_id, hadm_id, label, pct_abnormal_labs_24h / 100.0::DOUBLE AS score,
         CASE WHEN pct_abnormal_labs_24h / 100.0::DOUBLE >= 0.5 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM frame)"""

_FEATURE_CTES = (_LISTS.format(t=""), _FEATURES)

# Levels of the categoricals in the stand-in data (first level of each is the baseline).
_DUMMIES = {
    "gender": ["F", "M"],
    "admission_type": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
    "first_icu_careunit": ["AF", "AO", "NF", "NO", "No_ICU_Stay", "RF", "RO"],
}


def _dummy_sql() -> str:
    parts = []
    for col, levels in _DUMMIES.items():
        for v in levels[1:]:
            parts.append(f"CASE WHEN {col} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"{col}_{v}\"")
    return ",\n       ".join(parts)


# The variant with gaps (wardlens.sources.standin.gap_tables): the stand-in tables under
# their names, read through one more SELECT each.
_GAPS = _STANDIN + """,
g_patients AS (SELECT * REPLACE (CASE WHEN subject_id % 89 <> 0 THEN dob END AS dob) FROM patients),
g_admissions AS (SELECT * REPLACE (CASE WHEN hadm_id % 97 <> 0 THEN dischtime END AS dischtime) FROM admissions),
g_icustays AS (SELECT * REPLACE (CASE WHEN icustay_id % 5 <> 0 THEN first_careunit END AS first_careunit) FROM icustays),
g_labevents AS (SELECT * REPLACE (CASE WHEN hadm_id % 7 <> 0 THEN hadm_id END AS hadm_id) FROM labevents),
g_diagnoses_icd AS (SELECT * REPLACE (CASE WHEN seq_num % 3 = 0 THEN 'X' || icd9_code ELSE icd9_code END AS icd9_code)
                FROM diagnoses_icd)"""

_PAIRS = """
pairs AS (
  SELECT s.first_careunit AS unit, s.hadm_id, COUNT(*) AS stays,
         (SELECT hospital_expire_flag FROM admissions WHERE hadm_id = s.hadm_id) AS died
  FROM icustays s WHERE s.hadm_id IN (SELECT hadm_id FROM admissions) GROUP BY s.first_careunit, s.hadm_id)"""


def _with(select: str, *ctes: str) -> str:
    return "WITH " + ",".join([_STANDIN, *ctes]) + "\n" + select


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL per query key, over the pre-registered driver tables."""
    rate = "ROUND(100.0::DOUBLE * SUM({d}) / {n}, 1)"
    w_adm = "(PARTITION BY subject_id ORDER BY admittime, hadm_id)"
    llm = _llm()
    return {
        **(llm.ORACLES if llm else {}),
        "cohort_summary": _with("""
SELECT COUNT(*) AS n_patients, CAST(SUM(len(taken)) AS BIGINT) AS n_admissions,
       CAST(SUM(greatest(rows, 1)) FILTER (gender = 'M') AS BIGINT) AS n_male,
       CAST(SUM(greatest(rows, 1)) FILTER (gender = 'F') AS BIGINT) AS n_female
FROM (SELECT gender, (SELECT COUNT(*) FROM admissions a WHERE a.subject_id = q.subject_id) AS rows,
             (SELECT list(DISTINCT hadm_id) FROM admissions a WHERE a.subject_id = q.subject_id) AS taken
      FROM patients q)"""),
        "los_by_careunit": _with("""
SELECT first_careunit, len(v) AS n_stays, round(list_sum(v) / len(v), 2) AS avg_los_days,
       round(v[1], 2) AS min_los_days, round(v[-1], 2) AS max_los_days
FROM (SELECT first_careunit, list(los ORDER BY los) FILTER (los IS NOT NULL) AS v FROM icustays GROUP BY first_careunit)
WHERE len(v) > 0"""),
        "top_diagnoses": _with("""
SELECT code AS icd9_code, (SELECT ANY_VALUE(short_title) FROM d_icd_diagnoses WHERE icd9_code = code) AS short_title,
       uses AS n_occurrences
FROM (SELECT icd9_code AS code, COUNT(*) AS uses FROM diagnoses_icd GROUP BY ALL)
ORDER BY uses DESC, code NULLS FIRST LIMIT 10"""),
        "mortality_by_admission_type": _with(f"""
SELECT admission_type, COUNT(*) AS n_admissions,
       CAST(SUM(hospital_expire_flag) AS BIGINT) AS n_deaths,
       {rate.format(d='hospital_expire_flag', n='COUNT(*)')} AS mortality_rate_pct
FROM admissions GROUP BY admission_type"""),
        # An (admission, unit) pair at a time, with its stays.
        "mortality_by_careunit": _with("""
SELECT unit AS first_careunit, COUNT(*) AS n_admissions, CAST(SUM(died * stays) AS BIGINT) AS n_deaths,
       round(SUM(died * stays) * 100.0::DOUBLE / COUNT(*), 1) AS mortality_rate_pct
FROM pairs GROUP BY unit""", _PAIRS),
        "mortality_by_careunit_dedup": _with("""
SELECT unit AS first_careunit, COUNT(*) AS n_admissions, COUNT(*) FILTER (died = 1) AS n_deaths,
       round(COUNT(*) FILTER (died = 1) * 100.0::DOUBLE / COUNT(*), 1) AS mortality_rate_pct
FROM pairs GROUP BY unit""", _PAIRS),
        "mortality_chi_square": _with("""
SELECT 'mortality by admission type' AS label, ROUND(chi, 6) AS chi_square,
       CAST(g - 1 AS INTEGER) AS dof,
       ROUND(exp(-chi / 2) * list_sum(list_transform(range(CAST((g - 1) / 2 AS BIGINT)),
             lambda i: pow(chi / 2, i) / factorial(CAST(i AS INTEGER)))), 6) AS p_value,
       ROUND(r_min * LEAST(c_d, c_s) / n, 6) AS min_expected,
       (r_min * LEAST(c_d, c_s) / n < 5) AS unreliable
FROM (
  SELECT SUM(POWER(died - r * c_d / n, 2) / (r * c_d / n)
             + POWER(survived - r * c_s / n, 2) / (r * c_s / n)) AS chi,
         ANY_VALUE(g) AS g, ANY_VALUE(n) AS n, ANY_VALUE(c_d) AS c_d, ANY_VALUE(c_s) AS c_s,
         ANY_VALUE(r_min) AS r_min
  FROM (
    SELECT CAST(died AS DOUBLE) AS died, CAST(r - died AS DOUBLE) AS survived, CAST(r AS DOUBLE) AS r,
           COUNT(*) OVER () AS g, CAST(SUM(r) OVER () AS DOUBLE) AS n,
           CAST(SUM(died) OVER () AS DOUBLE) AS c_d, CAST(SUM(r - died) OVER () AS DOUBLE) AS c_s,
           CAST(MIN(r) OVER () AS DOUBLE) AS r_min
    FROM (SELECT admission_type, COUNT(*) AS r, SUM(hospital_expire_flag) AS died
          FROM admissions GROUP BY admission_type) t) cells) s"""),
        "readmission_intervals": _with(f"""
SELECT subject_id, hadm_id, admittime, dischtime,
       CAST(ROW_NUMBER() OVER w AS INTEGER) AS admission_seq,
       date_diff('microsecond', LAG(dischtime) OVER w, admittime) / {_DAYS} AS days_since_last_discharge
FROM admissions WINDOW w AS {w_adm}
ORDER BY subject_id, admittime, hadm_id"""),
        "readmission_target": _with(f"""
SELECT subject_id, hadm_id, hospital_expire_flag, dischtime,
       date_diff('microsecond', dischtime, LEAD(admittime) OVER w) / {_DAYS} AS days_to_next_admission,
       CASE WHEN LEAD(admittime) OVER w IS NULL THEN NULL
            WHEN date_diff('microsecond', dischtime, LEAD(admittime) OVER w) / {_DAYS} <= 30 THEN 1
            ELSE 0 END AS readmit_30d
FROM admissions WINDOW w AS {w_adm}
ORDER BY subject_id, admittime, hadm_id"""),
        "event_gaps": """
SELECT user_id, event_id, ts, CAST(ROW_NUMBER() OVER w AS INTEGER) AS event_seq,
       date_diff('microsecond', LAG(ts) OVER w, ts) / 1000000.0::DOUBLE AS secs_since_prev,
       date_diff('microsecond', ts, LEAD(ts) OVER w) / 1000000.0::DOUBLE AS secs_to_next
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
        "lab_window_24h": _with("""
SELECT hadm_id, len(seen) AS n_lab_results_24h, len(list_filter(seen, lambda v: v.a)) AS n_abnormal_labs_24h
FROM (SELECT hadm_id, list_filter(x, lambda v: v.t <= admittime + INTERVAL 1 DAY) AS seen
      FROM labs JOIN admissions USING (hadm_id)) WHERE len(seen) > 0""", _LISTS.format(t="")),
        "icu_rollup": _with("""
SELECT hadm_id, len(s) AS n_icu_stays, list_sum(list_transform(s, lambda v: v.d)) AS total_icu_los_days,
       s[1].u AS first_icu_careunit FROM stays""", _LISTS.format(t="")),
        "diagnosis_rollup": _with("SELECT hadm_id, n AS n_diagnoses FROM codes", _LISTS.format(t="")),
        "cohort_base": _with(_BASE, _LISTS.format(t="")),
        "cohort_base_store": _with(_BASE, _LISTS.format(t="")),
        "load_quality": _with("""
SELECT t AS "table", c AS "column", n_rows,
       CAST(CASE c WHEN 'subject_id' THEN bad_subject WHEN 'admittime' THEN bad_time ELSE 0 END * (t = 'admissions')::INTEGER AS BIGINT) AS n_bad
FROM (SELECT 'admissions' AS t, COUNT(*) AS n_rows, unnest(['subject_id', 'hadm_id', 'admittime', 'dischtime', 'admission_type',
        'admission_location', 'insurance', 'ethnicity', 'hospital_expire_flag']) AS c FROM admissions
      UNION ALL SELECT 'patients', COUNT(*), unnest(['subject_id', 'gender', 'dob']) FROM patients
      UNION ALL SELECT 'd_icd_diagnoses', COUNT(*), unnest(['icd9_code', 'short_title']) FROM d_icd_diagnoses) x,
     (SELECT COUNT(*) FILTER (hadm_id % 101 = 0) AS bad_subject, COUNT(*) FILTER (hadm_id % 103 = 0) AS bad_time FROM admissions) y"""),
        "cohort_features": _with("SELECT * FROM features", *_FEATURE_CTES),
        "cohort_feature_report": _with("""
SELECT COUNT(*) AS n_admissions, 16 AS n_columns, AVG(hospital_expire_flag) AS mortality_rate
FROM features""", *_FEATURE_CTES),
        "cohort_features_gaps": "WITH " + ",".join([_GAPS, _LISTS.format(t="g_"), _FEATURES]) + "SELECT * FROM features",
        "top_diagnoses_gaps": "WITH " + _GAPS + """
SELECT icd9_code, (SELECT ANY_VALUE(short_title) FROM d_icd_diagnoses t WHERE t.icd9_code = c.icd9_code) AS short_title, n_occurrences
FROM (SELECT icd9_code, COUNT(*) AS n_occurrences FROM g_diagnoses_icd GROUP BY icd9_code) c
ORDER BY n_occurrences DESC, icd9_code LIMIT 200""",
        "label_join": _with("""
SELECT f.*, t.readmit_30d FROM features f
JOIN target t ON f.subject_id = t.subject_id AND f.hadm_id = t.hadm_id""", *_FEATURE_CTES, _TARGET),
        "readmission_cohort": _with("""
SELECT f.subject_id, f.hadm_id, f.age_years, f.n_lab_results_24h, f.pct_abnormal_labs_24h,
       f.gender, f.admission_type, f.first_icu_careunit, CAST(t.readmit_30d AS INTEGER) AS label
FROM features f JOIN target t ON f.subject_id = t.subject_id AND f.hadm_id = t.hadm_id
WHERE f.hospital_expire_flag = 0 AND t.readmit_30d IS NOT NULL""", *_FEATURE_CTES, _TARGET),
        "design_matrix": _with(f"""
SELECT subject_id, hadm_id, age_years, n_lab_results_24h, pct_abnormal_labs_24h, label,
       {_dummy_sql()}
FROM frame""", *_FEATURE_CTES, _FRAME),
        "design_matrix_sparse": _with("""
SELECT subject_id, hadm_id, CAST(i AS BIGINT) AS index, feature, value FROM numbers WHERE value <> 0
UNION ALL
SELECT subject_id, hadm_id, CAST(2 + l.place AS BIGINT), c.col || '_' || c.level, 1.0::DOUBLE
FROM cells c JOIN (SELECT *, row_number() OVER (ORDER BY nr, level) AS place
                   FROM (SELECT DISTINCT nr, col, level FROM cells) v
                   WHERE level > (SELECT MIN(level) FROM cells w WHERE w.nr = v.nr)) l USING (nr, col, level)""",
                                      *_FEATURE_CTES, _FRAME, """
numbers AS (
  SELECT subject_id, hadm_id, unnest([0, 1, 2]) AS i,
         unnest(['age_years', 'n_lab_results_24h', 'pct_abnormal_labs_24h']) AS feature,
         unnest([age_years, CAST(n_lab_results_24h AS DOUBLE), pct_abnormal_labs_24h]) AS value FROM frame),
cells AS (
  SELECT subject_id, hadm_id, unnest([1, 2, 3, 4]) AS nr,
         unnest(['gender', 'admission_type', 'first_icu_careunit', 'admit_day']) AS col,
         unnest([gender, admission_type, first_icu_careunit, strftime(admittime, '%Y-%m-%d')]) AS level
  FROM frame JOIN (SELECT hadm_id, admittime FROM admissions) USING (hadm_id))"""),
        "lr_certificate": "SELECT unnest([" + ", ".join(f"'{n}'" for n in [
            "age_years", "n_lab_results_24h", "pct_abnormal_labs_24h", "(intercept)",
            *[f"{c}_{v}" for c, levels in _DUMMIES.items() for v in levels[1:]]]) + "]) AS feature, TRUE AS at_minimum",
        "class_weights": _with("""
SELECT label, COUNT(*) AS n, SUM(COUNT(*)) OVER () / (COUNT(*) OVER () * COUNT(*)) AS weight
FROM frame GROUP BY label""", *_FEATURE_CTES, _FRAME),
        "cv_splits": _with("""
SELECT COUNT(*) AS n_classes, MIN(n) AS min_class_count, LEAST(5, MIN(n)) AS n_splits
FROM (SELECT label, COUNT(*) AS n FROM frame WHERE label IS NOT NULL GROUP BY label)""",
                           *_FEATURE_CTES, _FRAME),
        "grouped_folds": _with("SELECT * FROM folds", *_FEATURE_CTES, _FRAME, _FOLDS),
        "even_folds": _with("SELECT * FROM even", *_FEATURE_CTES, _FRAME, _FOLDS, _EVEN),
        "held_out_split": _with("""
SELECT e.fold = 0 AS held_out, COUNT(*) AS n_rows, CAST(SUM(CAST(label AS BIGINT)) AS BIGINT) AS n_pos,
       COUNT(DISTINCT subject_id) AS n_groups
FROM frame JOIN even e USING (subject_id) GROUP BY 1""", *_FEATURE_CTES, _FRAME, _FOLDS, _EVEN),
        "one_class_guard": _with("SELECT COUNT(*) AS n_rows, TRUE AS refused FROM frame WHERE label = 0", *_FEATURE_CTES, _FRAME),
        "saved_scores": _with("""
SELECT COUNT(*) AS n_rows, COUNT(*) AS n_equal, COUNT(*) AS n_probabilities, TRUE AS ranks FROM features""", *_FEATURE_CTES),
        "standardised": _with("""
SELECT hadm_id, """ + ", ".join(
            f"CASE WHEN stddev_samp({c}) OVER () > 0 THEN round(({c} - avg({c}) OVER ()) / stddev_samp({c}) OVER (), 6) ELSE 0 END AS {c}"
            for c in ("age_years", "n_lab_results_24h", "pct_abnormal_labs_24h")) + """
FROM frame""", *_FEATURE_CTES, _FRAME),
        "all_descriptive": _with("""
SELECT 'cohort_summary' AS name, 1 AS n_rows
UNION ALL SELECT 'length_of_stay_by_careunit', COUNT(DISTINCT first_careunit) FROM icustays WHERE los IS NOT NULL
UNION ALL SELECT 'top_diagnoses', least(10, COUNT(DISTINCT icd9_code)) FROM diagnoses_icd
UNION ALL SELECT 'mortality_by_admission_type', COUNT(DISTINCT admission_type) FROM admissions
UNION ALL SELECT 'mortality_by_careunit', COUNT(DISTINCT first_careunit) FROM icustays
UNION ALL SELECT 'significance_admission_type', 1
UNION ALL SELECT 'significance_careunit', 1"""),
        "fold_balance": _with("""
SELECT f.fold, COUNT(*) AS n_rows, CAST(SUM(CAST(m.label AS BIGINT)) AS BIGINT) AS n_pos,
       COUNT(DISTINCT m.subject_id) AS n_groups
FROM frame m JOIN folds f ON m.subject_id = f.subject_id GROUP BY f.fold""",
                              *_FEATURE_CTES, _FRAME, _FOLDS),
        "confusion_counts": _with("""
SELECT g.actual, g.predicted, CAST(COALESCE(c.n, 0) AS BIGINT) AS n
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(actual, predicted)
LEFT JOIN (SELECT CAST(label AS INTEGER) AS actual, CAST(prediction AS INTEGER) AS predicted,
                  COUNT(*) AS n FROM scored GROUP BY 1, 2) c
  ON g.actual = c.actual AND g.predicted = c.predicted""", *_FEATURE_CTES, _FRAME, _SCORED),
        "classification_report": _with("""
SELECT class, precision, recall, f1_score, support FROM per_class
UNION ALL
SELECT 'accuracy', COALESCE(SUM(tp) / SUM(support), 0.0), COALESCE(SUM(tp) / SUM(support), 0.0),
       COALESCE(SUM(tp) / SUM(support), 0.0), CAST(SUM(support) AS BIGINT) FROM per_class
UNION ALL
SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1_score), CAST(SUM(support) AS BIGINT) FROM per_class
UNION ALL
SELECT 'weighted avg', COALESCE(SUM(precision * support) / SUM(support), 0.0),
       COALESCE(SUM(recall * support) / SUM(support), 0.0),
       COALESCE(SUM(f1_score * support) / SUM(support), 0.0), CAST(SUM(support) AS BIGINT)
FROM per_class""", *_FEATURE_CTES, _FRAME, _SCORED, """
counts AS (
  SELECT c, SUM(t) AS support, SUM(p) AS predicted, SUM(tp) AS tp FROM (
    SELECT CAST(label AS DOUBLE) AS c, 1 AS t, 0 AS p,
           CAST(CAST(label AS DOUBLE) = prediction AS INTEGER) AS tp FROM scored
    UNION ALL
    SELECT prediction, 0, 1, 0 FROM scored) u GROUP BY c),
pr AS (
  SELECT CAST(CAST(c AS INTEGER) AS VARCHAR) AS class,
         COALESCE(tp / NULLIF(predicted, 0), 0.0) AS precision,
         COALESCE(tp / NULLIF(support, 0), 0.0) AS recall,
         CAST(support AS BIGINT) AS support, tp FROM counts),
per_class AS (
  SELECT class, precision, recall,
         COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1_score,
         support, tp FROM pr)"""),
        "roc_points": _with("""
SELECT threshold, CAST(SUM(pos) OVER w AS BIGINT) AS tp, CAST(SUM(neg) OVER w AS BIGINT) AS fp,
       SUM(pos) OVER w / SUM(pos) OVER () AS tpr, SUM(neg) OVER w / SUM(neg) OVER () AS fpr
FROM (SELECT score AS threshold, SUM(CAST(label AS BIGINT)) AS pos,
             SUM(CAST(1 - label AS BIGINT)) AS neg FROM scored GROUP BY score) ps
WINDOW w AS (ORDER BY threshold DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
UNION ALL
SELECT NULL, 0, 0, 0.0 / NULLIF(SUM(label), 0), 0.0 / NULLIF(SUM(1 - label), 0) FROM scored""",
                            *_FEATURE_CTES, _FRAME, _SCORED),
        "rank_auc": _with("""
SELECT CAST(SUM(CAST(neg AS HUGEINT) * (2 * cum_pos - pos)) AS DOUBLE)
         / CAST(2 * MAX(total_pos) * SUM(neg) AS DOUBLE) AS auc,
       CAST(MAX(total_pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg
FROM (SELECT pos, neg, SUM(pos) OVER (ORDER BY s DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cum_pos,
             SUM(pos) OVER () AS total_pos
      FROM (SELECT score AS s, SUM(CAST(label AS BIGINT)) AS pos,
                   SUM(CAST(1 - label AS BIGINT)) AS neg FROM scored GROUP BY score) ps) c""",
                          *_FEATURE_CTES, _FRAME, _SCORED),
        "fold_rank_auc": _with("""
SELECT fold, auc, n_pos, n_neg, mean_auc,
       sqrt(list_reduce(list_prepend(0.0::DOUBLE, list_transform(known, lambda x: (x - mean_auc) * (x - mean_auc))),
            lambda a, b: a + b) / len(known)) AS std_auc
FROM (SELECT *, list_reduce(list_prepend(0.0::DOUBLE, known), lambda a, b: a + b) / len(known) AS mean_auc
      FROM (SELECT *, (SELECT list(auc ORDER BY fold) FROM per_fold WHERE auc IS NOT NULL) AS known FROM per_fold) a) b""",
                               *_FEATURE_CTES, _FRAME, _FOLDS, _SCORED, """
pairs AS (
  SELECT fold, score, SUM(CAST(label AS BIGINT)) AS pos, SUM(CAST(1 - label AS BIGINT)) AS neg
  FROM scored JOIN folds USING (subject_id) GROUP BY fold, score),
per_fold AS (
  SELECT a.fold, CAST(SUM(CASE WHEN a.score > b.score THEN 2 WHEN a.score = b.score THEN 1 ELSE 0 END
                          * CAST(a.pos * b.neg AS HUGEINT)) AS DOUBLE)
                 / NULLIF(CAST(2 * ANY_VALUE(t.n_pos) * ANY_VALUE(t.n_neg) AS DOUBLE), 0) AS auc,
         CAST(ANY_VALUE(t.n_pos) AS BIGINT) AS n_pos, CAST(ANY_VALUE(t.n_neg) AS BIGINT) AS n_neg
  FROM pairs a JOIN pairs b ON a.fold = b.fold
  JOIN (SELECT fold, SUM(pos) AS n_pos, SUM(neg) AS n_neg FROM pairs GROUP BY fold) t ON t.fold = a.fold
  GROUP BY a.fold)"""),
        "load_report": _with("""
SELECT 'patients' AS "table", COUNT(*) AS n_rows, 3 AS n_columns FROM patients
UNION ALL SELECT 'admissions', COUNT(*), 9 FROM admissions
UNION ALL SELECT 'icustays', COUNT(*), 5 FROM icustays
UNION ALL SELECT 'diagnoses_icd', COUNT(*), 3 FROM diagnoses_icd
UNION ALL SELECT 'd_icd_diagnoses', COUNT(*), 2 FROM d_icd_diagnoses
UNION ALL SELECT 'labevents', COUNT(*), 3 FROM labevents"""),
        "mortality_chi_square_careunit": _with("""
SELECT 'mortality by care unit' AS label, ROUND(chi, 6) AS chi_square, CAST(g - 1 AS INTEGER) AS dof,
       ROUND(1 - list_sum(list_transform(range(400), lambda j:
             CASE WHEN chi = 0 THEN 0.0
                  ELSE exp(((g - 1) / 2.0 + j) * ln(chi / 2) - chi / 2 - lgamma((g - 1) / 2.0 + j + 1)) END)),
             6) AS p_value,
       ROUND(r_min * LEAST(c_d, c_s) / n, 6) AS min_expected,
       (r_min * LEAST(c_d, c_s) / n < 5) AS unreliable
FROM (
  SELECT SUM(POWER(died - r * c_d / n, 2) / (r * c_d / n)
             + POWER(survived - r * c_s / n, 2) / (r * c_s / n)) AS chi,
         ANY_VALUE(g) AS g, ANY_VALUE(n) AS n, ANY_VALUE(c_d) AS c_d, ANY_VALUE(c_s) AS c_s,
         ANY_VALUE(r_min) AS r_min
  FROM (
    SELECT CAST(died AS DOUBLE) AS died, CAST(r - died AS DOUBLE) AS survived, CAST(r AS DOUBLE) AS r,
           COUNT(*) OVER () AS g, CAST(SUM(r) OVER () AS DOUBLE) AS n,
           CAST(SUM(died) OVER () AS DOUBLE) AS c_d, CAST(SUM(r - died) OVER () AS DOUBLE) AS c_s,
           CAST(MIN(r) OVER () AS DOUBLE) AS r_min
    FROM (SELECT i.first_careunit, COUNT(DISTINCT a.hadm_id) AS r, SUM(a.hospital_expire_flag) AS died
          FROM admissions a JOIN icustays i ON a.hadm_id = i.hadm_id
          GROUP BY i.first_careunit) t) cells) s"""),
        "contingency_table": _with("""
SELECT admission_type, CAST(SUM(hospital_expire_flag) AS BIGINT) AS died,
       CAST(COUNT(*) - SUM(hospital_expire_flag) AS BIGINT) AS survived
FROM admissions GROUP BY admission_type"""),
        "readmission_summary": _with(f"""
SELECT COUNT(*) AS n_admissions, COUNT(*) FILTER (WHERE admission_seq > 1) AS n_repeat_admissions,
       COUNT(*) FILTER (WHERE days_since_last_discharge <= 30) AS n_within_window,
       MAX(admission_seq) AS max_admissions_per_patient
FROM (SELECT CAST(ROW_NUMBER() OVER w AS INTEGER) AS admission_seq,
             date_diff('microsecond', LAG(dischtime) OVER w, admittime) / {_DAYS} AS days_since_last_discharge
      FROM admissions WINDOW w AS {w_adm}) q"""),
    }
