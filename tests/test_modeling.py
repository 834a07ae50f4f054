"""Folds, design matrix, training, scoring and model files, tested by contract."""

import json
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from wardlens.operators import folds as FO
from wardlens.operators import modeling as M
from wardlens.operators.evaluation import (classification_report, confusion_counts, rank_auc,
                                             rank_auc_of_counts, roc_points)
from wardlens.operators.features import build_cohort_features
from wardlens.operators.scoring import score_admissions
from wardlens.schemas import FEATURE_COLS_CATEGORICAL, FEATURE_COLS_NUMERIC, LEAKY_COLUMNS
from wardlens.sources import standin
from wardlens.sources.models import load_model, save_model


@pytest.fixture(scope="module")
def features(spark):
    return build_cohort_features(standin.standin_tables(spark, SF_SMALL)).cache()


def test_feature_set_excludes_leaky_columns():
    assert LEAKY_COLUMNS.isdisjoint(FEATURE_COLS_NUMERIC)
    assert LEAKY_COLUMNS.isdisjoint(FEATURE_COLS_CATEGORICAL)
    with pytest.raises(ValueError):
        M.check_no_leakage(["age_years", "hospital_los_days"], [])


def test_feature_table_shape(features, spark):
    n_adm = standin.admissions(spark, SF_SMALL).count()
    assert features.count() == n_adm
    rate = features.agg(F.avg("hospital_expire_flag")).first()[0]
    assert 0 <= rate <= 1


def test_folds_contract(features):
    frame = M.model_frame(features)
    _, _, k = FO.fold_count(frame, "label")
    folds = FO.grouped_folds(frame, "subject_id", "label", k)
    assigned = FO.assign_folds(frame, folds, "subject_id")
    assert assigned.count() == frame.count()                       # every row once
    assert assigned.groupBy("subject_id").agg(F.count_distinct("fold").alias("f")) \
        .where("f > 1").count() == 0                               # no group in two folds
    bal = FO.fold_balance(assigned, "subject_id", "label").collect()
    assert sorted(r["fold"] for r in bal) == list(range(k))
    pos = [r["n_pos"] for r in bal]
    biggest_group = folds.agg(F.max("n_pos")).first()[0]
    assert max(pos) - min(pos) <= biggest_group                    # stratified
    again = sorted(map(tuple, FO.grouped_folds(frame, "subject_id", "label", k).collect()))
    assert again == sorted(map(tuple, folds.collect()))            # repeatable


def test_hash_folds_keep_groups_together(features):
    frame = M.model_frame(features)
    folds = FO.grouped_folds(frame, "subject_id", "label", 4, method="hash")
    assert folds.select("fold").distinct().count() <= 4
    assert folds.count() == frame.select("subject_id").distinct().count()


def test_one_hot_drops_first_sorted_level_and_zeroes_unseen(spark):
    df = spark.createDataFrame([("M", "B"), ("F", "A"), ("F", None)], "gender string, unit string")
    enc = M.fit_encoder(df, ["gender", "unit"])
    assert json.loads(enc.getOrDefault(enc.levels)) == {"gender": ["F", "M"], "unit": ["A", "B"]}
    assert enc.output_columns() == ["gender_M", "unit_B"]
    new = spark.createDataFrame([("X", "C"), ("M", "B")], "gender string, unit string")
    rows = [tuple(r) for r in enc.transform(new).collect()]
    assert rows == [(0.0, 0.0), (1.0, 1.0)]
    assert enc.transform(new.select("gender")).columns == ["gender_M", "unit_B"]


def test_class_weights_are_balanced(spark):
    df = spark.createDataFrame([(0,)] * 6 + [(1,)] * 2, "label int")
    w = {r["label"]: r["weight"] for r in M.class_weights(df).collect()}
    assert w == {0: 8 / (2 * 6), 1: 8 / (2 * 2)}


def test_readmission_frame_drops_deaths_and_censored(features, spark):
    from wardlens.operators.sequences import readmission_target
    merged = M.merge_target(features, readmission_target(standin.admissions(spark, SF_SMALL), sort=False))
    frame = M.readmission_frame(merged)
    expected = merged.where("hospital_expire_flag = 0 AND readmit_30d IS NOT NULL").count()
    assert frame.count() == expected
    assert frame.where("label IS NULL").count() == 0
    assert {r[0] for r in frame.select("label").distinct().collect()} <= {0, 1}


def test_one_class_target_is_skipped_without_output(spark, scratch):
    df = spark.createDataFrame([(i, float(i), 0) for i in range(20)], "subject_id long, age_years double, label int")
    res = M.train_and_evaluate(df, save_path=os.path.join(scratch, "m"))
    assert res.model is None and res.importances is None and res.skipped_reason
    assert not os.path.exists(os.path.join(scratch, "m"))


SMALL_GRID = {"numTrees": [10], "maxDepth": [3, None], "minInstancesPerNode": [1]}


def test_train_on_two_class_sample(spark, scratch):
    rnd = random.Random(0)
    rows = [(i, rnd.uniform(20, 90), rnd.randint(0, 19), rnd.randint(0, 1)) for i in range(40)]
    df = spark.createDataFrame(rows, "subject_id long, age_years double, n_lab_results_24h long, label int")
    path = os.path.join(scratch, "readmission_model")
    res = M.train_and_evaluate(df, save_path=path, grid=SMALL_GRID)
    assert res.model is not None and os.path.exists(path)
    assert res.importances.count() == 2
    cv = {r["model"]: r for r in res.tables["cv_scores"].collect()}
    assert set(cv) == {"logistic_regression", "random_forest"}
    for r in cv.values():
        assert r["mean_auc"] is None or 0.0 <= r["mean_auc"] <= 1.0
    assert res.tables["confusion"].count() == 4
    assert res.tables["grid"].count() == 2


def test_mortality_model_scores_new_admissions(features, spark, scratch):
    frame = M.model_frame(features)
    path = os.path.join(scratch, "mortality_model")
    res = M.train_and_evaluate(frame, save_path=path, grid=SMALL_GRID)
    assert res.n_splits >= 2
    model = load_model(path)
    new = spark.createDataFrame([
        (72.0, 8, 37.5, "M", "EMERGENCY", "MICU"),
        (55.0, 2, 0.0, "F", "ELECTIVE", "No_ICU_Stay"),
    ], "age_years double, n_lab_results_24h long, pct_abnormal_labs_24h double, "
       "gender string, admission_type string, first_icu_careunit string")
    risks = [r["risk"] for r in score_admissions(model, new).collect()]
    assert len(risks) == 2 and all(0.0 <= p <= 1.0 for p in risks)
    only_age = spark.createDataFrame([(60.0,)], "age_years double")   # absent fields
    assert 0.0 <= score_admissions(model, only_age).first()["risk"] <= 1.0
    imp = res.importances.collect()
    assert len(imp) == len(M.feature_columns(M.design_matrix(frame), encoder=M.fit_encoder(frame)))


def test_missing_model_path_raises_file_not_found(scratch):
    with pytest.raises(FileNotFoundError):
        load_model(os.path.join(scratch, "nope"))


def test_save_model_round_trip(spark, scratch):
    df = spark.createDataFrame([(1.0, "a", 0), (2.0, "b", 1), (3.0, "a", 0), (4.0, "b", 1)],
                               "age_years double, gender string, label int")
    enc = M.fit_encoder(df, ["gender"])
    data = M.with_class_weights(enc.transform(df))
    fitted = M.model_pipeline(["age_years", "gender_b"], M.classifier("lr", n_train=4)).fit(data)
    from pyspark.ml import PipelineModel
    path = save_model(PipelineModel(stages=[enc, *fitted.stages]), os.path.join(scratch, "lr"))
    back = load_model(path)
    a = [r["risk"] for r in score_admissions(back, df).collect()]
    b = [r["risk"] for r in score_admissions(PipelineModel(stages=[enc, *fitted.stages]), df).collect()]
    assert a == b


def test_evaluation_tables(spark):
    df = spark.createDataFrame([(1, 0.9, 1.0), (1, 0.4, 0.0), (0, 0.4, 0.0), (0, 0.1, 0.0), (0, 0.8, 1.0)],
                               "label int, score double, prediction double")
    cm = {(r["actual"], r["predicted"]): r["n"] for r in confusion_counts(df).collect()}
    assert cm == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 1}
    rep = {r["class"]: r for r in classification_report(df).collect()}
    assert rep["1"]["precision"] == 0.5 and rep["1"]["recall"] == 0.5 and rep["1"]["support"] == 2
    assert rep["accuracy"]["precision"] == 3 / 5
    roc = roc_points(df).orderBy(F.desc_nulls_first("threshold")).collect()
    assert [(r["tp"], r["fp"]) for r in roc] == [(0, 0), (1, 0), (1, 1), (2, 2), (2, 3)]
    assert roc[0]["threshold"] is None and (roc[0]["tpr"], roc[0]["fpr"]) == (0.0, 0.0)
    # 6 (pos, neg) pairs: 0.9 beats all 3, 0.4 beats 0.1 and ties 0.4 -> (3 + 1.5) / 6
    assert rank_auc(df).first()["auc"] == 4.5 / 6
    one_class = df.where("label = 0")
    many = spark.createDataFrame([(1, 0.5, 3_000_000_000), (0, 0.5, 3_000_000_000)], "label int, score double, n long")
    assert rank_auc_of_counts(many.groupBy(F.col("score").alias("s")).agg(
        F.sum(F.when(F.col("label") == 1, F.col("n"))).alias("pos"),
        F.sum(F.when(F.col("label") == 0, F.col("n"))).alias("neg"))).first()["auc"] == 0.5
    assert rank_auc(one_class).first()["auc"] is None


def test_t12_one_class_fold_gets_null_auc(spark):
    rows = [(i, float(i % 7), i % 2, i % 3) for i in range(30)]          # folds 0-2, both classes
    rows += [(100 + i, float(i), 0, 3) for i in range(6)]                 # fold 3: one class only
    df = spark.createDataFrame(rows, "subject_id long, age_years double, label int, fold int")
    data = M.with_class_weights(df)
    aucs = {r["fold"]: r["auc"] for r in M.fold_aucs(data, ["age_years"], "lr", 4).collect()}
    assert aucs[3] is None
    assert all(aucs[f] is not None and 0.0 <= aucs[f] <= 1.0 for f in range(3))
    summary = M.auc_summary(M.fold_aucs(data, ["age_years"], "lr", 4), "lr").first()
    assert summary["n_folds"] == 3


def test_t18_null_group_key_still_gets_one_fold(spark):
    df = spark.createDataFrame([(None, 1), (None, 0), (1, 1), (2, 0), (3, 1), (4, 0)],
                               "subject_id long, label int")
    folds = FO.grouped_folds(df, "subject_id", "label", 2)
    assigned = FO.assign_folds(df, folds, "subject_id")
    assert assigned.count() == df.count()
    assert assigned.where("subject_id IS NULL").select("fold").distinct().count() == 1


def test_training_weights_ignore_the_held_out_fold(spark):
    rows = [(f, int(i % 3 == 0), 0.0) for f in range(3) for i in range(4 + f)]

    def weights(data):
        df = spark.createDataFrame(data, "fold int, label int, weight double")
        train = M.training_rows(df, M.fold_label_counts(df), 1)
        assert train.where("fold = 1").isEmpty()
        return {r["label"]: r["w"] for r in train.groupBy("label").agg(F.min("weight").alias("w")).collect()}

    flipped = [(f, 1 - y if f == 1 else y, w) for f, y, w in rows]
    n = {y: sum(1 for f, v, _ in rows if f != 1 and v == y) for y in (0, 1)}
    assert weights(rows) == weights(flipped) == {y: sum(n.values()) / (2 * n[y]) for y in n}


def test_grid_table_agrees_with_the_fold_scores(spark):
    rnd = random.Random(3)
    rows = [(i % 3, int(rnd.random() < 0.4), 1.0, rnd.random(), rnd.random()) for i in range(120)]
    rows += [(3, 0, 1.0, rnd.random(), 0.5) for _ in range(10)]  # a fold with one class
    data = spark.createDataFrame(rows, "fold int, label int, weight double, x double, y double").cache()
    best, table = M.grid_search(data, ["x", "y"], 4, {"numTrees": [3, 5], "maxDepth": [2]})
    found = {r["params"]: r for r in table.collect()}
    assert len(found) == 2
    own = found[json.dumps(best, sort_keys=True)]
    assert own["mean_auc"] == max(r["mean_auc"] for r in found.values())
    again = [r["auc"] for r in M.fold_aucs(data, ["x", "y"], "rf", 4, best).orderBy("fold").collect()]
    assert again[3] is None and own["fold_aucs"][3] is None
    assert own["fold_aucs"][:3] == pytest.approx(again[:3])
    assert own["mean_auc"] == pytest.approx(sum(again[:3]) / 3)


def test_standardise_scales_to_sample_deviation_and_keeps_nulls(spark):
    df = spark.createDataFrame([(1, 1.0, 5.0), (2, 3.0, 5.0), (3, None, None), (4, 5.0, 5.0)], "i int, x double, same double")
    got = {r["i"]: (r["x"], r["same"]) for r in M.standardise(df, ["x", "same"]).collect()}
    assert got == {1: (-1.0, 0.0), 2: (0.0, 0.0), 3: (None, None), 4: (1.0, 0.0)}
    assert M.standardise(df.where("false"), ["x"]).count() == 0


def test_a_fit_gives_every_file_of_the_prepared_data_its_own_task(spark, scratch):
    from wardlens.session import one_task_per_file
    folder = f"{scratch}/data"
    rows = spark.range(4000).select((F.col("id") % 2).cast("int").alias("label"), F.lit(1.0).alias("weight"),
                                    (F.col("id") % 7).cast("double").alias("x"), F.rand(1).alias("y"))
    rows.repartition(40).write.parquet(folder)
    data, before = spark.read.parquet(folder), spark.conf.get("spark.sql.files.openCostInBytes")
    assert data.rdd.getNumPartitions() < 40  # small files are packed
    with one_task_per_file(spark):
        with one_task_per_file(spark):
            pass
        assert spark.read.parquet(folder).rdd.getNumPartitions() == 40
    assert spark.conf.get("spark.sql.files.openCostInBytes") == before
    tracker, made = spark.sparkContext.statusTracker(), []
    spark.sparkContext.setJobGroup("fit-tasks", "a fit")
    try:
        M.fit_model(["x", "y"], M.classifier("rf", params={"numTrees": 2, "maxDepth": 2}), data)
        for job in tracker.getJobIdsForGroup("fit-tasks"):
            made += [tracker.getStageInfo(s).numTasks for s in tracker.getJobInfo(job).stageIds if tracker.getStageInfo(s)]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert max(made) == 40


def test_fit_tasks_hold_a_bounded_number_of_rows_and_fits_wait_for_cores(spark):
    assert [M.fit_partitions(n) for n in (0, 1, 20_000, 20_001, 150_000)] == [1, 1, 1, 2, 8]
    assert all(n / M.fit_partitions(n) <= 100_000 for n in (10**6, 9 * 10**6, 54 * 10**6))
    few = spark.range(100).repartition(1)
    many = spark.range(100).repartition(8 * spark.sparkContext.defaultParallelism)
    assert M.fits_at_a_time(few, 4) == 4 and M.fits_at_a_time(many, 4) == 1
    assert not M.classifier("rf", params={"maxDepth": 5}).getCacheNodeIds() and M.classifier("rf").getCacheNodeIds()
