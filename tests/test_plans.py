"""Skew-safe plan helpers agree with the plain (single-task) formulation."""

import random

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL
from wardlens.plans.median import exact_median, exact_medians
from wardlens.plans.ordering import _ranged, global_positions, keyed_sequence, running_totals
from wardlens.plans.skew import salted_join
from wardlens.sources import standin


def _skewed(spark, n_hot=400, n_other=60):
    rnd = random.Random(7)
    rows = [(1, i, rnd.randint(0, 50), float(i)) for i in range(n_hot)]          # hot key, many ties
    rows += [(2 + i % 9, 1000 + i, rnd.randint(0, 50), float(i)) for i in range(n_other)]
    rows += [(None, 5000 + i, i, 1.0) for i in range(3)]                          # NULL key group
    return spark.createDataFrame(rows, "k long, id long, t long, v double")


def _plain_sequence(df):
    w = Window.partitionBy("k").orderBy("t", "id")
    return df.select("*", F.row_number().over(w).alias("seq"), F.lag("v").over(w).alias("prev_v"),
                     F.lead("t").over(w).alias("next_t"))


def _sorted(df):
    rows = [tuple(r) for r in df.select(sorted(df.columns)).collect()]
    return sorted(rows, key=lambda r: tuple((x is None, x if x is not None else 0) for x in r))


def test_keyed_sequence_hot_path_equals_window(spark):
    df = _skewed(spark)
    want = _sorted(_plain_sequence(df))
    for threshold in (10, 10**9):
        got = keyed_sequence(df, "k", ["t", "id"], seq_col="seq", lag=["v"], lead=["t"],
                             hot_threshold=threshold, hot_partitions=7)
        assert _sorted(got) == want


def test_readmission_queries_same_with_every_patient_hot(spark):
    from wardlens.operators.sequences import readmission_intervals, readmission_target
    adm = standin.admissions(spark, SF_SMALL)
    for op in (readmission_intervals, readmission_target):
        assert _sorted(op(adm, hot_threshold=1)) == _sorted(op(adm))


def test_global_positions_is_a_total_row_number(spark):
    df = _skewed(spark)
    got = global_positions(df, ["-t", "id"], "pos", partitions=5)
    want = df.select("*", (F.row_number().over(Window.orderBy(F.desc("t"), F.asc("id"))) - 1).alias("pos"))
    assert _sorted(got) == _sorted(want)


def test_running_totals_match_cumulative_window(spark):
    df = _skewed(spark).where(F.col("k").isNotNull())
    got = running_totals(df, ["t", "id"], ["v"], partitions=6)
    w = Window.orderBy("t", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("*", F.sum("v").over(w).alias("cum_v"), F.sum("v").over(Window.partitionBy()).alias("total_v"))
    assert _sorted(got) == _sorted(want)


def test_salted_join_equals_plain_join(spark):
    big = _skewed(spark).select("k", "id", "t")
    small = spark.createDataFrame([(1, 25), (2, 10), (3, 40), (None, 0)], "k long, lim long")
    cond = lambda b, s: b("t") <= s("lim")
    got = salted_join(big, small, ["k"], condition=cond, hot_threshold=20, rows_per_salt=7)
    want = big.join(small, (big.k == small.k) & (big.t <= small.lim)).select(big.k, "id", "t", "lim")
    assert _sorted(got) == _sorted(want)
    left = salted_join(big, small, ["k"], condition=cond, how="left", hot_threshold=20, rows_per_salt=7)
    assert left.count() == big.join(small, (big.k == small.k) & (big.t <= small.lim), "left").count()


def test_exact_median(spark):
    rnd = random.Random(3)
    for n in (1, 2, 999, 1000):
        vals = [float(rnd.randint(0, 40)) for _ in range(n)] + [None]
        df = spark.createDataFrame([(v,) for v in vals], "x double")
        assert exact_median(df, "x") == pd.Series(vals, dtype="float64").median()


def test_exact_medians_of_several_columns(spark):
    df = spark.createDataFrame([(1.0, None), (2.0, 5.0), (10.0, float("nan")), (4.0, 7.0)], "a double, b double")
    assert exact_medians(df, ["a", "b"]) == {"a": 3.0, "b": 6.0}
    assert exact_medians(df.where("a > 100"), ["a"]) == {"a": None}


def test_feature_table_same_with_every_admission_salted(spark):
    from wardlens.operators.features import cohort_base, lab_window
    t = standin.standin_tables(spark, SF_SMALL)
    plain = lab_window(t["labevents"], t["admissions"])
    salted = lab_window(t["labevents"], t["admissions"], hot_threshold=1)
    assert _sorted(salted) == _sorted(plain)
    assert _sorted(cohort_base(t, lab_hot_threshold=2)) == _sorted(cohort_base(t))


def test_building_plans_runs_nothing_hidden(spark, monkeypatch):
    """lab_window and cohort_base run no action while they are built; the feature table one."""
    from pyspark.sql.classic.dataframe import DataFrame as Frame
    from wardlens.operators.features import build_cohort_features, cohort_base, lab_window

    t, runs = standin.standin_tables(spark, SF_SMALL), []
    for name in ("collect", "first", "count", "isEmpty", "toPandas", "take", "head"):
        monkeypatch.setattr(Frame, name, lambda self, *a, f=getattr(Frame, name), n=name, **k: (runs.append(n), f(self, *a, **k))[1])
    lab_window(t["labevents"], t["admissions"])
    cohort_base(t)
    assert runs == []
    build_cohort_features(t)
    assert runs.count("first") <= 1 and not set(runs) & {"count", "isEmpty", "toPandas"}


def test_lab_window_equals_its_definition(spark):
    from wardlens.operators.features import lab_window
    t = standin.standin_tables(spark, SF_SMALL)
    labs, adm = t["labevents"].toPandas(), t["admissions"].select("hadm_id", "admittime").toPandas()
    both = labs.dropna(subset=["hadm_id"]).merge(adm, on="hadm_id")
    both = both[both.charttime <= both.admittime + pd.Timedelta(hours=24)]
    want = both.groupby("hadm_id").agg(n=("flag", "size"), a=("flag", lambda f: int((f == "abnormal").sum())))
    got = lab_window(t["labevents"], t["admissions"]).collect()
    assert sorted(map(tuple, got)) == sorted((int(k), int(r.n), int(r.a)) for k, r in want.iterrows())


def test_plan_does_not_grow_with_the_slices(spark):
    """Building a plan over many slices puts nothing per slice into the plan or onto the driver."""
    import time

    df = spark.range(100).withColumn("k", F.col("id") % 7)
    t = time.time()
    few = len(_ranged(df, ["k", "id"], 8)._jdf.queryExecution().analyzed().toString())
    many = len(_ranged(df, ["k", "id"], 20_000)._jdf.queryExecution().analyzed().toString())
    assert time.time() - t < 2
    assert many - few < 10


def test_cluster_without_shared_folder_is_an_error():
    from wardlens.session import checkpoint_root

    assert checkpoint_root("hdfs:///x", "spark://host:7077") == "hdfs:///x"
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            checkpoint_root(None, master)


def test_intermediates_are_deleted(spark):
    import os

    from wardlens.session import ensure_checkpoint_dir, intermediates, materialize

    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    with intermediates(spark):
        assert materialize(spark.range(5), "short-lived").count() == 5
        assert set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before


def _skewed_admissions(spark):
    from conftest import SF_MEDIUM
    adm = standin.admissions(spark, SF_MEDIUM)
    hot = adm.agg(F.min("subject_id")).first()[0]
    return adm.withColumn("subject_id", F.when(F.col("hadm_id") % 3 == 0, F.lit(hot))
                          .otherwise(F.col("subject_id")))


def test_hot_slices_agree_when_split_points_are_sampled(spark):
    # 5,000 admissions of one patient, threshold 100: split points come from a
    # real sample (not every row), the case that must still stitch exactly.
    from wardlens.operators.sequences import readmission_intervals, readmission_target
    adm = _skewed_admissions(spark)
    for op in (readmission_target, readmission_intervals):
        assert _sorted(op(adm, hot_threshold=100, sort=False)) == _sorted(op(adm, sort=False))


def test_global_positions_with_sampled_split_points(spark):
    adm = _skewed_admissions(spark).select("subject_id", "hadm_id")
    got = global_positions(adm, ["-subject_id", "hadm_id"], "pos", partitions=20)
    w = Window.orderBy(F.desc("subject_id"), F.asc("hadm_id"))
    want = adm.select("*", (F.row_number().over(w) - 1).alias("pos"))
    assert _sorted(got) == _sorted(want)


def test_hot_null_key_group(spark):
    rows = [(None, i, i % 7, float(i)) for i in range(300)] + [(1, 1000 + i, i, 1.0) for i in range(20)]
    df = spark.createDataFrame(rows, "k long, id long, t long, v double")
    got = keyed_sequence(df, "k", ["t", "id"], seq_col="seq", lag=["v"], lead=["t"],
                         hot_threshold=10, hot_partitions=6)
    assert _sorted(got) == _sorted(_plain_sequence(df))
    small = spark.createDataFrame([(1, 5)], "k long, lim long")
    left = salted_join(df.select("k", "id", "t"), small, ["k"], how="left", hot_threshold=5,
                       condition=lambda b, s: b("t") <= s("lim"))
    want = df.join(small, (df.k == small.k) & (df.t <= small.lim), "left").select(df.k, "id", "t", "lim")
    assert _sorted(left) == _sorted(want)


def test_median_row_equals_the_exact_medians(spark):
    from wardlens.plans.median import median_row
    import random
    rnd = random.Random(9)
    big = [rnd.choice([-1, 1]) * rnd.random() * 10.0 ** rnd.randint(-300, 300) for _ in range(301)]
    for vals in ([], [None, float("nan")], [-0.0, 0.0], [float("-inf"), 1.0, float("inf")],
                 [7.0] * 50 + [8.0] * 49, big, [-float(x) for x in range(1000)]):
        df = spark.createDataFrame([(x, i) for i, x in enumerate(vals)], "x double, i int")
        row = median_row(df, ["x", "i"]).collect()
        exact = exact_medians(df, ["x", "i"])
        assert len(row) == 1 and (row[0]["x"], row[0]["i"]) == (exact["x"], exact["i"])


def test_building_the_feature_table_runs_no_job(spark):
    from wardlens.operators.features import build_cohort_features
    t = standin.gap_tables(spark, SF_SMALL)
    spark.sparkContext.setJobGroup("building", "feature table")
    try:
        df = build_cohort_features(t)
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == []
        assert df.where("hospital_los_days IS NULL OR age_years IS NULL OR first_icu_careunit IS NULL").count() == 0
        assert list(spark.sparkContext.statusTracker().getJobIdsForGroup("building"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
