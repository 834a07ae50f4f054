"""Published store: buckets, versions, load quality, quoted line breaks and a run that resumes."""

import json
import os

import pytest
from pyspark.sql import functions as F

import wardlens.workflow as W
from conftest import SF_SMALL
from test_plan_shape import plan_text
from wardlens.operators.features import cohort_base
from wardlens.sources import standin, store
from wardlens.sources.tables import files_with_broken_lines, load_and_publish, load_tables


@pytest.fixture()
def shuffled_joins(spark):
    """As on large tables: no join side is small enough to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_feature_base_over_a_store_needs_no_exchange(spark, scratch, shuffled_joins):
    tables = standin.standin_tables(spark, SF_SMALL)
    store.publish_store(tables, scratch, buckets=4)
    opened = store.open_store(spark, scratch)
    base = cohort_base(opened)
    assert "Exchange" not in plan_text(base) and "Exchange" in plan_text(cohort_base(tables))
    assert base.exceptAll(cohort_base(tables)).isEmpty() and base.count() == tables["admissions"].count()


def test_a_hot_bucket_is_opened_as_plain_files(spark, scratch, monkeypatch):
    monkeypatch.setattr(store, "MIN_SKEWED_BYTES", 0)
    monkeypatch.setattr(store, "MAX_SKEW", 1.5)
    hot = spark.range(4000).select(F.when(F.col("id") < 3500, 1).otherwise(F.col("id")).alias("hadm_id"), F.rand().alias("x"))
    store.publish_store({"labevents": hot}, scratch, buckets=8)
    opened = store.open_store(spark, scratch)["labevents"]
    assert "Bucketed: true" not in plan_text(opened.groupBy("hadm_id").count())
    assert opened.count() == 4000


def test_a_failed_publish_leaves_the_old_version(spark, scratch, monkeypatch):
    first = spark.createDataFrame([(1, "M")], "subject_id long, gender string")
    version = store.publish_store({"patients": first}, scratch, buckets=2)
    write = store._write_bucketed

    def dies(df, path, key, buckets):
        if path.endswith("icustays"):
            raise RuntimeError("disk full")
        write(df, path, key, buckets)

    monkeypatch.setattr(store, "_write_bucketed", dies)
    with pytest.raises(RuntimeError):
        store.publish_store({"patients": first.union(first), "icustays": first.withColumn("hadm_id", F.lit(1))}, scratch, buckets=2)
    assert store.current_version(spark, scratch)[0] == version
    assert [f for f in os.listdir(scratch) if f.startswith("v")] == [version]
    assert store.open_store(spark, scratch)["patients"].count() == 1
    monkeypatch.undo()
    for _ in range(3):
        newest = store.publish_store({"patients": first.union(first)}, scratch, buckets=2)
    assert store.open_store(spark, scratch)["patients"].count() == 2
    kept = [f for f in os.listdir(scratch) if f.startswith("v")]
    assert newest in kept and len(kept) == store.KEPT_VERSIONS
    with pytest.raises(FileNotFoundError):
        store.open_store(spark, os.path.join(scratch, "nowhere"))


def test_quoted_line_breaks_are_one_record_and_only_their_file_is_read_whole(spark, scratch):
    folder = os.path.join(scratch, "D_ICD_DIAGNOSES.csv")
    os.makedirs(folder)
    head = "row_id,icd9_code,short_title,long_title\n"
    with open(os.path.join(folder, "a b%.csv"), "w") as f:
        f.write(head + '1,0389,"two\nlines, ""quoted""",x\n2,4280,"a ""plain"" one",y\n')
    with open(os.path.join(folder, "c.csv"), "w") as f:
        f.write(head + '3,100,plain,"with ""doubled"" quotes"\n4,101,,\n')
    assert [os.path.basename(p) for p in files_with_broken_lines(spark, folder)] == ["a%20b%25.csv"]
    loaded, _ = load_tables(spark, scratch, tables=["D_ICD_DIAGNOSES"])
    rows = {r["row_id"]: r for r in loaded["d_icd_diagnoses"].collect()}
    assert sorted(rows) == [1, 2, 3, 4]
    assert rows[1]["short_title"] == 'two\nlines, "quoted"' and rows[2]["short_title"] == 'a "plain" one'
    assert rows[3]["long_title"] == 'with "doubled" quotes' and rows[1]["icd9_code"] == "0389"


def test_load_quality_counts_what_the_casts_lose(spark, scratch):
    with open(os.path.join(scratch, "PATIENTS.csv"), "w") as f:
        f.write("ROW_ID,SUBJECT_ID,GENDER,DOB\n1,10001,M,2062-10-16 00:00:00\n2,oops,F,not a date\n3,10003,,\n4,,F,never\n")
    missing = load_and_publish(spark, scratch, os.path.join(scratch, "store"), buckets=2)
    assert len(missing) == 5
    got = {(r["table"], r["column"]): (r["n_rows"], r["n_bad"]) for r in store.load_quality(spark, os.path.join(scratch, "store")).collect()}
    assert got == {("patients", "row_id"): (4, 0), ("patients", "subject_id"): (4, 1), ("patients", "gender"): (4, 0),
                   ("patients", "dob"): (4, 2)}


def test_models_still_fit_and_score_after_a_load(spark, scratch):
    from wardlens.operators import modeling as M
    with open(os.path.join(scratch, "PATIENTS.csv"), "w") as f:
        f.write("SUBJECT_ID,GENDER\n1,M\n")
    load_and_publish(spark, scratch, os.path.join(scratch, "store"), buckets=2)
    rows = [(i % 2, int(i % 5 == 0 or i % 3 == 0), float(i % 7)) for i in range(60)]
    data = spark.createDataFrame(rows, "fold int, label int, x double")
    assert M.fold_aucs(data, ["x"], "lr", 2).where("auc IS NULL").count() == 0


def test_a_run_that_was_stopped_resumes_after_the_feature_table(spark, scratch, monkeypatch):
    tables = standin.standin_tables(spark, SF_SMALL)
    grid = {"numTrees": [4], "maxDepth": [2], "minInstancesPerNode": [1]}
    train, built = W.train_and_evaluate, []
    build, publish = W.build_cohort_features, W.publish_store
    monkeypatch.setattr(W, "build_cohort_features", lambda t: built.append("features") or build(t))
    monkeypatch.setattr(W, "publish_store", lambda *a: built.append("publish") or publish(*a))

    def stopped(*a, **k):
        raise RuntimeError("stopped")

    monkeypatch.setattr(W, "train_and_evaluate", stopped)
    with pytest.raises(RuntimeError):
        W.run_analysis(spark, out_dir=scratch, tables=tables, grid=grid)
    assert built == ["publish", "features"]
    monkeypatch.setattr(W, "train_and_evaluate", lambda *a, **k: built.append("train") or train(*a, **k))
    first = W.run_analysis(spark, out_dir=scratch, tables=tables, grid=grid)
    assert built == ["publish", "features", "train", "train"]
    again = W.run_analysis(spark, out_dir=scratch, tables=tables, grid=grid)
    assert built == ["publish", "features", "train", "train"]
    assert again["mortality"].best_params == first["mortality"].best_params
    assert again["cohort_features"].count() == tables["admissions"].count()
    assert json.load(open(os.path.join(scratch, "steps", "publish.json")))["version"] == store.current_version(spark, f"{scratch}/store")[0]
