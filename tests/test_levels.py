"""The sparse design matrix: any number and spelling of levels, saved and scored."""

import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from wardlens.operators import levels as L
from wardlens.operators import modeling as M
from wardlens.operators.scoring import score_admissions
from wardlens.sources.models import load_model, save_model


def vectors(df, key="i"):
    return {r[key]: [round(x, 6) for x in r[L.VECTOR].toArray()] for r in df.collect()}


def test_vector_equals_the_wide_matrix_and_names_do_not_clash(spark):
    df = spark.createDataFrame([(1, 2.0, "B.C", "x"), (2, 0.0, "B_C", None), (3, None, "A", "y"), (4, 5.0, None, "y")],
                               "i int, age double, unit string, `kind of` string")
    enc = L.fit_levels(df, ["age"], ["unit", "kind of"])
    assert enc.feature_names() == ["age", "unit_B.C", "unit_B_C", "kind of_y"]
    got = vectors(enc.transform(df.fillna({"age": -1.0})))
    assert got == {1: [2, 1, 0, 0], 2: [0, 0, 1, 0], 3: [-1, 0, 0, 1], 4: [5, 0, 0, 1]}
    attrs = enc.transform(df).schema[L.VECTOR].metadata["ml_attr"]
    assert [a["name"] for a in attrs["attrs"]["numeric"]] == enc.feature_names()
    # unseen levels and absent columns give zeros
    new = spark.createDataFrame([(9, "ZZ")], "i int, unit string")
    assert vectors(enc.transform(new)) == {9: [0, 0, 0, 0]}
    long = {(r["i"], r["index"], r["feature"]): r["value"]
            for r in L.design_matrix_sparse(df, ["age"], ["unit", "kind of"], ["i"]).collect()}
    assert long == {(1, 0, "age"): 2.0, (1, 1, "unit_B.C"): 1.0, (2, 2, "unit_B_C"): 1.0, (3, 3, "kind of_y"): 1.0,
                    (4, 0, "age"): 5.0, (4, 3, "kind of_y"): 1.0}


def test_columns_without_levels_or_with_one(spark):
    df = spark.createDataFrame([(1, None, "only"), (2, None, "only")], "i int, none string, one string")
    enc = L.fit_levels(df.withColumn("x", F.lit(1.5)), ["x"], ["none", "one"])
    assert enc.feature_names() == ["x"] and vectors(enc.transform(df.withColumn("x", F.lit(1.5)))) == {1: [1.5], 2: [1.5]}
    assert L.level_table(df.where("false"), ["one"]).count() == 0


def test_fifty_thousand_levels_fit_save_and_score(spark, scratch):
    n = 50_000
    df = spark.range(2 * n).select(
        F.col("id").alias("subject_id"), (F.col("id") % 90).cast("double").alias("age_years"),
        F.concat(F.lit("code."), (F.col("id") % n).cast("string")).alias("admission_type"), ((F.col("id") % n) % 3 == 0).cast("int").alias("label"))
    enc = L.fit_levels(df)
    names = enc.feature_names()
    assert len(names) == n and names[1] == "admission_type_code.1" and names.column == L.VECTOR
    data = M.with_class_weights(enc.transform(df))
    row = data.where("subject_id = 7").first()[L.VECTOR]
    assert row.size == n and len(row.indices) == 2
    clf = M.classifier("lr", n_train=2 * n).setMaxIter(5)
    fitted = M.model_pipeline(names, clf).fit(data)
    path = save_model(PipelineModel(stages=[enc, *fitted.stages]), os.path.join(scratch, "m"))
    some = df.where("subject_id < 40")
    a = {r["subject_id"]: r["risk"] for r in score_admissions(load_model(path), some).collect()}
    b = {r["subject_id"]: r["risk"] for r in score_admissions(PipelineModel(stages=[enc, *fitted.stages]), some).collect()}
    assert a == b and len(a) == 40
    assert min(a[i] for i in range(0, 40, 3)) > max(a[i] for i in range(40) if i % 3)


def test_scaling_without_centring_gives_the_same_scores(spark):
    df = spark.createDataFrame([(i, float(20 + i % 50), "abc"[i % 3], int((i * 7) % 11 < 5)) for i in range(200)],
                               "subject_id int, age_years double, gender string, label int")
    enc = L.fit_levels(df)
    sparse = M.model_pipeline(enc.feature_names(), M.classifier("lr", n_train=200)).fit(M.with_class_weights(enc.transform(df)))
    wide = M.fit_encoder(df, ["gender"])
    dense = M.model_pipeline(["age_years", "gender_b", "gender_c"], M.classifier("lr", n_train=200)).fit(
        M.with_class_weights(wide.transform(df)))
    a = {r["subject_id"]: r["risk"] for r in score_admissions(PipelineModel(stages=[enc, *sparse.stages]), df).collect()}
    b = {r["subject_id"]: r["risk"] for r in score_admissions(PipelineModel(stages=[wide, *dense.stages]), df).collect()}
    assert a == pytest.approx(b, abs=1e-4)
