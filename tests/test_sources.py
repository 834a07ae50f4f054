"""CSV loading (S1-S5), the whole analysis call (M23) and streaming scoring."""

import os
import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from wardlens.sources import standin
from wardlens.sources.tables import load_report, load_tables, publish_tables, register_views


def _write_csv(df, folder, name, upper=True):
    path = os.path.join(folder, f"{name}.csv")
    out = df.toDF(*[(" " + c.upper() + " ") if upper else c for c in df.columns])
    out.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def test_load_tables_declared_types_lower_names_and_missing(spark, scratch):
    tables = standin.standin_tables(spark, SF_SMALL)
    for name in ("patients", "admissions", "icustays"):
        _write_csv(tables[name], scratch, name.upper())
    loaded, missing = load_tables(spark, scratch)
    assert set(loaded) == {"patients", "admissions", "icustays"}
    assert set(missing) == {"diagnoses_icd", "d_icd_diagnoses", "labevents"}
    adm = loaded["admissions"]
    assert adm.columns == [c.lower() for c in adm.columns]
    assert dict(adm.dtypes)["admittime"] == "timestamp_ntz"
    assert dict(adm.dtypes)["hadm_id"] == "bigint"
    assert adm.count() == tables["admissions"].count()
    same = adm.select("hadm_id", "dischtime").exceptAll(tables["admissions"].select("hadm_id", "dischtime"))
    assert same.count() == 0
    report = {r["table"]: r for r in load_report(loaded).collect()}
    assert report["patients"]["n_rows"] == tables["patients"].count()
    register_views(loaded)
    assert spark.sql("SELECT COUNT(*) FROM icustays").first()[0] == tables["icustays"].count()
    paths = publish_tables(loaded, os.path.join(scratch, "published"))
    assert spark.read.parquet(paths["patients"]).count() == tables["patients"].count()


def test_codes_keep_leading_zeros_and_quoted_commas(spark, scratch):
    with open(os.path.join(scratch, "D_ICD_DIAGNOSES.csv"), "w") as f:
        f.write('row_id,icd9_code,short_title,long_title\n'
                '1,0389,Septicemia NOS,Septicemia NOS\n'
                '2,4280,"CHF, NOS",CHF NOS\n'
                '3,bad,,\n')
    loaded, _ = load_tables(spark, scratch, tables=["D_ICD_DIAGNOSES"])
    rows = loaded["d_icd_diagnoses"].orderBy("row_id").collect()
    assert [r["icd9_code"] for r in rows] == ["0389", "4280", "bad"]
    assert rows[1]["short_title"] == "CHF, NOS"
    assert rows[2]["short_title"] is None


def test_bad_values_become_null(spark, scratch):
    with open(os.path.join(scratch, "PATIENTS.csv"), "w") as f:
        f.write('ROW_ID,SUBJECT_ID,GENDER,DOB,EXPIRE_FLAG,EXTRA\n'
                '1,10001,M,2062-10-16 00:00:00,0,x\n'
                '2,oops,F,not a date,1,y\n')
    loaded, _ = load_tables(spark, scratch, tables=["PATIENTS"])
    rows = loaded["patients"].orderBy("row_id").collect()
    assert rows[1]["subject_id"] is None and rows[1]["dob"] is None
    assert rows[0]["dod"] is None                        # declared, absent from the file
    assert loaded["patients"].columns[-1] == "extra"     # undeclared columns kept


def test_run_analysis_end_to_end(spark, scratch):
    from wardlens.workflow import run_analysis
    tables = standin.standin_tables(spark, SF_SMALL)
    grid = {"numTrees": [10], "maxDepth": [3], "minInstancesPerNode": [1]}
    res = run_analysis(spark, out_dir=scratch, tables=tables, grid=grid)
    assert res["cohort_summary"].first()["n_admissions"] == tables["admissions"].count()
    assert os.path.exists(os.path.join(scratch, "mortality_model"))
    assert os.path.exists(os.path.join(scratch, "tables", "cohort_summary"))
    assert res["mortality"].model is not None


def test_streaming_scores_new_files(spark, scratch):
    from pyspark.ml import PipelineModel
    from wardlens.operators import modeling as M
    from wardlens.sources.models import save_model
    from wardlens.streaming.scoring_stream import ADMISSION_FEATURES, start_scoring_stream

    df = spark.createDataFrame([(i, 100 + i, 20.0 + i, i % 5, float(i % 3) * 10, "MF"[i % 2], "E", "MICU")
                                for i in range(30)], ADMISSION_FEATURES)
    frame = df.withColumn("label", (F.col("subject_id") % 2).cast("int"))
    enc = M.fit_encoder(frame)
    data = M.with_class_weights(enc.transform(frame))
    fitted = M.model_pipeline(M.feature_columns(data, encoder=enc), M.classifier("lr", n_train=30)).fit(data)
    model_path = save_model(PipelineModel(stages=[enc, *fitted.stages]), os.path.join(scratch, "model"))

    src = os.path.join(scratch, "incoming")
    df.limit(10).write.mode("overwrite").parquet(os.path.join(src, "batch1"))
    q = start_scoring_stream(spark, model_path, os.path.join(src, "batch1"), os.path.join(scratch, "scored"),
                             os.path.join(scratch, "ckpt"), available_now=True)
    q.awaitTermination(120)
    out = spark.read.parquet(os.path.join(scratch, "scored"))
    assert out.count() == 10
    assert out.where("risk < 0 OR risk > 1").count() == 0
    time.sleep(0.1)


def test_publish_partitioned_by_admission_year(spark, scratch):
    adm = standin.admissions(spark, SF_SMALL).withColumn("admit_year", F.year("admittime"))
    paths = publish_tables({"admissions": adm}, os.path.join(scratch, "pub"),
                           partition_by={"admissions": ["admit_year"]})
    assert any(d.startswith("admit_year=") for d in os.listdir(paths["admissions"]))
    back = spark.read.parquet(paths["admissions"])
    year = adm.select(F.min("admit_year")).first()[0]
    assert back.where(F.col("admit_year") == year).count() == adm.where(F.col("admit_year") == year).count()
