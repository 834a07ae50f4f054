"""One test per semantics trap, on small handmade tables."""

import datetime as dt
import math

import pytest

from wardlens.functions.chisq import chi2_sf
from wardlens.operators import descriptive as D
from wardlens.operators import features as FT
from wardlens.operators import sequences as S
from wardlens.operators.stats import mortality_significance_test


def ts(s):
    return dt.datetime.fromisoformat(s)


def adm_df(spark, rows):
    schema = ("subject_id long, hadm_id long, admittime timestamp_ntz, dischtime timestamp_ntz, "
              "admission_type string, hospital_expire_flag int")
    return spark.createDataFrame(rows, schema)


@pytest.fixture()
def admissions(spark):
    return adm_df(spark, [
        (1, 10, ts("2100-01-01 00:00:00"), ts("2100-01-05 00:00:00"), "EMERGENCY", 0),
        (1, 11, ts("2100-01-20 00:00:00"), ts("2100-01-22 00:00:00"), "EMERGENCY", 1),
        (1, 12, ts("2100-03-01 00:00:00"), ts("2100-03-02 00:00:00"), "URGENT", 0),
        (2, 20, ts("2100-02-01 00:00:00"), None, "ELECTIVE", 0),
        (2, 21, ts("2100-02-10 00:00:00"), ts("2100-02-12 00:00:00"), "ELECTIVE", 0),
        (3, 30, ts("2100-05-01 00:00:00"), ts("2100-05-10 00:00:00"), "URGENT", 0),
        (3, 31, ts("2100-05-05 00:00:00"), ts("2100-05-06 00:00:00"), "URGENT", 0),
    ])


def test_t1_gender_counts_count_admissions(spark, admissions):
    patients = spark.createDataFrame([(1, "M"), (2, "F"), (3, "M"), (4, "F")],
                                     "subject_id long, gender string")
    row = D.cohort_summary(patients, admissions).first()
    assert row["n_patients"] == 4
    assert row["n_admissions"] == 7
    assert row["n_male"] == 3 + 2          # subject 1 three times, subject 3 twice
    assert row["n_female"] == 2 + 1        # subject 2 twice, subject 4 (no admission) once


def test_admissions_without_patient_are_not_counted(spark, admissions):
    patients = spark.createDataFrame([(1, "M")], "subject_id long, gender string")
    row = D.cohort_summary(patients, admissions).first()
    assert (row["n_patients"], row["n_admissions"], row["n_male"], row["n_female"]) == (1, 3, 3, 0)


def test_t3_careunit_deaths_double_count_and_dedup(spark, admissions):
    stays = spark.createDataFrame(
        [(11, 1, "MICU", ts("2100-01-20 01:00:00"), 1.0), (11, 2, "MICU", ts("2100-01-21 00:00:00"), 1.0),
         (10, 3, "MICU", ts("2100-01-01 01:00:00"), 2.0)],
        "hadm_id long, icustay_id long, first_careunit string, intime timestamp_ntz, los double")
    row = D.mortality_by_careunit(admissions, stays).first()
    assert (row["n_admissions"], row["n_deaths"], row["mortality_rate_pct"]) == (2, 2, 100.0)
    row = D.mortality_by_careunit(admissions, stays, dedup=True).first()
    assert (row["n_admissions"], row["n_deaths"], row["mortality_rate_pct"]) == (2, 1, 50.0)


def test_rates_are_rounded_percentages(spark, admissions):
    rows = {r["admission_type"]: r for r in D.mortality_by_admission_type(admissions).collect()}
    assert rows["EMERGENCY"]["mortality_rate_pct"] == 50.0
    assert rows["URGENT"]["mortality_rate_pct"] == 0.0
    assert all(0 <= r["mortality_rate_pct"] <= 100 for r in rows.values())


def test_top_diagnoses_limit_ties_and_unmatched_codes(spark):
    diag = spark.createDataFrame([(1, "0389"), (1, "4280"), (2, "4280"), (3, "9999"), (3, "0389")],
                                 "hadm_id long, icd9_code string")
    dic = spark.createDataFrame([("0389", "Septicemia NOS"), ("4280", "CHF NOS")],
                                "icd9_code string, short_title string")
    rows = D.top_diagnoses(diag, dic, 3).collect()
    assert [(r["icd9_code"], r["short_title"], r["n_occurrences"]) for r in rows] == [
        ("0389", "Septicemia NOS", 2), ("4280", "CHF NOS", 2), ("9999", None, 1)]
    assert len(D.top_diagnoses(diag, dic, 1).collect()) == 1


def test_t4_first_unit_is_earliest_stay_ties_by_id(spark):
    stays = spark.createDataFrame([
        (1, 5, "SICU", ts("2100-01-02 00:00:00"), 1.0),
        (1, 4, "MICU", ts("2100-01-01 00:00:00"), 2.0),
        (1, 3, "CCU", ts("2100-01-01 00:00:00"), 0.5),
        (2, 7, None, ts("2100-01-01 00:00:00"), 1.0),
        (2, 8, "CCU", ts("2100-01-03 00:00:00"), 1.0),
    ], "hadm_id long, icustay_id long, first_careunit string, intime timestamp_ntz, los double")
    got = {r["hadm_id"]: r for r in FT.icu_rollup(stays).collect()}
    assert got[1]["first_icu_careunit"] == "CCU"
    assert got[1]["n_icu_stays"] == 3 and got[1]["total_icu_los_days"] == 3.5
    assert got[2]["first_icu_careunit"] is None


def test_t5_lab_window_inclusive_no_lower_bound(spark, admissions):
    labs = spark.createDataFrame([
        (10, ts("2100-01-02 00:00:00"), "abnormal"),    # exactly +24 h: in
        (10, ts("2100-01-02 00:00:01"), "abnormal"),    # just after: out
        (10, ts("2099-12-01 00:00:00"), None),          # before admission: in, normal
        (None, ts("2100-01-01 00:00:00"), "abnormal"),  # no admission: out
        (99, ts("2100-01-01 00:00:00"), "abnormal"),    # unknown admission: out
    ], "hadm_id long, charttime timestamp_ntz, flag string")
    rows = FT.lab_window(labs, admissions).collect()
    assert [(r["hadm_id"], r["n_lab_results_24h"], r["n_abnormal_labs_24h"]) for r in rows] == [(10, 2, 1)]


def test_lab_window_salted_path_equals_plain(spark, admissions):
    labs = spark.createDataFrame(
        [(10, ts("2100-01-01 00:00:00") + dt.timedelta(minutes=37 * i), "abnormal" if i % 3 else None)
         for i in range(200)] + [(12, ts("2100-03-01 05:00:00"), None)],
        "hadm_id long, charttime timestamp_ntz, flag string")
    plain = sorted(map(tuple, FT.lab_window(labs, admissions).collect()))
    salted = sorted(map(tuple, FT.lab_window(labs, admissions, hot_threshold=5).collect()))
    assert plain == salted == [(10, 39, 26), (12, 1, 0)]


def test_q6_intervals(spark, admissions):
    rows = S.readmission_intervals(admissions).collect()
    by = {r["hadm_id"]: r for r in rows}
    assert [r["admission_seq"] for r in rows if r["subject_id"] == 1] == [1, 2, 3]
    assert all(r["days_since_last_discharge"] is None for r in rows if r["admission_seq"] == 1)
    assert by[11]["days_since_last_discharge"] == 15.0
    assert by[21]["days_since_last_discharge"] is None  # previous discharge time unknown
    assert by[31]["days_since_last_discharge"] == -5.0  # overlapping stays


def test_t7_readmission_label(spark, admissions):
    by = {r["hadm_id"]: r for r in S.readmission_target(admissions).collect()}
    assert by[10]["readmit_30d"] == 1 and by[10]["days_to_next_admission"] == 15.0
    assert by[11]["hospital_expire_flag"] == 1 and by[11]["readmit_30d"] == 0  # death row, later row
    assert by[12]["readmit_30d"] is None and by[12]["days_to_next_admission"] is None
    assert by[20]["readmit_30d"] == 0 and by[20]["days_to_next_admission"] is None  # NULL discharge
    assert by[30]["readmit_30d"] == 1 and by[30]["days_to_next_admission"] == -5.0  # overlap
    for r in by.values():
        assert (r["readmit_30d"] is None) == (r["days_to_next_admission"] is None) or r["hadm_id"] == 20


def test_30_day_edge_is_inclusive(spark):
    a = adm_df(spark, [
        (1, 1, ts("2100-01-01 00:00:00"), ts("2100-01-02 00:00:00"), "X", 0),
        (1, 2, ts("2100-02-01 00:00:00"), ts("2100-02-02 00:00:00"), "X", 0),
        (1, 3, ts("2100-03-04 00:00:01"), ts("2100-03-05 00:00:00"), "X", 0),
    ])
    by = {r["hadm_id"]: r["readmit_30d"] for r in S.readmission_target(a).collect()}
    assert by == {1: 1, 2: 0, 3: None}


def test_chi_square_tail_closed_form():
    for x, k in [(3.841458820694124, 1), (5.991464547107979, 2), (7.814727903251178, 3),
                 (9.487729036781154, 4), (11.070497693516351, 5)]:
        assert math.isclose(chi2_sf(x, k), 0.05, rel_tol=1e-9)
    assert chi2_sf(0.0, 3) == 1.0


def _direct_chi2(table, yates):
    n = sum(sum(r) for r in table)
    rows = [sum(r) for r in table]
    cols = [sum(r[j] for r in table) for j in range(2)]
    stat = 0.0
    for i, r in enumerate(table):
        for j in range(2):
            e = rows[i] * cols[j] / n
            diff = abs(r[j] - e)
            if yates:
                diff = max(diff - 0.5, 0.0)
            stat += diff * diff / e
    return stat


@pytest.mark.parametrize("table", [
    [[10, 20], [30, 40]],
    [[3, 97], [12, 88], [1, 50]],
    [[40, 89], [2, 45], [7, 60], [15, 15]],
])
def test_t6_chi_square_matches_direct_formula(spark, table):
    df = spark.createDataFrame([(f"g{i}", r[0] + r[1], r[0]) for i, r in enumerate(table)],
                               "g string, n_admissions long, n_deaths long")
    row = mortality_significance_test(df, "t").first()
    dof = len(table) - 1
    expect = _direct_chi2(table, yates=dof == 1)
    assert row["dof"] == dof
    assert math.isclose(row["chi_square"], round(expect, 6), abs_tol=2e-6)
    assert math.isclose(row["p_value"], round(chi2_sf(expect, dof), 6), abs_tol=2e-6)


def test_chi_square_rejects_negative_cells(spark):
    df = spark.createDataFrame([("a", 2, 3), ("b", 10, 1)], "g string, n_admissions long, n_deaths long")
    row = mortality_significance_test(df, "t").first()
    assert row["chi_square"] is None and row["p_value"] is None and row["unreliable"] is True


def test_finalize_features_fills_and_caps(spark):
    base = spark.createDataFrame([
        (1, 1, "E", "L", "I", "W", 0, "M", 20000.0, 2.0, 1, 3.0, "MICU", 2, 4, 1),
        (1, 2, "E", "L", "I", "W", 1, "M", 365.25 * 100, None, None, None, None, None, None, None),
        (2, 3, "U", "L", "I", "W", 0, "F", None, 4.0, None, None, None, 1, 0, 0),
    ], "subject_id long, hadm_id long, admission_type string, admission_location string, "
       "insurance string, ethnicity string, hospital_expire_flag int, gender string, "
       "age_days double, hospital_los_days double, n_icu_stays long, total_icu_los_days double, "
       "first_icu_careunit string, n_diagnoses long, n_lab_results_24h long, n_abnormal_labs_24h long")
    out = {r["hadm_id"]: r for r in FT.finalize_features(base).collect()}
    assert out[2]["age_years"] == 90.0                       # capped
    assert out[3]["age_years"] == (20000.0 / 365.25 + 90.0) / 2  # median after capping
    assert out[2]["hospital_los_days"] == 3.0                # median of 2 and 4
    assert out[2]["first_icu_careunit"] == "No_ICU_Stay"
    assert out[1]["pct_abnormal_labs_24h"] == 25.0
    assert out[3]["pct_abnormal_labs_24h"] == 0.0            # zero labs: NULL, then 0
    for r in out.values():
        for c in ["age_years", "hospital_los_days", "n_icu_stays", "n_lab_results_24h",
                  "pct_abnormal_labs_24h", "first_icu_careunit"]:
            assert r[c] is not None


def test_approximate_options_stay_close(spark):
    from wardlens.sources import standin
    from conftest import SF_SMALL
    t = standin.standin_tables(spark, SF_SMALL)
    exact = D.cohort_summary(t["patients"], t["admissions"]).first()
    approx = D.cohort_summary(t["patients"], t["admissions"], approx=True).first()
    for c in ("n_patients", "n_admissions"):
        assert abs(approx[c] - exact[c]) <= 0.15 * exact[c]  # 3 x the default rsd of 0.05
    assert (approx["n_male"], approx["n_female"]) == (exact["n_male"], exact["n_female"])
    narrow = FT._admission_patient(t["admissions"], t["patients"]).select(
        FT.days_between("admittime", "dob").alias("age_days"),
        FT.days_between("dischtime", "admittime").alias("hospital_los_days"))
    e, a = FT.feature_medians(narrow), FT.feature_medians(narrow, approx_accuracy=10_000)
    assert abs(e["age_years"] - a["age_years"]) < 1.0
    assert abs(e["hospital_los_days"] - a["hospital_los_days"]) < 1.0


def test_chi_square_tail_column_matches_closed_form(spark):
    from pyspark.sql import functions as F
    from pyspark.sql import functions as F

    from wardlens.functions.chisq import chi2_sf_col
    cases = [(x, k) for k in (1, 2, 3, 4, 5, 10, 101) for x in (0.0, 0.3, 2.5, 9.97, 30.0, 450.0)]
    df = spark.createDataFrame(cases, "x double, k int")
    for r in df.select("x", "k", chi2_sf_col(F.col("x"), F.col("k")).alias("p")).collect():
        assert abs(r["p"] - chi2_sf(r["x"], r["k"])) < 1e-9, (r["x"], r["k"])


def test_day_differences_ignore_the_session_time_zone(spark):
    from pyspark.sql import functions as F
    from wardlens.functions.timeutil import days_between, micros_between
    df = spark.createDataFrame([(ts("2021-03-14 02:30:00"), ts("2021-03-14 04:30:00")),
                                (ts("2021-11-07 01:30:00"), ts("2021-11-08 01:30:00"))],
                               "a timestamp_ntz, b timestamp_ntz")
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # DST gap and overlap
        rows = df.select(micros_between("b", "a").alias("m"), days_between("b", "a").alias("d")).collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert [r["m"] for r in rows] == [2 * 3600 * 10**6, 24 * 3600 * 10**6]
    assert rows[1]["d"] == 1.0


def test_chi_square_tail_on_large_and_small_values(spark):
    from pyspark.sql import functions as F

    from wardlens.functions.chisq import chi2_sf_col
    cases = [(1e10, 4), (1e10, 3), (1e4, 4), (2e7, 1), (1400.0, 2), (700.0, 3), (50.0, 1), (1e-9, 1), (2.9, 1), (3.1, 1), (30.0, 41)]
    df = spark.createDataFrame([(float(x), k) for x, k in cases], "x double, k int")
    for r in df.select("x", "k", chi2_sf_col(F.col("x"), F.col("k")).alias("p")).collect():
        assert math.isclose(r["p"], chi2_sf(r["x"], r["k"]), rel_tol=1e-9, abs_tol=1e-300), (r["x"], r["k"])


def test_chi_square_statistic_does_not_cancel(spark):
    # Deaths 1000 -/+ a little per group: the statistic stays small while the counts grow.
    n = 10**13
    rows = [("a", n, n // 2 + 10**6), ("b", n, n // 2 - 10**6), ("c", n, n // 2)]
    df = spark.createDataFrame(rows, "g string, n_admissions long, n_deaths long")
    want = 2 * 2 * (10**6) ** 2 / (n / 2)
    assert math.isclose(mortality_significance_test(df, "t").first()["chi_square"], want, rel_tol=1e-6)
