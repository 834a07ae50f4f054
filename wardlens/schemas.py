"""Declared schemas and the fixed values the analysis depends on.

Tables are declared, never inferred: inference costs a second pass over the
data and turns all-digit codes such as ``0389`` into integers.
"""

from __future__ import annotations

from pyspark.sql import types as T

L, I, D, S, TS = T.LongType(), T.IntegerType(), T.DoubleType(), T.StringType(), T.TimestampNTZType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


PATIENTS = _struct(
    ("row_id", L), ("subject_id", L), ("gender", S), ("dob", TS), ("dod", TS),
    ("dod_hosp", TS), ("dod_ssn", TS), ("expire_flag", I),
)

ADMISSIONS = _struct(
    ("row_id", L), ("subject_id", L), ("hadm_id", L), ("admittime", TS),
    ("dischtime", TS), ("deathtime", TS), ("admission_type", S),
    ("admission_location", S), ("discharge_location", S), ("insurance", S),
    ("language", S), ("religion", S), ("marital_status", S), ("ethnicity", S),
    ("edregtime", TS), ("edouttime", TS), ("diagnosis", S),
    ("hospital_expire_flag", I), ("has_chartevents_data", I),
)

ICUSTAYS = _struct(
    ("row_id", L), ("subject_id", L), ("hadm_id", L), ("icustay_id", L),
    ("dbsource", S), ("first_careunit", S), ("last_careunit", S),
    ("first_wardid", I), ("last_wardid", I), ("intime", TS), ("outtime", TS),
    ("los", D),
)

DIAGNOSES_ICD = _struct(
    ("row_id", L), ("subject_id", L), ("hadm_id", L), ("seq_num", I),
    ("icd9_code", S),
)

D_ICD_DIAGNOSES = _struct(
    ("row_id", L), ("icd9_code", S), ("short_title", S), ("long_title", S),
)

LABEVENTS = _struct(
    ("row_id", L), ("subject_id", L), ("hadm_id", L), ("itemid", L),
    ("charttime", TS), ("value", S), ("valuenum", D), ("valueuom", S),
    ("flag", S),
)

# Source table name (file stem, any case) -> declared schema.
TABLE_SCHEMAS: dict[str, T.StructType] = {
    "patients": PATIENTS,
    "admissions": ADMISSIONS,
    "icustays": ICUSTAYS,
    "diagnoses_icd": DIAGNOSES_ICD,
    "d_icd_diagnoses": D_ICD_DIAGNOSES,
    "labevents": LABEVENTS,
}

# ---------------------------------------------------------------------------
# Fixed values. These must equal the reference analysis for equal results.
# ---------------------------------------------------------------------------
TABLE_NAMES = ["PATIENTS", "ADMISSIONS", "ICUSTAYS", "DIAGNOSES_ICD", "D_ICD_DIAGNOSES", "LABEVENTS"]
FEATURE_COLS_NUMERIC = ["age_years", "n_lab_results_24h", "pct_abnormal_labs_24h"]
FEATURE_COLS_CATEGORICAL = ["gender", "admission_type", "first_icu_careunit"]
LEAKY_COLUMNS = {"hospital_los_days", "total_icu_los_days", "n_diagnoses", "n_icu_stays"}
MORTALITY_TARGET = "hospital_expire_flag"
READMISSION_TARGET = "readmit_30d"
RF_PARAM_GRID = {
    "numTrees": [100, 200, 300],
    "maxDepth": [3, 5, 7, None],
    "minInstancesPerNode": [1, 3, 5],
}
N_CV_SPLITS = 5
RANDOM_SEED = 42
NO_ICU_LABEL = "No_ICU_Stay"
AGE_CAP_YEARS = 90.0
DAYS_PER_YEAR = 365.25
LAB_WINDOW_HOURS = 24
READMIT_WINDOW_DAYS = 30
ABNORMAL_FLAG = "abnormal"
MIN_EXPECTED_COUNT = 5.0
TOP_DIAGNOSES_DEFAULT = 10
# ---------------------------------------------------------------------------

# Spark's forest depth cap is 30; an unlimited depth maps to it.
UNLIMITED_DEPTH_DEFAULT = 30

# Columns of the finished feature table, in order.
FEATURE_TABLE_COLUMNS = [
    "subject_id", "hadm_id", "admission_type", "admission_location", "insurance",
    "ethnicity", "hospital_expire_flag", "gender", "hospital_los_days",
    "n_icu_stays", "total_icu_los_days", "first_icu_careunit", "n_diagnoses",
    "n_lab_results_24h", "age_years", "pct_abnormal_labs_24h",
]
