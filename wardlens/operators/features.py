"""Admission-level feature table.

Plan: stays, diagnoses and in-window labs are each aggregated to one row per
admission first (no fan-out product), then left-joined to admissions x
patients. The three aggregates come out hash-partitioned by ``hadm_id`` so the
three left joins share one exchange of the admission rows. The lab join is the
big one (labs are the largest table) and is a plain join: with
``spark.sql.adaptive.forceOptimizeSkewedJoin`` (set here and in the session
defaults) Spark splits the partition of an admission with a huge number of labs
from the measured shuffle sizes, so labs are read once and never counted first.
Building the plans runs nothing: the medians are scalar subqueries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.columns import cap_upper, indicator, safe_ratio
from wardlens.functions.timeutil import days_between, plus_hours
from wardlens.plans.median import exact_medians, median_row
from wardlens.plans.skew import salted_join
from wardlens.schemas import (ABNORMAL_FLAG, AGE_CAP_YEARS, DAYS_PER_YEAR, FEATURE_TABLE_COLUMNS,
                              LAB_WINDOW_HOURS, NO_ICU_LABEL)
from wardlens.session import split_skewed_joins


def _one():
    return F.lit(1)

BASE_COLUMNS = [
    "subject_id", "hadm_id", "admission_type", "admission_location", "insurance", "ethnicity",
    "hospital_expire_flag", "gender", "age_days", "hospital_los_days", "n_icu_stays",
    "total_icu_los_days", "first_icu_careunit", "n_diagnoses", "n_lab_results_24h",
    "n_abnormal_labs_24h",
]
FILL_ZERO = ["n_icu_stays", "total_icu_los_days", "n_diagnoses", "n_lab_results_24h",
             "pct_abnormal_labs_24h"]


def icu_rollup(icustays: DataFrame) -> DataFrame:
    """Stays per admission: count, summed LOS, unit of the earliest stay.

    The unit is taken from the stay with the earliest ``intime`` (ties by
    ``icustay_id``); a NULL unit on that stay stays NULL. It is the last field
    of the smallest (intime, icustay_id, unit) struct: one partially
    aggregated pass (cheaper than ``min_by`` with a struct ordering).
    """
    return icustays.groupBy("hadm_id").agg(
        F.count(_one()).alias("n_icu_stays"),
        F.sum("los").alias("total_icu_los_days"),
        F.min(F.struct("intime", "icustay_id", "first_careunit")).alias("_first"),
    ).select("hadm_id", "n_icu_stays", "total_icu_los_days",
             F.col("_first.first_careunit").alias("first_icu_careunit"))


def diagnosis_rollup(diagnoses_icd: DataFrame, approx: bool = False) -> DataFrame:
    """Distinct diagnosis codes per admission (``approx=True``: HyperLogLog++ estimate)."""
    n = F.approx_count_distinct("icd9_code") if approx else F.count_distinct("icd9_code")
    return diagnoses_icd.groupBy("hadm_id").agg(n.alias("n_diagnoses"))


def lab_window(labevents: DataFrame, admissions: DataFrame, hours: int = LAB_WINDOW_HOURS,
               hot_threshold: int | None = None) -> DataFrame:
    """Labs charted up to ``hours`` after admission (no lower bound, inclusive) per admission.

    A missing flag counts as normal; labs with a NULL or unknown admission id
    drop out. With ``hot_threshold``, admissions of more labs than that are
    counted first and salted (:func:`salted_join`), for sessions without AQE.
    """
    split_skewed_joins(labevents.sparkSession)
    labs = labevents.where(F.col("hadm_id").isNotNull()).select("hadm_id", "charttime", "flag")
    adm = admissions.select("hadm_id", "admittime")
    if hot_threshold is None:
        joined = labs.join(adm, "hadm_id").where(F.col("charttime") <= plus_hours(F.col("admittime"), hours))
    else:
        joined = salted_join(labs, adm, ["hadm_id"], hot_threshold=hot_threshold,
                             condition=lambda big, small: big("charttime") <= plus_hours(small("admittime"), hours))
    return joined.groupBy("hadm_id").agg(
        F.count(_one()).alias("n_lab_results_24h"),
        F.sum(indicator(F.col("flag") == F.lit(ABNORMAL_FLAG))).cast("long").alias("n_abnormal_labs_24h"),
    )


def admission_patient(admissions: DataFrame, patients: DataFrame) -> DataFrame:
    """Admissions that have a patient, with the patient's gender and birth."""
    a = admissions.select("subject_id", "hadm_id", "admission_type", "admission_location",
                          "insurance", "ethnicity", "hospital_expire_flag", "admittime", "dischtime")
    return a.join(patients.select("subject_id", "gender", "dob"), "subject_id")


_admission_patient = admission_patient


def _joined_admissions(tables: dict[str, DataFrame]) -> DataFrame:
    """J1, read from a published store where there is one (:mod:`wardlens.sources.store`)."""
    if "cohort_admissions" in tables:
        return tables["cohort_admissions"]
    return admission_patient(tables["admissions"], tables["patients"])


def cohort_base(tables: dict[str, DataFrame], *, lab_hot_threshold: int | None = None) -> DataFrame:
    """Q10: one row per admission with a patient; 16 columns (``BASE_COLUMNS``)."""
    base = _joined_admissions(tables)
    icu = icu_rollup(tables["icustays"])
    diag = diagnosis_rollup(tables["diagnoses_icd"])
    lab = lab_window(tables["labevents"], tables["admissions"], hot_threshold=lab_hot_threshold)
    joined = (base.join(icu, "hadm_id", "left")
              .join(diag, "hadm_id", "left")
              .join(lab, "hadm_id", "left"))
    return joined.select(
        "subject_id", "hadm_id", "admission_type", "admission_location", "insurance", "ethnicity",
        "hospital_expire_flag", "gender",
        days_between("admittime", "dob").alias("age_days"),
        days_between("dischtime", "admittime").alias("hospital_los_days"),
        "n_icu_stays", "total_icu_los_days", "first_icu_careunit", "n_diagnoses",
        "n_lab_results_24h", "n_abnormal_labs_24h",
    )


def _age_years(age_days) -> F.Column:
    return cap_upper(F.col(age_days) / F.lit(DAYS_PER_YEAR) if isinstance(age_days, str)
                     else age_days / F.lit(DAYS_PER_YEAR), AGE_CAP_YEARS)


def feature_medians(source: DataFrame, approx_accuracy: int | None = None,
                    only_missing: bool = False) -> dict[str, float | None]:
    """Medians of ``hospital_los_days`` and capped ``age_years`` over ``source``.

    Exact by default; ``approx_accuracy`` switches to one ``percentile_approx``
    pass with that accuracy (rank error at most n / accuracy).
    ``source`` needs ``age_days`` and ``hospital_los_days``, one row per feature row.
    With ``only_missing`` one pass first looks whether any value is missing; a
    column without a missing value needs no median and is left out.
    """
    both = source.select("hospital_los_days", _age_years("age_days").alias("age_years"))
    cols = both.columns
    if only_missing:
        gaps = both.agg(*[F.max(F.col(c).isNull()).alias(c) for c in cols]).first()
        cols = [c for c in cols if gaps[c]]
        if not cols:
            return {}
    if approx_accuracy:
        row = both.agg(*[F.percentile_approx(c, 0.5, approx_accuracy).alias(c) for c in cols]).first()
        return {c: (None if row[c] is None else float(row[c])) for c in cols}
    return exact_medians(both, cols)


def median_features(source: DataFrame, approx_accuracy: int | None = None) -> DataFrame:
    """F9 as a plan: one row with the medians of ``hospital_los_days`` and capped ``age_years``.

    Exact, or one ``percentile_approx`` pass with ``approx_accuracy``; see
    :func:`feature_medians` for the numbers themselves.
    """
    both = source.select("hospital_los_days", _age_years("age_days").alias("age_years"))
    if approx_accuracy:
        return both.agg(*[F.percentile_approx(c, 0.5, approx_accuracy).alias(c) for c in both.columns])
    return median_row(both, both.columns)


def finalize_features(base: DataFrame, medians: dict[str, float | None] | DataFrame | None = None) -> DataFrame:
    """Q11: cap age at 90 years, abnormal-lab percentage, fill what the left joins left NULL.

    Counts and the percentage become 0, a missing unit ``No_ICU_Stay``; stay
    length and age get their whole-frame medians (age after capping).
    ``medians`` are values, or a one-row table that is read as scalar
    subqueries when the result is (by default the medians of ``base``).
    """
    if medians is None:
        medians = median_features(base)
    df = base.select(
        *[c for c in base.columns if c not in ("age_days", "n_abnormal_labs_24h")],
        _age_years("age_days").alias("age_years"),
        safe_ratio(F.lit(100.0) * F.col("n_abnormal_labs_24h"), "n_lab_results_24h")
        .alias("pct_abnormal_labs_24h"),
    )
    df = df.fillna(0, subset=[c for c in FILL_ZERO if c in df.columns])
    df = df.fillna({"first_icu_careunit": NO_ICU_LABEL})
    if isinstance(medians, DataFrame):
        fills = {c: medians.select(c).scalar() for c in medians.columns}
    else:
        fills = {c: F.lit(v) for c, v in medians.items() if v is not None}
    return df.withColumns({c: F.coalesce(F.col(c), v) for c, v in fills.items() if c in df.columns})


def build_cohort_features(tables: dict[str, DataFrame], *,
                          lab_hot_threshold: int | None = None,
                          median_accuracy: int | None = None) -> DataFrame:
    """Q12: finished feature table, one row per admission (``FEATURE_TABLE_COLUMNS``).

    The medians only need admissions x patients (the other joins add columns,
    never rows), so they are computed from that narrow join, not the full plan,
    as scalar subqueries: building the table runs no job.
    ``median_accuracy`` makes them approximate.
    """
    narrow = _joined_admissions(tables).select(
        days_between("admittime", "dob").alias("age_days"),
        days_between("dischtime", "admittime").alias("hospital_los_days"),
    )
    base = cohort_base(tables, lab_hot_threshold=lab_hot_threshold)
    return finalize_features(base, median_features(narrow, median_accuracy)).select(*FEATURE_TABLE_COLUMNS)


def feature_report(features: DataFrame) -> DataFrame:
    """Row count, column count and in-hospital mortality rate of a feature table."""
    return features.agg(
        F.count(_one()).alias("n_admissions"),
        F.lit(len(features.columns)).alias("n_columns"),
        F.avg("hospital_expire_flag").alias("mortality_rate"),
    )
