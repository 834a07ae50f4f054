"""Per-patient admission sequences.

Both queries use one ordering per patient: admit time, then admission id as
the tie-break. The window work goes through :func:`keyed_sequence`, so a
patient with a huge number of admissions is split over many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.timeutil import days_between, micros_between
from wardlens.plans.ordering import DEFAULT_HOT_THRESHOLD, keyed_sequence
from wardlens.schemas import READMIT_WINDOW_DAYS


def readmission_intervals(admissions: DataFrame, *, hot_threshold: int = DEFAULT_HOT_THRESHOLD,
                          sort: bool = True) -> DataFrame:
    """Q6: admission number per patient and days since the previous discharge.

    ``days_since_last_discharge`` is NULL on a patient's first admission.
    """
    a = admissions.select("subject_id", "hadm_id", "admittime", "dischtime")
    seq = keyed_sequence(a, "subject_id", ["admittime", "hadm_id"], seq_col="admission_seq",
                         lag=["dischtime"], hot_threshold=hot_threshold)
    out = seq.select(
        "subject_id", "hadm_id", "admittime", "dischtime", "admission_seq",
        days_between("admittime", "prev_dischtime").alias("days_since_last_discharge"),
    )
    return out.orderBy("subject_id", "admittime", "hadm_id") if sort else out


def readmission_target(admissions: DataFrame, *, window_days: int = READMIT_WINDOW_DAYS,
                       hot_threshold: int = DEFAULT_HOT_THRESHOLD, sort: bool = True) -> DataFrame:
    """Q7: days to the patient's next admission and the 30-day readmission label.

    ``readmit_30d`` is NULL exactly when there is no next admission; it does
    not look at the death flag. A NULL discharge time with a next admission
    gives label 0 and a NULL day count; overlapping stays give negative days
    and label 1.
    """
    a = admissions.select("subject_id", "hadm_id", "hospital_expire_flag", "admittime", "dischtime")
    seq = keyed_sequence(a, "subject_id", ["admittime", "hadm_id"], seq_col=None,
                         lead=["admittime"], hot_threshold=hot_threshold)
    gap = days_between("next_admittime", "dischtime")
    out = seq.select(
        "subject_id", "hadm_id", "hospital_expire_flag", "dischtime",
        gap.alias("days_to_next_admission"),
        F.when(F.col("next_admittime").isNull(), F.lit(None).cast("int"))
        .when(gap <= F.lit(float(window_days)), F.lit(1))
        .otherwise(F.lit(0)).alias("readmit_30d"),
        "admittime",
    )
    if sort:
        out = out.orderBy("subject_id", "admittime", "hadm_id")
    return out.drop("admittime")


def event_gaps(events: DataFrame, *, key: str = "user_id", ts: str = "ts", tie: str = "event_id",
               hot_threshold: int = DEFAULT_HOT_THRESHOLD) -> DataFrame:
    """Sequence number, seconds since the previous and until the next event per user."""
    e = events.select(key, tie, ts)
    seq = keyed_sequence(e, key, [ts, tie], seq_col="event_seq", lag=[ts], lead=[ts],
                         hot_threshold=hot_threshold)
    return seq.select(
        key, tie, ts, "event_seq",
        (micros_between(ts, f"prev_{ts}") / F.lit(1e6)).alias("secs_since_prev"),
        (micros_between(f"next_{ts}", ts) / F.lit(1e6)).alias("secs_to_next"),
    )


def readmission_summary(intervals: DataFrame, window_days: int = READMIT_WINDOW_DAYS) -> DataFrame:
    """Counts over Q6: admissions, repeat admissions, repeats within ``window_days``
    of the previous discharge, and the most admissions of one patient."""
    return intervals.agg(
        F.count(F.lit(1)).alias("n_admissions"),
        F.count_if(F.col("admission_seq") > 1).alias("n_repeat_admissions"),
        F.count_if(F.col("days_since_last_discharge") <= F.lit(float(window_days))).alias("n_within_window"),
        F.max("admission_seq").alias("max_admissions_per_patient"),
    )
