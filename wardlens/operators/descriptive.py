"""Descriptive cohort queries (Q1-Q5, Q9).

Each aggregates before it joins wherever the join would fan out, so a hot key
(one patient with a third of the admissions, one admission with a third of the
stays) is collapsed by map-side partial aggregation before any shuffle.
Results are sorted with a key tie-break so the order is deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.functions.columns import rate_pct
from wardlens.schemas import TOP_DIAGNOSES_DEFAULT


def _one():
    return F.lit(1)


def _one_row(*parts: DataFrame) -> DataFrame:
    """Merge one-row aggregates with disjoint columns into one row (no join)."""
    merged = parts[0]
    for p in parts[1:]:
        merged = merged.unionByName(p, allowMissingColumns=True)
    cols = [c for p in parts for c in p.columns]
    return merged.agg(*[F.max(c).alias(c) for c in cols])


def _distinct(col: str, approx: bool):
    return F.approx_count_distinct(col) if approx else F.count_distinct(col)


def cohort_summary(patients: DataFrame, admissions: DataFrame, approx: bool = False) -> DataFrame:
    """Q1: patients, admissions and gender counts of ``patients LEFT JOIN admissions``.

    Gender counts count joined rows, i.e. admissions (a patient with 15
    admissions counts 15 times, one with none counts once). Computed without
    the fan-out join: admissions are counted per patient first and each
    patient row is weighted by that count; the distinct admissions are those
    whose patient exists (a semi join). ``approx=True`` uses HyperLogLog++
    distinct counts (``approx_count_distinct``) instead of exact ones.
    """
    p = patients.select("subject_id", "gender")
    per_subject = admissions.groupBy("subject_id").agg(F.count(_one()).alias("_n_adm"))
    weight = F.coalesce(F.col("_n_adm"), _one())
    gender_part = p.join(per_subject, "subject_id", "left").agg(
        _distinct("subject_id", approx).alias("n_patients"),
        F.sum(F.when(F.col("gender") == "M", weight).otherwise(0)).cast("long").alias("n_male"),
        F.sum(F.when(F.col("gender") == "F", weight).otherwise(0)).cast("long").alias("n_female"),
    )
    adm_part = (admissions.select("subject_id", "hadm_id")
                .join(p.select("subject_id"), "subject_id", "left_semi")
                .agg(_distinct("hadm_id", approx).alias("n_admissions")))
    return _one_row(gender_part, adm_part).select("n_patients", "n_admissions", "n_male", "n_female")


def length_of_stay_by_careunit(icustays: DataFrame) -> DataFrame:
    """Q2: ICU stays and rounded mean/min/max length of stay (days) per first care unit."""
    return (icustays.where(F.col("los").isNotNull())
            .groupBy("first_careunit")
            .agg(F.count(_one()).alias("n_stays"),
                 F.round(F.avg("los"), 2).alias("avg_los_days"),
                 F.round(F.min("los"), 2).alias("min_los_days"),
                 F.round(F.max("los"), 2).alias("max_los_days"))
            .orderBy(F.desc("avg_los_days"), F.asc_nulls_first("first_careunit")))


def top_diagnoses(diagnoses_icd: DataFrame, d_icd_diagnoses: DataFrame,
                  n: int = TOP_DIAGNOSES_DEFAULT) -> DataFrame:
    """Q3: the ``n`` most frequent codes with their short titles (ties by code, title).

    Codes are counted before the dictionary join; a code listed k times in the
    dictionary still counts k times per title, as in the joined form.
    """
    counts = diagnoses_icd.groupBy("icd9_code").agg(F.count(_one()).alias("_n"))
    titled = counts.join(d_icd_diagnoses.select("icd9_code", "short_title"), "icd9_code", "left")
    return (titled.groupBy("icd9_code", "short_title")
            .agg(F.sum("_n").alias("n_occurrences"))
            .orderBy(F.desc("n_occurrences"), F.asc_nulls_first("icd9_code"),
                     F.asc_nulls_first("short_title"))
            .limit(int(n)))


def _by_rate(df: DataFrame, group: str, sort: bool) -> DataFrame:
    return df.orderBy(F.desc("mortality_rate_pct"), F.asc_nulls_first(group)) if sort else df


def mortality_by_admission_type(admissions: DataFrame, sort: bool = True) -> DataFrame:
    """Q4: admissions, deaths and mortality rate (%, 1 decimal) per admission type.

    ``sort=False`` leaves out the final sort, for consumers that do not need it.
    """
    rates = (admissions.groupBy("admission_type")
             .agg(F.count(_one()).alias("n_admissions"),
                  F.sum("hospital_expire_flag").cast("long").alias("n_deaths"))
             .withColumn("mortality_rate_pct", rate_pct("n_deaths", "n_admissions", 1)))
    return _by_rate(rates, "admission_type", sort)


def mortality_by_careunit(admissions: DataFrame, icustays: DataFrame,
                          dedup: bool = False, sort: bool = True) -> DataFrame:
    """Q5: distinct admissions, deaths and mortality rate per ICU first care unit.

    By default deaths are summed per joined stay while the denominator counts
    distinct admissions, so an admission with two stays in one unit counts its
    death twice and a rate can pass 100 %. ``dedup=True`` counts each
    (admission, unit) once.

    Stays are reduced to one row per (admission, unit) before the join and
    admissions to one row per admission, so neither side fans out.
    """
    stays = icustays.groupBy("hadm_id", "first_careunit").agg(F.count(_one()).alias("_n_stays"))
    adm = admissions.groupBy("hadm_id").agg(F.sum("hospital_expire_flag").alias("_deaths"))
    joined = stays.join(adm, "hadm_id")
    deaths = F.col("_deaths") if dedup else F.col("_deaths") * F.col("_n_stays")
    rates = (joined.groupBy("first_careunit")
             .agg(F.count(_one()).alias("n_admissions"), F.sum(deaths).cast("long").alias("n_deaths"))
             .withColumn("mortality_rate_pct", rate_pct("n_deaths", "n_admissions", 1)))
    return _by_rate(rates, "first_careunit", sort)


def run_all_descriptive_queries(tables: dict[str, DataFrame],
                                n_top: int = TOP_DIAGNOSES_DEFAULT) -> dict[str, DataFrame]:
    """Q9: every descriptive query by name, plus the chi-square tests of Q4 and Q5."""
    from wardlens.operators.stats import mortality_significance_test

    results = {
        "cohort_summary": cohort_summary(tables["patients"], tables["admissions"]),
        "length_of_stay_by_careunit": length_of_stay_by_careunit(tables["icustays"]),
        "top_diagnoses": top_diagnoses(tables["diagnoses_icd"], tables["d_icd_diagnoses"], n_top),
        "mortality_by_admission_type": mortality_by_admission_type(tables["admissions"]),
        "mortality_by_careunit": mortality_by_careunit(tables["admissions"], tables["icustays"]),
    }
    results["significance_admission_type"] = mortality_significance_test(
        mortality_by_admission_type(tables["admissions"], sort=False), "mortality by admission type")
    results["significance_careunit"] = mortality_significance_test(
        mortality_by_careunit(tables["admissions"], tables["icustays"], sort=False), "mortality by care unit")
    return results
