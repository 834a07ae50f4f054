"""Hospital-shaped views over the driver's TPC-H-like test tables.

These builders only rename and reshape columns so the operators have inputs
in the hospital schema; every operator works the same on real tables.
Mapping (fixed; the DuckDB oracle in ``__spark_entry__`` states the same):

* patients        <- customer: subject_id = c_custkey; gender 'M' for the
  AUTOMOBILE, BUILDING, FURNITURE segments else 'F';
  dob = 1890-01-01 + (c_custkey * 37 % 36500) days
* admissions      <- orders: subject_id = o_custkey, hadm_id = o_orderkey,
  admittime = o_orderdate, dischtime = admittime + (o_orderkey * 7 % 240) hours,
  admission_type = o_orderpriority, admission_location = o_orderstatus,
  insurance = 'I' || o_custkey % 4, ethnicity = 'E' || o_custkey % 5,
  hospital_expire_flag = (o_orderstatus = 'P')
* icustays        <- lineitem: hadm_id = l_orderkey,
  icustay_id = first 60 bits of md5 of the line key,
  first_careunit = l_returnflag || l_linestatus, intime = l_shipdate, los = l_quantity
* diagnoses_icd   <- lineitem: hadm_id = l_orderkey, seq_num = l_linenumber,
  icd9_code = string(l_partkey)
* d_icd_diagnoses <- part: icd9_code = string(p_partkey), short_title = p_name
* labevents       <- lineitem: hadm_id = l_orderkey, charttime = l_shipdate,
  flag = 'abnormal' when l_linestatus = 'O'
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


# Fixed values of the mapping.
MALE_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE"]
DOB_ORIGIN = "1890-01-01"
DOB_STEP, DOB_SPAN_DAYS = 37, 36500
STAY_HOURS_STEP, STAY_HOURS_SPAN = 7, 240
DEATH_STATUS = "P"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").alias("subject_id"),
        F.when(F.col("c_mktsegment").isin(*MALE_SEGMENTS), F.lit("M")).otherwise(F.lit("F")).alias("gender"),
        F.date_add(F.lit(DOB_ORIGIN).cast("date"),
                   (F.col("c_custkey") * DOB_STEP % DOB_SPAN_DAYS).cast("int"))
        .cast("timestamp_ntz").alias("dob"),
    )


def admissions(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = _read(spark, sf_dir, "orders")
    hours = (F.col("o_orderkey") * STAY_HOURS_STEP % STAY_HOURS_SPAN).cast("int")
    return o.select(
        F.col("o_custkey").alias("subject_id"),
        F.col("o_orderkey").alias("hadm_id"),
        F.col("o_orderdate").alias("admittime"),
        (F.col("o_orderdate") + F.make_dt_interval(F.lit(0), hours)).alias("dischtime"),
        F.col("o_orderpriority").alias("admission_type"),
        F.col("o_orderstatus").alias("admission_location"),
        F.concat(F.lit("I"), (F.col("o_custkey") % 4).cast("string")).alias("insurance"),
        F.concat(F.lit("E"), (F.col("o_custkey") % 5).cast("string")).alias("ethnicity"),
        (F.col("o_orderstatus") == F.lit(DEATH_STATUS)).cast("int").alias("hospital_expire_flag"),
    )


def _line_key_id() -> F.Column:
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in
                             ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def icustays(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("hadm_id"),
        _line_key_id().alias("icustay_id"),
        F.concat(F.col("l_returnflag"), F.col("l_linestatus")).alias("first_careunit"),
        F.col("l_shipdate").alias("intime"),
        F.col("l_quantity").alias("los"),
    )


def diagnoses_icd(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("hadm_id"),
        F.col("l_linenumber").alias("seq_num"),
        F.col("l_partkey").cast("string").alias("icd9_code"),
    )


def d_icd_diagnoses(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part")
    return p.select(
        F.col("p_partkey").cast("string").alias("icd9_code"),
        F.col("p_name").alias("short_title"),
    )


def labevents(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = _read(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_orderkey").alias("hadm_id"),
        F.col("l_shipdate").alias("charttime"),
        F.when(F.col("l_linestatus") == F.lit("O"), F.lit("abnormal")).alias("flag"),
    )


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The driver's event stream as is (user_id, ts, event_id, ...)."""
    return _read(spark, sf_dir, "events")


BUILDERS = {
    "patients": patients,
    "admissions": admissions,
    "icustays": icustays,
    "diagnoses_icd": diagnoses_icd,
    "d_icd_diagnoses": d_icd_diagnoses,
    "labevents": labevents,
}


def standin_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """All six hospital tables as lazy DataFrames over ``sf_dir``."""
    return {name: build(spark, sf_dir) for name, build in BUILDERS.items()}


# Fixed values of the variant with gaps: every so many keys.
GAP_DISCHARGE, GAP_BIRTH, GAP_LAB, GAP_UNIT, GAP_CODE = 97, 89, 7, 5, 3


def gap_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The stand-in tables with gaps, so that NULL-handling branches meet rows.

    * admissions: NULL dischtime where hadm_id % 97 = 0
    * patients: NULL dob where subject_id % 89 = 0
    * labevents: NULL hadm_id where hadm_id % 7 = 0
    * icustays: NULL first_careunit where icustay_id % 5 = 0
    * diagnoses_icd: a code that is not in the dictionary ('X' before it) where seq_num % 3 = 0
    """
    t = standin_tables(spark, sf_dir)
    gap = lambda df, c, key, every: df.withColumn(c, F.when(F.col(key) % every != 0, F.col(c)))
    code = F.when(F.col("seq_num") % GAP_CODE == 0, F.concat(F.lit("X"), "icd9_code")).otherwise(F.col("icd9_code"))
    return {**t, "admissions": gap(t["admissions"], "dischtime", "hadm_id", GAP_DISCHARGE),
            "patients": gap(t["patients"], "dob", "subject_id", GAP_BIRTH),
            "labevents": gap(t["labevents"], "hadm_id", "hadm_id", GAP_LAB),
            "icustays": gap(t["icustays"], "first_careunit", "icustay_id", GAP_UNIT),
            "diagnoses_icd": t["diagnoses_icd"].withColumn("icd9_code", code)}
