"""wardlens: clinical cohort analytics written with the Spark DataFrame API.

Every operator takes DataFrames and returns DataFrames. Column names default to
the six hospital tables (patients, admissions, icustays, diagnoses_icd,
d_icd_diagnoses, labevents) declared in :mod:`wardlens.schemas`.
"""

__version__ = "0.1.0"
