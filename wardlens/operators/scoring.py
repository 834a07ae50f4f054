"""Scoring admissions with a saved model.

Works on any number of rows, batch or streaming: it only adds columns and
calls ``transform``. A numeric feature absent from the input becomes 0, an
absent categorical becomes NULL, which the encoder turns into all-zero
indicators, as for an unseen level.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlens.schemas import FEATURE_COLS_CATEGORICAL, FEATURE_COLS_NUMERIC


def complete_inputs(df: DataFrame, numeric=FEATURE_COLS_NUMERIC,
                    categorical=FEATURE_COLS_CATEGORICAL) -> DataFrame:
    """Add missing feature columns as literals (0.0 for numbers, NULL for categories)."""
    out = df
    for c in numeric:
        out = (out.withColumn(c, F.col(c).cast("double")) if c in out.columns
               else out.withColumn(c, F.lit(0.0)))
    for c in categorical:
        if c not in out.columns:
            out = out.withColumn(c, F.lit(None).cast("string"))
    return out


def score_admissions(model: PipelineModel, admissions: DataFrame, keep=("subject_id", "hadm_id"),
                     out_col: str = "risk") -> DataFrame:
    """Probability of the positive class per row, with the ``keep`` columns that exist."""
    scored = model.transform(complete_inputs(admissions))
    ids = [c for c in keep if c in admissions.columns]
    return scored.select(*ids, vector_to_array("probability")[1].alias(out_col))
