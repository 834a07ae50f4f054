"""Scoring admissions as they arrive, with Structured Streaming.

The scoring operator only adds columns and calls ``transform``, so the same
saved model scores a stream. New files in ``source_dir`` are read with a
declared schema, scored, and appended to ``sink_dir``; progress is kept in
``checkpoint_dir`` so a restarted query resumes where it stopped.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardlens.operators.scoring import score_admissions
from wardlens.sources.models import load_model

ADMISSION_FEATURES = T.StructType([
    T.StructField("subject_id", T.LongType()),
    T.StructField("hadm_id", T.LongType()),
    T.StructField("age_years", T.DoubleType()),
    T.StructField("n_lab_results_24h", T.LongType()),
    T.StructField("pct_abnormal_labs_24h", T.DoubleType()),
    T.StructField("gender", T.StringType()),
    T.StructField("admission_type", T.StringType()),
    T.StructField("first_icu_careunit", T.StringType()),
])


def start_scoring_stream(spark: SparkSession, model_path: str, source_dir: str, sink_dir: str,
                         checkpoint_dir: str, *, schema: T.StructType = ADMISSION_FEATURES,
                         fmt: str = "parquet", available_now: bool = False,
                         max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream: ``source_dir`` files -> risk per admission -> ``sink_dir`` (append)."""
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    scored = score_admissions(load_model(model_path), reader.load(source_dir))
    writer = (scored.writeStream.format("parquet").outputMode("append")
              .option("path", sink_dir).option("checkpointLocation", checkpoint_dir))
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
