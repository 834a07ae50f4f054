"""Corpus pipeline: quality rules, line dedup, near-duplicate removal, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's docs. All but the last
return the columns of documents. Rows, columns and repeats are handled as the
operators say; an empty table passes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wardlens.llm.common import drop_folder, shared_folder
from wardlens.llm.decontamination import contaminated_filter
from wardlens.llm.line_templates import drop_recurring_lines
from wardlens.llm.minhash import keep_one_of_each
from wardlens.llm.packing import pack_documents
from wardlens.llm.quality import quality_filter
from wardlens.llm.queries import WORD_BPE
from wardlens.session import intermediates


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules (operator 9)."""
    return quality_filter(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines (operator 6); n_chars follows the text."""
    return drop_recurring_lines(docs, chars_col="n_chars")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-equal documents (operator 10)."""
    return keep_one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window (operator 7)."""
    return contaminated_filter(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens (operator 2)."""
    import public_tokenizers

    return pack_documents(docs, public_tokenizers.path(WORD_BPE), capacity=2048, end_id=0)


STAGES = [("quality_rules", quality), ("line_dedup", lines), ("minhash_near_dedup", near),
          ("benchmark_decontamination", decontaminate), ("best_fit_packing", pack)]

# Tokenizing, near-duplicate classes and packing cannot be stated in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``; returns the packed pieces.

    Of what the stages write, only the last one's output stays.
    """
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = shared_folder(spark, f"pipeline-{name}")
        with intermediates(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before is not None:
            drop_folder(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
