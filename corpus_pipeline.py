"""A corpus pipeline of the training-text operators.

Quality rules drop documents, line dedup cuts repeated lines (and drops documents that lose all
their words), SimHash near-dedup keeps one document of each group, decontamination drops
documents that hold benchmark passages, and mixing chooses how often each document is read. Each stage
gets what its predecessor kept, written as Parquet to the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from meterflow.llm import decontaminate, lines, mixing, quality, simhash
from meterflow.llm.queries import MIX, domain
from meterflow.llm.shared import staged, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the learned list keep."""
    return quality.accept(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that stay elsewhere; ``n_chars`` follows the text.

    Documents that had words and lose all of them go.
    """
    cut = lines.dedup(docs).where(
        (F.col("n_removed") == 0) | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
    return cut.withColumn("n_chars", F.when(
        F.col("n_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars"))).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8."""
    return simhash.keep_one(docs, shingle=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How often and how far each document is read to meet the target weights."""
    return mixing.select_mix(docs, domain(), MIX)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
]

# The learned rules and the fingerprints have no SQL form; tests hold run() against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), name)
    return docs
