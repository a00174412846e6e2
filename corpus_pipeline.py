"""The corpus pipeline: language ID, line dedup, near-dedup, benchmark decontamination, packing.

Each stage works on all rows its predecessor kept and hands on the columns of ``documents``; the last gives
the pieces of the packed sequences. ``run`` stores the result of every stage in the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceworks.llm import decontaminate, language, lines, neardup, packing
from sluiceworks.llm.common import free, store, table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or of no clear language, go; the others stay as they are."""
    return language.accepted(docs)


def _measured(clean: Callable[..., DataFrame], docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` after ``clean``; ``n_chars`` follows the text."""
    counter = free("_n_removed", docs)
    cleaned = clean(docs, counter=counter)
    if "n_chars" in docs.columns:
        length = F.when(F.col(counter) > 0, F.length("text")).otherwise(F.col("n_chars"))
        cleaned = cleaned.withColumn("n_chars", length.cast(docs.schema["n_chars"].dataType))
    return cleaned.select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines on many sites stay in their first document only; ``n_chars`` follows the text."""
    return _measured(lines.dedup, docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 or more on five-word shingles, the one with the smallest id stays.

    Then long lines that several of those left have stay in their first document only; earlier, near-duplicates
    would lose what they are told by.
    """
    left = store(neardup.keep_one(docs, 80), "pipeline-left")
    return _measured(lines.without_passages, left)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents left, as pieces of full token sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# Model scores, similarity joins and packing are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to ``documents``, each on the stored result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
