"""One query per operator, over the whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluiceworks.llm import (
    chat,
    compression,
    decontaminate,
    html,
    language,
    lines,
    neardup,
    packing,
    quality,
    ranked,
    secrets,
    spelling,
    toxicity,
)
from sluiceworks.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.report(table(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op4_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.report(table(spark, folder, "documents"))


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents"))


def op6_chat_formatting(spark: SparkSession, folder: str) -> DataFrame:
    return chat.report(table(spark, folder, "conversations"))


def op7_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.matches(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return neardup.cluster(table(spark, folder, "documents"))


def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.report(table(spark, folder, "documents"))


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(table(spark, folder, "pages"))


def op11_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return compression.score(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(table(spark, folder, "documents"))


def op13_ranked_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_best_fit_packing,
        op2_quality_rules,
        op3_toxicity,
        op4_secret_scans,
        op5_language_id,
        op6_chat_formatting,
        op7_benchmark_decontamination,
        op8_minhash_near_dedup,
        op9_line_dedup,
        op10_html_extraction,
        op11_quality_classifier,
        op12_spelling_variants,
        op13_ranked_search,
    )
}
ORACLES: dict[str, str] = {"op9_line_dedup": lines.SQL, "op13_ranked_search": ranked.SQL}
