"""Top-k lists and the full history of the top k. Ties are broken by the key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top(df: DataFrame, k: int, measure: str, *tie_break: str) -> DataFrame:
    """The k rows with the greatest measure."""
    return df.orderBy(F.desc(measure), *tie_break).limit(k)


def leaders(mart: DataFrame, key: str, total: Column, k: int) -> DataFrame:
    """The k keys with the greatest total, one row each."""
    return top(mart.groupBy(key).agg(total.alias("_total")), k, "_total", key).select(key)


def history_of_leaders(mart: DataFrame, key: str, total: Column, k: int) -> DataFrame:
    """Every row of the mart that belongs to one of the k leading keys (k rows are broadcast)."""
    return mart.join(F.broadcast(leaders(mart, key, total, k)), key, "left_semi")


def series_minimum(series: DataFrame, at: str, value: str) -> DataFrame:
    """Where a series is lowest: the first such point."""
    return series.agg(
        F.min(F.struct(F.col(value).alias("value"), F.col(at).alias("at"))).alias("_low")
    ).select(F.col("_low.at").alias(at), F.col("_low.value").alias(value))
