"""Joins of facts with dimensions, and the proof that they neither lose nor multiply rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.operators.census import heaviest_bucket
from sluiceworks.operators.gate import dealt_out_if_many, in_parts
from sluiceworks.operators.keyed import LIMITS, Limits, fits_broadcast, merged, settle, spread_join


def lookup(
    fact: DataFrame,
    dimension: DataFrame,
    key: str,
    identity: list[str],
    how: str = "inner",
    limits: Limits = LIMITS,
) -> DataFrame:
    """Equi-join of a fact with a dimension that has one row per ``key``, on the shared name.

    A dimension measured to be small is broadcast. Otherwise hash buckets bound the rows of any one key, and the fact is
    dealt out in parts small enough to be sorted. Only a bucket heavier than a task's share makes keys be counted
    one by one; the heavy ones among them are spread. ``identity`` names fact columns that tell rows apart.
    """
    if fits_broadcast(dimension, limits):
        return fact.join(F.broadcast(dimension), key, how)
    total, most = heaviest_bucket(fact.select(key), [key])
    if most <= limits.task_rows:
        return in_parts(fact, total, [key]).join(merged(dimension), key, how)
    heavy = fact.groupBy(key).agg(F.count("*").alias("_uses")).where(F.col("_uses") > limits.task_rows)
    sizes = settle(heavy, [key], "_uses", limits)
    if sizes.rows == 0:
        return fact.join(merged(dimension), key, how)
    over = sizes.frame.where(F.col("_uses") > sizes.rows_per_task)
    return spread_join(fact, dimension, over, sizes, identity, how)


def beside(rows: DataFrame, dimension: DataFrame, key: str, limits: Limits = LIMITS) -> DataFrame:
    """Inner join with a dimension that has one row per ``key``, where no key has many of the ``rows``.

    A dimension measured to be small is broadcast, any other one is merged.
    """
    hint = F.broadcast if fits_broadcast(dimension, limits) else merged
    return rows.join(hint(dimension), key)


def join_audit(fact: DataFrame, dimension: DataFrame, key: str, dimension_key: str, name: str) -> DataFrame:
    """What an inner join would do, without running it on the wide rows.

    ``lost`` are fact rows without a parent, ``joined`` the rows the join would return. Keys too many for a task are
    dealt out before they are counted.
    """
    keys, others = fact.select(F.col(key).alias("_key")), dimension.select(F.col(dimension_key).alias("_parent"))
    used = dealt_out_if_many(keys, ["_key"]).groupBy("_key").agg(F.count("*").alias("_uses"))
    parents = dealt_out_if_many(others, ["_parent"]).groupBy("_parent").agg(F.count("*").alias("_rows"))
    matched = F.coalesce("_rows", F.lit(0))
    return (
        used.join(parents, F.col("_key") == F.col("_parent"), "left")
        .agg(
            F.coalesce(F.sum("_uses"), F.lit(0)).alias("fact_rows"),
            F.coalesce(F.sum(F.col("_uses") * matched), F.lit(0)).alias("joined_rows"),
            F.coalesce(F.sum(F.when(matched == 0, F.col("_uses"))), F.lit(0)).alias("lost_rows"),
            F.coalesce(F.sum(F.when(matched > 1, F.col("_uses") * (matched - 1))), F.lit(0)).alias(
                "added_rows"
            ),
        )
        .select(
            F.lit(name).alias("join_name"),
            "*",
            ((F.col("lost_rows") == 0) & (F.col("added_rows") == 0)).alias("lossless"),
        )
    )
