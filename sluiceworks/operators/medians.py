"""Exact grouped statistics that hold up when one group has a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluiceworks.operators.keyed import Findings, renamed, same_key, settle
from sluiceworks.sources.store import at_rest

TASK_VALUES = 2_000_000
BUCKETS = 4096


def value_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """``groups…, value, copies``: equal values collapse before the shuffle; NULL is a value."""
    return df.groupBy(*groups, value).agg(F.count("*").alias("copies"))


def exact_median(
    counts: DataFrame,
    groups: list[str],
    value: str,
    task_values: int = TASK_VALUES,
    buckets: int = BUCKETS,
    known: DataFrame | None = None,
) -> DataFrame:
    """``groups…, median`` from value counts: exact, interpolated between the two middle values.

    ``known`` are the ``group_sizes`` if they are stored already.

    A group with more distinct values than one task should hold is first narrowed: a histogram
    shows which of its values can be in the middle, and all others are moved to the edge of that
    range, which leaves the middle where it was. Infinities and NaN (the greatest value) take part by
    rank. Every round drops an end of each wide group's values; one that does not is an error.
    """
    present = counts.where(F.col(value).isNotNull()).select(*groups, value, "copies")
    before = None
    while True:
        measured = known if known is not None else present.groupBy(*groups).agg(*group_sizes(value))
        known = None
        wide = measured.where(F.col("_values") > task_values).select(*groups, "_values", "_low", "_high", "_n")
        sizes = settle(wide, groups, "_values")
        if sizes.rows == 0:
            break
        if before is not None and sizes.total_weight >= before:
            raise RuntimeError(f"the values of {value} cannot be narrowed any further")
        before = sizes.total_weight
        present = at_rest(_narrowed(present, sizes, groups, value, buckets), "narrowed")
    return present.groupBy(*groups).agg(F.percentile(value, F.lit(0.5), F.col("copies")).alias("median"))


def group_sizes(value: str) -> list[Column]:
    """Distinct values, finite range and rows of a group of value counts; NULL does not count."""
    filled = F.col(value).isNotNull()
    return [
        F.count_if(filled).alias("_values"),
        F.min(F.when(_finite(value), F.col(value))).alias("_low"),
        F.max(F.when(_finite(value), F.col(value))).alias("_high"),
        F.sum(F.when(filled, F.col("copies")).otherwise(0)).alias("_n"),
    ]


def _finite(value: str) -> Column:
    """Whether a value is neither infinite nor NaN (which is greater than infinity)."""
    return F.abs(F.col(value).cast("double")) < float("inf")


def _narrowed(present: DataFrame, wide: Findings, groups: list[str], value: str, buckets: int) -> DataFrame:
    # Wide groups are at most (distinct values / task_values) many; their list is broadcast if that is few.
    hint = F.broadcast if wide.small else (lambda frame: frame)
    listed = hint(renamed(wide.frame, groups, "_wide_"))
    # Halves, so that the range of very large values does not overflow.
    spot = (F.col(value).cast("double") / 2 - F.col("_low") / 2) / (F.col("_high") / 2 - F.col("_low") / 2)
    inside = F.greatest(F.least(F.floor(spot * buckets), F.lit(buckets - 1)), F.lit(0))
    bucket = F.when(_finite(value), inside).when(F.col(value) < 0, -1).otherwise(buckets).cast("int")
    histogram = (
        present.join(listed, same_key(groups, "_wide_"))
        .groupBy(*groups, bucket.alias("_bucket"))
        .agg(
            F.sum("copies").alias("_in"),
            F.min(value).alias("_least"),
            F.max(value).alias("_most"),
            F.first("_n").alias("_n"),
        )
    )
    # At most `buckets` rows per group from here on.
    upto = F.sum("_in").over(Window.partitionBy(*groups).orderBy("_bucket"))
    middle = (
        histogram.withColumn("_upto", upto)
        .where(
            (F.col("_upto") >= F.floor((F.col("_n") + 1) / 2))
            & (F.col("_upto") - F.col("_in") < F.ceil((F.col("_n") + 1) / 2))
        )
        .groupBy(*groups)
        .agg(F.min("_least").alias("_from"), F.max("_most").alias("_to"))
    )
    moved = F.least(F.greatest(F.col(value), F.col("_from")), F.col("_to"))
    return (
        present.join(hint(renamed(middle, groups, "_mid_")), same_key(groups, "_mid_"), "left")
        .select(*groups, F.when(F.col("_from").isNull(), F.col(value)).otherwise(moved).alias(value), "copies")
        .groupBy(*groups, value)
        .agg(F.sum("copies").alias("copies"))
    )
