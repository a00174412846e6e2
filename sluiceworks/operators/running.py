"""Running sums over ordered ranges: a group with a third of all rows is many tasks' work, not one's."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sluiceworks.operators.keyed import fits_broadcast, same_key, renamed
from sluiceworks.sources.store import at_rest

RANGES = 200


def running_sums(df: DataFrame, groups: list[str], order: list[str], sums: Mapping[str, Column], ranges: int = RANGES) -> DataFrame:
    """``df`` with, per name of ``sums``, the sum of that column from the group's first row to this one.

    Rows are dealt into ``ranges`` ranges of the groups in order, whatever group they belong to; each range
    is summed up by itself, and what lies before it in its group is added. ``order`` must tell the rows of a group apart,
    as equal ones stay together. The sums should be decimals, so that they do not depend on how rows are dealt.
    """
    values = {name: f"_value_{i}" for i, name in enumerate(sums)}
    # Stored, as the bounds of the ranges are sampled: no row may change its range.
    dealt = at_rest(
        df.withColumns({v: sums[name] for name, v in values.items()})
        .repartitionByRange(ranges, *groups, *order)
        .withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    # A group has one row here per range it reaches into.
    parts = dealt.groupBy(*groups, "_range").agg(*[F.sum(v).alias(v) for v in values.values()])
    earlier = Window.partitionBy(*groups).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    before = parts.select(*groups, "_range", *[F.sum(v).over(earlier).alias(f"_before{v}") for v in values.values()])
    # Only groups that begin in an earlier range have anything to add: fewer than there are ranges.
    before = at_rest(before.where(F.coalesce(*[F.col(f"_before{v}") for v in values.values()]).isNotNull()), "offsets")
    offsets = renamed(before, [*groups, "_range"], "_of_")
    if fits_broadcast(offsets):
        offsets = F.broadcast(offsets)
    upto = Window.partitionBy(*groups, "_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = dealt.withColumns({name: F.sum(v).over(upto) for name, v in values.items()})
    joined = local.join(offsets, same_key([*groups, "_range"], "_of_"), "left")
    whole = {name: F.when(F.col(f"_before{v}").isNull(), F.col(name)).otherwise(F.coalesce(name, F.lit(0)) + F.col(f"_before{v}")) for name, v in values.items()}
    return joined.withColumns(whole).select(*df.columns, *values)
