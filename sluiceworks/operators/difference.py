"""Where two states of a dataset differ: from one total over bucket totals to the rows, without comparing all rows.

Every row has a 64-bit print of all its values and belongs to the bucket its print says. Equal tables have equal buckets, so
only rows of buckets that differ are compared; what is shuffled is the totals of buckets and those rows.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceworks.operators.audit import union_all
from sluiceworks.operators.keyed import fits_broadcast
from sluiceworks.sources.store import at_rest

BUCKETS = 4096


def _print(df: DataFrame) -> Column:
    # NULLs are hashed by their place, so that they cannot move between columns unseen.
    return F.xxhash64(*[c for name in df.columns for c in (F.col(f"`{name}`"), F.col(f"`{name}`").isNull())])


def bucket_totals(frames: Mapping[str, DataFrame], buckets: int = BUCKETS) -> DataFrame:
    """``dataset, bucket, rows, print_sum`` of every bucket that has rows: one tagged union, one grouped aggregate."""
    tagged = [f.select(F.lit(name).alias("dataset"), _print(f).alias("_print")) for name, f in frames.items()]
    return (
        union_all(tagged)
        .groupBy("dataset", F.pmod("_print", F.lit(buckets)).cast("int").alias("bucket"))
        .agg(F.count("*").alias("rows"), F.sum(F.col("_print").cast("decimal(20,0)")).alias("print_sum"))
    )


def differing_buckets(first: DataFrame, second: DataFrame) -> DataFrame:
    """``dataset, bucket`` of the stored bucket totals that are not the same on both sides."""
    again = second.withColumnsRenamed({"rows": "_rows", "print_sum": "_sum"})
    same = F.col("rows").eqNullSafe(F.col("_rows")) & F.col("print_sum").eqNullSafe(F.col("_sum"))
    return first.join(again, ["dataset", "bucket"], "full").where(~same).select("dataset", "bucket")


def comparison(first: DataFrame, second: DataFrame) -> DataFrame:
    """``dataset, rows, rows_again, identical, buckets_apart`` from the bucket totals of both sides."""
    again = second.withColumnsRenamed({"rows": "_rows", "print_sum": "_sum"})
    same = F.col("rows").eqNullSafe(F.col("_rows")) & F.col("print_sum").eqNullSafe(F.col("_sum"))
    return (
        first.join(again, ["dataset", "bucket"], "full")
        .groupBy("dataset")
        .agg(
            F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_again"),
            (F.count_if(~same) == 0).alias("identical"),
            F.count_if(~same).alias("buckets_apart"),
        )
    )


def differing_rows(first: DataFrame, second: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows that are not equally often on both sides: all columns, ``copies``, ``copies_again``.

    Frames with the same columns; NULL equals NULL. Both are read twice, so they should be at rest.
    """
    totals = [at_rest(bucket_totals({"": f.select(*first.columns)}, buckets), "buckets") for f in (first, second)]
    apart = at_rest(differing_buckets(*totals).select("bucket"), "apart")
    hint = F.broadcast if fits_broadcast(apart) else (lambda frame: frame)

    def rows(frame: DataFrame, side: str) -> DataFrame:
        frame = frame.select(*first.columns)
        within = frame.withColumn("_bucket", F.pmod(_print(frame), F.lit(buckets)).cast("int"))
        hit = within.join(hint(apart), F.col("_bucket") == F.col("bucket"), "left_semi")
        return hit.select(*first.columns, F.lit(side).alias("_side"))

    counted = rows(first, "a").unionByName(rows(second, "b")).groupBy(*first.columns).agg(
        F.count_if(F.col("_side") == "a").alias("copies"), F.count_if(F.col("_side") == "b").alias("copies_again")
    )
    return counted.where("copies <> copies_again")
