"""Audits. Each one is a DataFrame with a verdict column; only verdicts are ever collected."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluiceworks.operators.gate import dealt_out
from sluiceworks.operators.keyed import LIMITS, Limits
from sluiceworks.sources.raw import MALFORMED

LAYERS = ("bronze", "silver", "quarantine")


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def row_accounting(layers: Mapping[str, tuple[DataFrame, DataFrame, DataFrame]]) -> DataFrame:
    """Rows per dataset and layer; ``closes`` when raw = trusted + quarantined.

    One tagged union and one aggregate: no column is read, nothing is cross-joined.
    """
    tagged = [
        frame.select(F.lit(dataset).alias("dataset"), F.lit(layer).alias("layer"))
        for dataset, frames in layers.items()
        for layer, frame in zip(LAYERS, frames, strict=True)
    ]
    counted = (
        union_all(tagged)
        .groupBy("dataset")
        .agg(*[F.count_if(F.col("layer") == layer).alias(layer) for layer in LAYERS])
    )
    # A dataset without any row in any layer still gets its line.
    names = counted.sparkSession.createDataFrame([(d,) for d in layers], "dataset string")
    return (
        names.join(counted, "dataset", "left")
        .fillna(0, list(LAYERS))
        .withColumn("closes", F.col("bronze") == F.col("silver") + F.col("quarantine"))
    )


def with_prediction(accounting: DataFrame, predicted: DataFrame) -> DataFrame:
    """Adds ``predicted`` and ``as_predicted``; a dataset without a prediction is not as predicted."""
    return accounting.join(predicted.select("dataset", "predicted"), "dataset", "left").withColumn(
        "as_predicted", F.coalesce(F.col("quarantine") == F.col("predicted"), F.lit(False))
    )


def observed_counts(raw: Mapping[str, DataFrame]) -> DataFrame:
    """``(dataset, actual_rows, header_leaks, malformed_lines)``: a leak is a row that repeats its column's name."""
    tagged = []
    for dataset, frame in raw.items():
        first = frame.columns[0]
        tagged.append(
            frame.select(
                F.lit(dataset).alias("dataset"),
                (F.col(first) == first).alias("leak"),
                (F.col(MALFORMED).isNotNull() if MALFORMED in frame.columns else F.lit(False)).alias("malformed"),
            )
        )
    return (
        union_all(tagged)
        .groupBy("dataset")
        .agg(
            F.count("*").alias("actual_rows"),
            F.count_if("leak").alias("header_leaks"),
            F.count_if("malformed").alias("malformed_lines"),
        )
    )


def completeness(counts: DataFrame, manifest: DataFrame) -> DataFrame:
    """Manifest against observation: every expected dataset has one line, present or not."""
    return (
        manifest.join(counts, "dataset", "left")
        .fillna(0, ["actual_rows", "header_leaks", "malformed_lines"])
        .withColumn("rows_ok", F.col("actual_rows") == F.col("expected_rows"))
        .withColumn("header_ok", F.col("header_leaks") == 0)
        .withColumn("lines_ok", F.col("malformed_lines") == 0)
    )


def totals(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    """``(check_name, actual)``: global aggregates turned into one row per measure."""
    names = list(measures)
    row = df.agg(*[measures[n].cast("double").alias(f"m{i}") for i, n in enumerate(names)])
    pairs = F.array(
        *[F.struct(F.lit(n).alias("check_name"), F.col(f"m{i}").alias("actual")) for i, n in enumerate(names)]
    )
    return row.select(F.inline(pairs))


def reconcile(actual: DataFrame, expected: DataFrame) -> DataFrame:
    """``expected`` is ``(check_name, expected, tolerance)``; a total that is missing is not ok."""
    gap = F.abs(F.col("expected") - F.col("actual"))
    return expected.join(actual, "check_name", "left").withColumn(
        "ok", F.coalesce(gap <= F.col("tolerance"), F.lit(False))
    )


def mart_audit(marts: Mapping[str, tuple[DataFrame, str]], expected: DataFrame) -> DataFrame:
    """Rows and one key sum per mart (name -> (frame, column)) against ``mart, rows_expected, key_sum_expected``.

    All marts are one tagged union and one grouped aggregate; an empty mart has 0 rows and is never ok.
    """
    tagged = [
        frame.select(F.lit(name).alias("mart"), F.col(column).cast("bigint").alias("value"))
        for name, (frame, column) in marts.items()
    ]
    counted = union_all(tagged).groupBy("mart").agg(F.count("*").alias("rows"), F.sum("value").alias("key_sum"))
    same = (F.col("rows") == F.col("rows_expected")) & (F.col("key_sum") == F.col("key_sum_expected"))
    return (
        expected.join(counted, "mart", "left")
        .fillna(0, ["rows"])
        .select("mart", "rows", "rows_expected", "key_sum", "key_sum_expected", F.coalesce(same, F.lit(False)).alias("ok"))
    )


def key_uniqueness(df: DataFrame, key: list[str], dataset: str, limits: Limits = LIMITS) -> DataFrame:
    """Rows against distinct keys, from one count per key."""
    return (
        dealt_out(df.select(*key), key, limits)
        .groupBy(*key)
        .agg(F.count("*").alias("_copies"))
        .agg(
            F.coalesce(F.sum("_copies"), F.lit(0)).alias("rows"),
            F.count("*").alias("distinct_keys"),
        )
        .select(
            F.lit(dataset).alias("dataset"),
            "rows",
            "distinct_keys",
            (F.col("rows") == F.col("distinct_keys")).alias("is_unique"),
        )
    )


def fingerprint(df: DataFrame, dataset: str) -> DataFrame:
    """Row count and an order-independent sum of row hashes."""
    return df.select(F.xxhash64(*df.columns).cast("decimal(20,0)").alias("_hash")).agg(
        F.count("*").alias("rows"), F.coalesce(F.sum("_hash"), F.lit(0)).alias("hash_sum")
    ).select(F.lit(dataset).alias("dataset"), "rows", "hash_sum")


def reproducible(first: DataFrame, second: DataFrame) -> DataFrame:
    """Fingerprints of two builds side by side."""
    again = second.withColumnsRenamed({"rows": "rows_again", "hash_sum": "hash_again"})
    same = (F.col("rows") == F.col("rows_again")) & F.col("hash_sum").eqNullSafe(F.col("hash_again"))
    return first.join(again, "dataset", "left").select(
        "dataset", "rows", "rows_again", F.coalesce(same, F.lit(False)).alias("identical")
    )


def expectation_metrics(df: DataFrame, expectations: Mapping[str, str], dataset: str) -> DataFrame:
    """Rows passing and failing each named predicate; NULL fails."""
    names = list(expectations)
    row = df.agg(
        F.count("*").alias("n"),
        *[F.count_if(F.expr(expectations[e])).alias(f"p{i}") for i, e in enumerate(names)],
    )
    lines = F.array(
        *[
            F.struct(
                F.lit(e).alias("expectation"),
                F.col(f"p{i}").alias("passed"),
                (F.col("n") - F.col(f"p{i}")).alias("failed"),
            )
            for i, e in enumerate(names)
        ]
    )
    return row.select(F.lit(dataset).alias("dataset"), F.inline(lines))


def expect_all_or_drop(df: DataFrame, expectations: Mapping[str, str]) -> tuple[DataFrame, Observation]:
    """Keeps rows that satisfy all predicates; the observation counts passes once an action ran."""
    seen = Observation()
    watched = df.observe(
        seen,
        F.count("*").alias("rows"),
        *[F.count_if(F.expr(p)).alias(name) for name, p in expectations.items()],
    )
    keep = reduce(lambda a, b: a & b, [F.expr(p) for p in expectations.values()])
    return watched.where(keep), seen


def require(audit: DataFrame, verdict: str, what: str) -> None:
    """Raises unless the verdict (SQL) is true on every line; there must be at least one."""
    row = audit.agg(F.count("*").alias("n"), F.count_if(F.expr(verdict)).alias("ok")).first()
    if row.n == 0 or row.ok != row.n:
        raise AssertionError(f"{what}: {row.ok} of {row.n} checks passed")


def expectations_frame(spark: SparkSession, expected: list[tuple[str, float, float]]) -> DataFrame:
    """``(check_name, expected, tolerance)``: tolerance 0 means exact."""
    lines = [(name, float(value), float(margin)) for name, value, margin in expected]
    return spark.createDataFrame(lines, "check_name string, expected double, tolerance double")
