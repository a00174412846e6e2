"""What a table holds of its keys and of the values it refers with, counted in one scan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.contract import Contract
from sluiceworks.operators.checks import typed
from sluiceworks.operators.duplicates import repeated_keys
from sluiceworks.operators.keyed import LIMITS, Findings, Limits, settle
from sluiceworks.session import checkpoint_folder
from sluiceworks.sources.raw import MALFORMED

BUCKETS = 16_384


def census(
    raw: DataFrame, contract: Contract, references: Sequence[str], limits: Limits = LIMITS, keys: bool = True
) -> tuple[Findings | None, dict[str, DataFrame]]:
    """Repeated keys, and per referring column its values with their number of rows (``_uses``).

    Grouping sets count all of them in one pass over the few columns they need, starting before the shuffle. Malformed
    lines have values but no key.
    """
    if not references:
        return (repeated_keys(raw, contract, limits) if keys else None), {}
    checkpoint_folder(raw.sparkSession)
    # Referring values under names of their own: a column can be part of the key as well.
    values = {c: f"_used_{c}" for c in references}
    good = F.col(MALFORMED).isNull() if MALFORMED in raw.columns else F.lit(True)
    rows = typed(raw, contract).select(*contract.key, good.alias("_good"), *[F.col(c).alias(v) for c, v in values.items()])
    sets = [[F.col(v)] for v in values.values()]
    if keys:
        sets.append([F.col(k) for k in (*contract.key, "_good")])
    columns = [*(contract.key if keys else ()), *(["_good"] if keys else []), *values.values()]
    counted = rows.groupingSets(sets, *columns).agg(F.count("*").alias("_n"), *[F.grouping(c).alias(f"_out_{c}") for c in columns])
    if keys:
        # Keys on one row only are of no further interest, and they are as many as the rows.
        counted = counted.where((F.col("_out__good") == 1) | ((F.col("_n") > 1) & F.col("_good")))
    counted = counted.checkpoint()
    used = {
        c: counted.where(F.col(f"_out_{v}") == 0).select(F.col(v).alias(c), F.col("_n").alias("_uses")) for c, v in values.items()
    }
    if not keys:
        return None, used
    repeated = counted.where(F.col("_out__good") == 0).select(*contract.key, F.col("_n").alias("_copies"))
    return settle(repeated, list(contract.key), "_copies", limits), used


def weighed(
    raw: DataFrame, contract: Contract, column: str, references: Sequence[str]
) -> tuple[int, int, dict[str, DataFrame]]:
    """Rows in all, the most that one value of ``column`` can have, and the values of the other columns as ``census`` has them.

    Values of ``column`` are counted by hash buckets, a few thousand numbers a task: a bucket has no fewer rows than any of
    its values.
    """
    checkpoint_folder(raw.sparkSession)
    values = {c: f"_used_{c}" for c in references}
    bucket = F.pmod(F.xxhash64(column), F.lit(BUCKETS)).cast("int").alias("_bucket")
    rows = typed(raw, contract).select(bucket, *[F.col(c).alias(v) for c, v in values.items()])
    columns = ["_bucket", *values.values()]
    counted = rows.groupingSets([[F.col(c)] for c in columns], *columns).agg(
        F.count("*").alias("_n"), *[F.grouping(c).alias(f"_out_{c}") for c in columns]
    )
    counted = counted.checkpoint()
    size = counted.where("_out__bucket = 0").agg(F.sum("_n").alias("rows"), F.max("_n").alias("most")).first()
    used = {
        c: counted.where(F.col(f"_out_{v}") == 0).select(F.col(v).alias(c), F.col("_n").alias("_uses")) for c, v in values.items()
    }
    return size.rows or 0, size.most or 0, used


def heaviest_bucket(rows: DataFrame, by: Sequence[str]) -> tuple[int, int]:
    """Rows in all, and the most that one value of ``by`` can have: those of its hash bucket."""
    counted = rows.groupBy(F.pmod(F.xxhash64(*by), F.lit(BUCKETS)).alias("_bucket")).agg(F.count("*").alias("_n"))
    size = counted.agg(F.sum("_n").alias("rows"), F.max("_n").alias("most")).first()
    return size.rows or 0, size.most or 0
