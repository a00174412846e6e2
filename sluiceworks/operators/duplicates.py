"""Duplicates of the natural key: identical copies keep one row, conflicting copies keep none."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluiceworks.contract import Contract
from sluiceworks.operators.checks import FOUND, typed, with_key_values, with_row_findings
from sluiceworks.operators.keyed import LIMITS, Findings, Limits, attach, settle
from sluiceworks.sources.raw import MALFORMED, ROW_ID, well_formed


VERDICT_BYTES = 16
KEEPER_BYTES = 512


def repeated_keys(raw: DataFrame, contract: Contract, limits: Limits = LIMITS) -> Findings:
    """Keys on more than one row, with their number of copies. Only the key columns are read, and
    counting starts before the shuffle. Malformed lines are nobody's copies."""
    counted = typed(well_formed(raw), contract).groupBy(*contract.key).agg(F.count("*").alias("_copies"))
    return settle(counted.where("_copies > 1"), list(contract.key), "_copies", limits)


def key_verdicts(suspects: DataFrame, contract: Contract, limits: Limits = LIMITS) -> DataFrame:
    """Per repeated key: are all copies the same values, and which row is the one to keep."""
    return counted_verdicts(suspects, contract, limits)[0]


def counted_verdicts(suspects: DataFrame, contract: Contract, limits: Limits = LIMITS) -> tuple[DataFrame, int]:
    """The same, and how many of the keys may have a row to keep.

    The smallest and the greatest hash of the values tell most conflicts, with three numbers of state per key. Only
    keys whose copies have one hash are looked at again, value by value.
    """
    key = list(contract.key)
    prints = suspects.select(*key, F.xxhash64(*contract.names).alias("_print")).groupBy(*key).agg(
        F.count("*").alias("_copies"), F.min("_print").alias("_first"), F.max("_print").alias("_last")
    )
    sizes = settle(prints.select(*key, "_copies", (F.col("_first") == F.col("_last")).alias("_equal")), key, "_copies", limits)
    equal = sizes.frame.where("_equal")
    keeper = suspects.schema[ROW_ID].dataType
    told = sizes.frame.where("NOT _equal").select(
        *key, "_copies", F.lit(False).alias("_alike"), F.lit(None).cast(keeper).alias("_keeper")
    )
    keepers = equal.count()
    if keepers == 0:
        return told, 0
    # A part of the keys measured above, so their size bounds it.
    again = attach(suspects.drop("_copies"), equal.select(*key, "_copies"), sizes)
    again = again.where(F.col("_copies").isNotNull()).drop("_copies")
    return told.unionByName(exact_verdicts(again, contract)), keepers


def exact_verdicts(suspects: DataFrame, contract: Contract) -> DataFrame:
    """The same, value by value: the smallest and the greatest copy are equal only if all are.

    That needs two rows of state per key, however many copies there are. The row with the fewest reasons is kept, then
    the first.
    """
    values, rank = F.struct(*contract.names), _rank()
    return (
        suspects.groupBy(*contract.key)
        .agg(
            F.count("*").alias("_copies"),
            F.min(values).alias("_least"),
            F.max(values).alias("_most"),
            F.min(rank).alias("_best"),
        )
        .select(
            *contract.key,
            "_copies",
            F.col("_least").eqNullSafe(F.col("_most")).alias("_alike"),
            F.col("_best.row").alias("_keeper"),
        )
    )


def _rank() -> Column:
    reasons = F.when(F.col(FOUND) == "", 0).otherwise(F.size(F.split(FOUND, ",")))
    return F.struct(reasons.alias("reasons"), F.col(ROW_ID).alias("row"))


def suspect_rows(raw: DataFrame, contract: Contract, sizes: Findings) -> DataFrame:
    """The rows of repeated keys, typed and checked. Only their keys are cast before they are found."""
    prefix = "_key_"
    hits = sizes.prefixed(prefix)
    found = attach(with_key_values(well_formed(raw), contract, prefix), hits.frame, hits)
    return with_row_findings(typed(found.where(F.col("_copies").isNotNull()), contract), contract)


def with_duplicate_findings(
    rows: DataFrame, contract: Contract, raw: DataFrame, repeated: Findings
) -> tuple[DataFrame, list]:
    """Adds the verdict columns and returns the ``exact_duplicate`` / ``key_conflict`` expressions.

    Verdicts come from the raw rows, without references: equal values point to equal parents, so
    references cannot change which copy is best.
    """
    if repeated.rows == 0:
        return rows, []
    verdicts, keepers = counted_verdicts(suspect_rows(raw, contract, repeated), contract, repeated.limits)
    # A verdict on copies that are alike names the row to keep by file and place; conflicts have none.
    payload = VERDICT_BYTES + KEEPER_BYTES * keepers / repeated.rows
    return attach(rows, verdicts, repeated, payload), _reasons()


def verdicts_are_small(repeated: Findings) -> bool:
    """Whether verdicts on these keys can be broadcast, even if every one names a row to keep."""
    most = repeated.key_bytes + (VERDICT_BYTES + KEEPER_BYTES) * repeated.rows
    return repeated.small and most <= repeated.limits.broadcast_bytes


def with_findings_in_place(rows: DataFrame, contract: Contract) -> tuple[DataFrame, list]:
    """The same for checked rows that lie together by key, none of which has more rows than a task should hold.

    Copies are compared value by value where they are, so no verdict has to be carried back.
    """
    good = F.col(MALFORMED).isNull() if MALFORMED in rows.columns else F.lit(True)
    over = Window.partitionBy(*contract.key)
    values = F.when(good, F.struct(*contract.names))
    told = rows.select(
        "*",
        F.count(F.when(good, 1)).over(over).alias("_copies"),
        F.min(values).over(over).alias("_least"),
        F.max(values).over(over).alias("_most"),
        F.min(F.when(good, _rank())).over(over).alias("_best"),
    )
    alike, keeper = F.col("_least").eqNullSafe(F.col("_most")).alias("_alike"), F.col("_best.row").alias("_keeper")
    return told.select(*[f"`{c}`" for c in rows.columns], "_copies", alike, keeper), _reasons()


def _reasons() -> list[Column]:
    several = F.col("_copies") > 1
    return [
        F.when(several & F.col("_alike") & (F.col(ROW_ID) != F.col("_keeper")), "exact_duplicate"),
        F.when(several & ~F.col("_alike"), "key_conflict"),
    ]
