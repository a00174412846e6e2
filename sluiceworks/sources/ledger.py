"""What every landed file brought, kept beside the raw tables and compared with what they hold later."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.contract import Contract
from sluiceworks.operators.audit import union_all
from sluiceworks.sources.raw import MALFORMED, SOURCE_FILE


def file_ledger(raw: Mapping[str, DataFrame], contracts: Mapping[str, Contract]) -> DataFrame:
    """One row per dataset and file: rows, rows that repeat the header, malformed lines, and a sum of row prints.

    One tagged union and one grouped aggregate; rows are told apart by every value under contract.
    """
    tagged = []
    for name, frame in raw.items():
        columns = [c.source for c in contracts[name].columns]
        places = [c for name_ in columns for c in (F.col(f"`{name_}`"), F.col(f"`{name_}`").isNull())]
        malformed = F.col(MALFORMED).isNotNull() if MALFORMED in frame.columns else F.lit(False)
        tagged.append(
            frame.select(
                F.lit(name).alias("dataset"), F.col(SOURCE_FILE).alias("file"),
                (F.col(f"`{columns[0]}`") == columns[0]).alias("_leak"), malformed.alias("_malformed"),
                F.xxhash64(*places).cast("decimal(20,0)").alias("_print"),
            )
        )
    return union_all(tagged).groupBy("dataset", "file").agg(
        F.count("*").alias("rows"),
        F.count_if("_leak").alias("header_leaks"),
        F.count_if("_malformed").alias("malformed_lines"),
        F.sum("_print").alias("print_sum"),
    )


def ledger_check(landed: DataFrame, now: DataFrame) -> DataFrame:
    """Files as they landed against what the raw tables hold of them: ``unchanged``, ``changed``, ``gone`` or ``new``."""
    again = now.select("dataset", "file", F.col("rows").alias("rows_now"), F.col("print_sum").alias("_print_now"))
    same = (F.col("rows") == F.col("rows_now")) & F.col("print_sum").eqNullSafe(F.col("_print_now"))
    state = (
        F.when(F.col("rows_now").isNull(), "gone").when(F.col("rows").isNull(), "new")
        .when(same, "unchanged").otherwise("changed")
    )
    return landed.join(again, ["dataset", "file"], "full").select(
        "dataset", "file", "rows", "rows_now", "header_leaks", "malformed_lines", state.alias("state")
    )
