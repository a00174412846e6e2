"""Expectations of a dataset: named predicates with what happens to rows that miss them.

``warn`` keeps such rows, ``drop`` leaves them out, ``fail`` refuses the whole write. All are counted by the very write
that stores the rows, before any row is dropped; a predicate that is NULL is missed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

ACTIONS = ("warn", "drop", "fail")
METRICS = "dataset string, expectation string, action string, passed bigint, failed bigint"


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"{self.name}: {self.action!r} is none of {', '.join(ACTIONS)}")

    @property
    def met(self) -> Column:
        return F.coalesce(F.expr(self.predicate).cast("boolean"), F.lit(False))


class ExpectationFailedError(RuntimeError):
    """Rows missed an expectation that fails the write; nothing was replaced."""


class Watch:
    """Rows on their way into a write, and what that write counted."""

    def __init__(self, rows: DataFrame, expected: Sequence[Expectation]):
        self.expected, self._seen = tuple(expected), Observation()
        counts = [F.count_if(e.met).alias(f"e{i}") for i, e in enumerate(self.expected)]
        watched = rows.observe(self._seen, F.count("*").alias("rows"), *counts)
        dropping = [e.met for e in self.expected if e.action == "drop"]
        self.rows = watched.where(reduce(lambda a, b: a & b, dropping)) if dropping else watched

    def metrics(self) -> list[dict]:
        """One entry per expectation; the write must have run."""
        seen = self._seen.get
        passed = [seen[f"e{i}"] for i in range(len(self.expected))]
        return [
            {"expectation": e.name, "action": e.action, "passed": n, "failed": seen["rows"] - n}
            for e, n in zip(self.expected, passed, strict=True)
        ]


def require_met(what: str, metrics: Sequence[dict]) -> None:
    missed = [f"{m['expectation']} ({m['failed']} rows)" for m in metrics if m["action"] == "fail" and m["failed"]]
    if missed:
        raise ExpectationFailedError(f"{what}: {', '.join(missed)}")


def metrics_frame(spark: SparkSession, found: dict[str, Sequence[dict]]) -> DataFrame:
    """``dataset, expectation, action, passed, failed`` of the metrics per dataset."""
    lines = [(d, m["expectation"], m["action"], m["passed"], m["failed"]) for d, each in found.items() for m in each]
    return spark.createDataFrame(lines, METRICS)
