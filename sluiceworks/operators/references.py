"""References: every non-NULL value must exist among the parent's trusted rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceworks.contract import Contract, Reference
from sluiceworks.operators.keyed import LIMITS, Limits, attach, fits_broadcast, merged, settle


@dataclass(frozen=True)
class Parent:
    """Trusted rows that children are checked against; ``rows`` when already counted."""

    frame: DataFrame
    key: tuple[str, ...]
    rows: int | None = None

    def values(self, column: str) -> DataFrame:
        """Distinct values of one column (already distinct when it is the whole key)."""
        values = self.frame.select(column)
        return values if self.key == (column,) else values.distinct()

    def fits_broadcast(self, column: str, limits: Limits) -> bool:
        """Whether the column's values are few and short enough; measured unless plainly so."""
        if self.rows is not None and self.rows > limits.broadcast_rows:
            return False
        of_fixed_size = not isinstance(self.frame.schema[column].dataType, T.StringType | T.BinaryType)
        if self.rows is not None and of_fixed_size:
            return True
        return fits_broadcast(self.frame.select(column), limits)


def _flag(column: str) -> str:
    return f"_orphan_{column}"


def _by_parent_values(rows: DataFrame, ref: Reference, parent: Parent, hint: Callable = F.broadcast) -> DataFrame:
    """Existence join: the parent's key values, broadcast if they are few enough, are probed in place."""
    known = parent.values(ref.parent_column).select(
        F.col(ref.parent_column).alias("_known"), F.lit(True).alias("_exists")
    )
    orphan = F.col(ref.column).isNotNull() & F.col("_exists").isNull()
    return (
        rows.join(hint(known), F.col(ref.column) == F.col("_known"), "left")
        .withColumn(_flag(ref.column), orphan)
        .drop("_known", "_exists")
    )


def _by_used_values(rows: DataFrame, used: DataFrame, ref: Reference, parent: Parent, limits: Limits) -> DataFrame:
    """The values in use, counted before (a hot value has shrunk to one row), are compared with the parent key by key,
    and only the orphans are carried back to the rows."""
    known = parent.values(ref.parent_column).select(
        F.col(ref.parent_column).alias("_known"), F.lit(True).alias("_exists")
    )
    report = (
        used.join(merged(known), F.col(ref.column) == F.col("_known"), "left")
        .withColumn(_flag(ref.column), F.col(ref.column).isNotNull() & F.col("_exists").isNull())
        # Valid heavy values stay in the report: the join back has to know them.
        .where(F.col(_flag(ref.column)) | (F.col("_uses") > limits.task_rows))
        .select(ref.column, "_uses", _flag(ref.column))
    )
    sizes = settle(report, [ref.column], "_uses", limits)
    marked = attach(rows, sizes.frame, sizes).drop("_uses")
    return marked.withColumn(_flag(ref.column), F.coalesce(_flag(ref.column), F.lit(False)))


def large_references(contract: Contract, parents: dict[str, Parent], limits: Limits = LIMITS) -> list[str]:
    """Columns whose parent is too large to be broadcast."""
    return [r.column for r in contract.references if not parents[r.parent].fits_broadcast(r.parent_column, limits)]


def with_reference_findings(
    rows: DataFrame, contract: Contract, parents: dict[str, Parent], used: dict[str, DataFrame], limits: Limits = LIMITS,
    together: str | None = None,
) -> tuple[DataFrame, list]:
    """Adds one flag per reference and returns the matching ``orphan_`` expressions, in order.

    ``used`` has the counted values (``_uses``) of the columns with a large parent. The rows lie together by the column
    ``together``: what it refers to comes to them, before they move on.
    """
    for ref in sorted(contract.references, key=lambda r: r.column != together):
        parent = parents[ref.parent]
        if ref.column == together:
            rows = _by_parent_values(rows, ref, parent, merged)
        elif ref.column in used:
            rows = _by_used_values(rows, used[ref.column], ref, parent, limits)
        else:
            rows = _by_parent_values(rows, ref, parent)
    return rows, [F.when(F.col(_flag(r.column)), f"orphan_{r.column}") for r in contract.references]
