"""Column expressions shared by the gate and the marts. All are Spark built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: how the landing files spell NULL.
NULL_MARKER = "\\N"


def full_name(*parts: str) -> Column:
    """Parts joined by one blank; NULL parts are skipped."""
    return F.concat_ws(" ", *parts)


def count_where(predicate: Column) -> Column:
    """Rows for which the predicate is TRUE (NULL does not count)."""
    return F.count_if(predicate)


def money(column: str | Column) -> Column:
    """Two exact decimal places."""
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def decimal_sum(column: str | Column, places: int, digits: str = "decimal(28,10)") -> Column:
    """A sum that does not depend on row order: added as decimals, rounded, then made a double."""
    value = F.col(column) if isinstance(column, str) else column
    return F.round(F.sum(value.cast(digits)), places).cast("double")


def exact_sum(value: Column, copies: Column) -> Column:
    """Sum of doubles, each ``copies`` times, whatever the order of rows; NULL without any value.

    Values up to 1e18 are added as decimals of ten places, whole ones up to 1e28 as whole decimals, and only what is
    larger or overflows as doubles. NaN and infinities are counted apart and give what adding them gives.
    """
    infinity, size = float("inf"), F.abs(value)
    times = copies.cast("decimal(10,0)")

    def added(inside: Column, digits: str) -> Column:
        # Without the condition on the cast itself, ANSI mode would refuse what another branch takes.
        exact = F.try_sum(F.when(inside, value).try_cast(digits) * times).cast("double")
        return F.coalesce(exact, F.sum(F.when(inside, value * copies)), F.lit(0.0))

    finite = (
        added(size < 1e18, "decimal(28,10)")
        + added((size >= 1e18) & (size < 1e28), "decimal(28,0)")
        + F.coalesce(F.sum(F.when((size >= 1e28) & (size < infinity), value * copies)), F.lit(0.0))
    )
    undefined = F.count_if(F.isnan(value)) > 0
    above, below = F.count_if(value == infinity) > 0, F.count_if(value == -infinity) > 0
    return (
        F.when(F.count(value) == 0, None)
        .when(undefined | (above & below), float("nan"))
        .when(above, infinity)
        .when(below, -infinity)
        .otherwise(finite)
    )


def seconds(milliseconds: Column) -> Column:
    """Milliseconds as seconds with three decimal places."""
    return F.round(milliseconds / 1000, 3)
