"""Checks that need only the row itself: casts, required values, domain rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from sluiceworks.contract import Column, Contract
from sluiceworks.functions import NULL_MARKER
from sluiceworks.sources.raw import MALFORMED, PROVENANCE, ROW_ID, native

FOUND = "_found"


def original(source: str) -> str:
    """Where the unmarked original of a source column is kept: its text, or the value the text is printed from."""
    return f"_raw_{source}"


def typed(raw: DataFrame, contract: Contract) -> DataFrame:
    """Contract columns typed and conformed, beside the unmarked originals (``_raw_…``).

    ``try_cast`` gives NULL for text that does not parse; the original shows that it was there.
    Doubles get ``+ 0.0`` so that negative zero equals zero. Originals stay separate columns: a
    struct of them would make every scan read all of them.
    """
    kept = [c for c in (*PROVENANCE, MALFORMED, ROW_ID) if c in raw.columns]
    originals = [f"{read_from(raw, c)} AS `{original(c.source)}`" for c in contract.columns]
    values = [f"{value_of(c, f'`{original(c.source)}`')} AS `{c.name}`" for c in contract.columns]
    return raw.selectExpr(*originals, *kept).selectExpr("*", *values)


def typed_by(raw: DataFrame, contract: Contract, by: Sequence[str], parts: int | None = None) -> DataFrame:
    """The rows of ``typed`` with those of equal ``by`` (key columns) in one partition, sorted by the key.

    Only the key is typed before the rows travel; an original that is the key's value does not travel beside it. What is
    sorted is what has travelled: the other values are typed once the rows lie in order.
    """
    keys = [c for c in contract.columns if c.name in contract.key]
    others = [c for c in contract.columns if c.name not in contract.key]
    told = [original(c.source) for c in keys if _is_original(raw, c)]
    rows = typed(raw, contract)
    moved = rows.drop(*told, *[c.name for c in others]).repartition(*([parts] if parts else []), *by)
    first = [*by, *[c.name for c in keys if c.name not in by]]
    moved = moved.sortWithinPartitions(*first)
    values = [f"{value_of(c, f'`{original(c.source)}`')} AS `{c.name}`" for c in others]
    back = [f"`{c.name}` AS `{original(c.source)}`" for c in keys if original(c.source) in told]
    return moved.selectExpr("*", *back, *values).select(*[f"`{c}`" for c in rows.columns])


def _is_original(raw: DataFrame, column: Column) -> bool:
    """Whether the typed value is the original as it is; zeros lose their sign."""
    same = native(column.source) in raw.columns and raw.schema[native(column.source)].dataType == column.type
    return same and not isinstance(column.type, T.FloatType | T.DoubleType)


def read_from(raw: DataFrame, column: Column) -> str:
    """The value a raw text was printed from if its cast is the same as that of the text, else the unmarked text."""
    if native(column.source) in raw.columns:
        have = raw.schema[native(column.source)].dataType
        if have == column.type or (type(have), type(column.type)) in _SAME_AS_TEXT:
            return f"`{native(column.source)}`"
    return unmarked(column)


# Casts that give what casting the printed value gives, beside those to the same type.
_SAME_AS_TEXT = {(T.IntegerType, T.LongType), (T.TimestampNTZType, T.DateType), (T.TimestampType, T.DateType)}


def unmarked(column: Column) -> str:
    return f"nullif(`{column.source}`, r'{NULL_MARKER}')"


def value_of(column: Column, text: str) -> str:
    if column.is_text:
        return text
    kind = column.type.simpleString()
    return f"try_cast({text} AS {kind})" + (" + 0.0D" if kind == "double" else "")


def with_key_values(raw: DataFrame, contract: Contract, prefix: str) -> DataFrame:
    """The raw rows with only the key columns typed, under prefixed names."""
    keys = [c for c in contract.columns if c.name in contract.key]
    return raw.selectExpr("*", *[f"{value_of(c, read_from(raw, c))} AS `{prefix}{c.name}`" for c in keys])


def row_findings(contract: Contract) -> list[str]:
    """One SQL expression per check, in order: per column ``bad_``/``missing_``, then ``invalid_``.

    Each is the reason's name or NULL. A rule that evaluates to NULL is not a violation.
    """
    found = []
    for c in contract.columns:
        text = f"`{original(c.source)}`"
        if not c.is_text:
            found.append(f"CASE WHEN {text} IS NOT NULL AND `{c.name}` IS NULL THEN 'bad_{c.name}' END")
        if c.required:
            found.append(f"CASE WHEN {text} IS NULL THEN 'missing_{c.name}' END")
    for name, predicate in contract.rules.items():
        found.append(f"CASE WHEN NOT ({predicate}) THEN 'invalid_{name}' END")
    return found


def with_row_findings(rows: DataFrame, contract: Contract) -> DataFrame:
    """Adds ``_found``: the reasons this row collects by itself, joined by commas (``''`` for none).

    ``concat_ws`` skips NULLs and, unlike array functions that take a lambda, is compiled together
    with the casts and comparisons around it.
    """
    found = row_findings(contract)
    if MALFORMED in rows.columns:
        found.insert(0, f"CASE WHEN {MALFORMED} IS NOT NULL THEN 'malformed_line' END")
    return rows.selectExpr("*", f"concat_ws(',', {', '.join(found)}) AS {FOUND}")
