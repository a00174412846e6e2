"""Documentation as data: comments for schemas, tables and columns, tags, and their coverage."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from sluiceworks.contract import Contract


@dataclass(frozen=True)
class Describer:
    """Finds the description of a column; the first rule that applies wins.

    Explicit text for one table's column, then key, reference, name pattern, the contract's own
    comment, text for that name in any table. ``None`` means undocumented.
    """

    contracts: Mapping[str, Contract]
    texts: Mapping[str, str] = field(default_factory=dict)
    overrides: Mapping[tuple[str, str], str] = field(default_factory=dict)
    patterns: tuple[tuple[str, str], ...] = ()

    def column(self, table: str, name: str) -> str | None:
        if (table, name) in self.overrides:
            return self.overrides[table, name]
        contract = self.contracts.get(table)
        if contract and name in contract.key:
            return self._key(contract, name)
        if contract:
            for ref in contract.references:
                if ref.column == name:
                    return f"Refers to {ref.parent}.{ref.parent_column}."
        for pattern, text in self.patterns:
            if re.search(pattern, name):
                return text
        if contract:
            for c in contract.columns:
                if c.name == name and c.comment:
                    return c.comment
        return self.texts.get(name)

    def _key(self, contract: Contract, name: str) -> str:
        role = "Primary key" if len(contract.key) == 1 else "Part of the natural key"
        to = [f"{r.parent}.{r.parent_column}" for r in contract.references if r.column == name]
        return f"{role}; refers to {to[0]}." if to else f"{role}."

    def table(self, name: str) -> str | None:
        return self.contracts[name].about if name in self.contracts else None


def quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def comment_schema(spark: SparkSession, schema: str, text: str, tags: Mapping[str, str]) -> None:
    spark.sql(f"COMMENT ON SCHEMA {schema} IS {quoted(text)}")
    if tags:
        pairs = ", ".join(f"{quoted(k)} = {quoted(v)}" for k, v in tags.items())
        spark.sql(f"ALTER SCHEMA {schema} SET DBPROPERTIES ({pairs})")


def comment_table(spark: SparkSession, table: str, text: str, tags: Mapping[str, str]) -> None:
    """Table comment and tags (kept as table properties ``tag.…``); running it again overwrites."""
    spark.sql(f"COMMENT ON TABLE {table} IS {quoted(text)}")
    if tags:
        pairs = ", ".join(f"{quoted('tag.' + k)} = {quoted(v)}" for k, v in tags.items())
        spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")


def comment_columns(
    spark: SparkSession, table: str, describe: Callable[[str], str | None]
) -> list[str]:
    """Comments every column of a stored table and returns those without a description."""
    missing = []
    for c in spark.table(table).columns:
        text = describe(c)
        if text is None:
            missing.append(c)
        else:
            spark.sql(f"ALTER TABLE {table} ALTER COLUMN `{c}` COMMENT {quoted(text)}")
    return missing


def coverage(spark: SparkSession, schema: str) -> DataFrame:
    """Per table of a schema: columns, documented, undocumented, whether it has a comment, tags.

    Read back from the catalog, which holds one small entry per table.
    """
    lines = []
    for t in spark.catalog.listTables(schema):
        name = f"{schema}.{t.name}"
        columns = spark.catalog.listColumns(name)
        done = sum(1 for c in columns if c.description)
        properties = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
        tags = sum(1 for p in properties if p.key.startswith("tag."))
        lines.append((t.name, len(columns), done, len(columns) - done, bool(t.description), tags))
    return spark.createDataFrame(
        lines,
        "table_name string, columns int, documented int, undocumented int, has_comment boolean, tags int",
    )
