"""Schema-on-write contracts: types, natural key, required columns, domain rules, references."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from functools import cached_property
from graphlib import TopologicalSorter

from pyspark.sql import types as T


def conform(name: str) -> str:
    """camelCase source name to snake_case; every capital starts a new word."""
    return re.sub(r"(?<!^)([A-Z])", r"_\1", name).lower()


@dataclass(frozen=True)
class Reference:
    """``column`` must exist as ``parent_column`` among the trusted rows of ``parent``."""

    column: str
    parent: str
    parent_column: str


@dataclass(frozen=True)
class Column:
    source: str
    name: str
    type: T.DataType
    required: bool
    comment: str | None

    @property
    def is_text(self) -> bool:
        return isinstance(self.type, T.StringType)


@dataclass(frozen=True)
class Contract:
    """What a dataset must look like to be trusted.

    ``ddl`` is a Spark DDL schema in *source* names and source column order: ``NOT NULL`` marks a
    required column and ``COMMENT`` documents it. ``key``, ``rules`` (name -> SQL predicate) and
    ``references`` use conformed names. Columns the DDL does not list are left out of both outputs.
    """

    dataset: str
    ddl: str
    key: tuple[str, ...]
    rules: Mapping[str, str] = field(default_factory=dict)
    references: tuple[Reference, ...] = ()
    about: str = ""

    @cached_property
    def columns(self) -> tuple[Column, ...]:
        return tuple(
            Column(f.name, conform(f.name), f.dataType, not f.nullable, f.metadata.get("comment"))
            for f in T.StructType.fromDDL(self.ddl)
        )

    @property
    def names(self) -> list[str]:
        return [c.name for c in self.columns]

    @cached_property
    def raw_schema(self) -> T.StructType:
        """Source names, all strings: how the dataset lies in its landing files."""
        return T.StructType([T.StructField(c.source, T.StringType()) for c in self.columns])

    @cached_property
    def trusted_schema(self) -> T.StructType:
        """Conformed names and declared types; comments travel in the field metadata."""
        return T.StructType(
            [
                T.StructField(c.name, c.type, True, {"comment": c.comment} if c.comment else {})
                for c in self.columns
            ]
        )

    def problems(self) -> list[str]:
        """Everything that makes this contract contradict itself (empty when sound)."""
        names, required = set(self.names), {c.name for c in self.columns if c.required}
        found = []
        if len(names) != len(self.columns):
            found.append(f"{self.dataset}: two source columns share a conformed name")
        if not self.key:
            found.append(f"{self.dataset}: no natural key")
        found += [f"{self.dataset}: key column {k} is not declared" for k in self.key if k not in names]
        found += [
            f"{self.dataset}: key column {k} is not required"
            for k in self.key
            if k in names and k not in required
        ]
        found += [
            f"{self.dataset}: reference column {r.column} is not declared"
            for r in self.references
            if r.column not in names
        ]
        return found


def build_order(contracts: Mapping[str, Contract]) -> list[list[str]]:
    """Datasets in waves: each wave only refers to earlier ones. Raises on unsound contracts."""
    problems = [p for c in contracts.values() for p in c.problems()]
    problems += [
        f"{c.dataset}: unknown parent {r.parent}"
        for c in contracts.values()
        for r in c.references
        if r.parent not in contracts
    ]
    if problems:
        raise ValueError("; ".join(problems))
    graph = TopologicalSorter({n: {r.parent for r in c.references} for n, c in contracts.items()})
    graph.prepare()  # raises CycleError
    waves = []
    while graph.is_active():
        ready = sorted(graph.get_ready())
        waves.append(ready)
        graph.done(*ready)
    return waves
