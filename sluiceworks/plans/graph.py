"""Named datasets that build on each other, each stored once per run and read back by name.

A dataset is a function of the datasets it needs; a gated one is a contract over its raw rows, which are stored first, as
``raw_<dataset>``. A run stores every dataset as
an atomic snapshot (``sources.store``) with its expectations counted by that write; what depends on it reads
the stored table. A run that fails half-way leaves each table whole, as this run or the one before stored it.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from graphlib import TopologicalSorter
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from sluiceworks.contract import Contract, build_order
from sluiceworks.operators.describe import Describer, comment_columns, comment_schema, comment_table
from sluiceworks.operators.expectations import Expectation
from sluiceworks.operators.gate import gate
from sluiceworks.operators.keyed import LIMITS, Limits
from sluiceworks.operators.references import Parent
from sluiceworks.plans.flow import QUARANTINE, publish_split
from sluiceworks.sources.raw import ROW_ID, with_row_id
from sluiceworks.sources.store import history, overwrite, read_table

RAW = "raw_{}"
LAYERS = {RAW: "bronze", "{}": "silver", QUARANTINE: "quarantine"}


@dataclass(frozen=True)
class Dataset:
    name: str
    make: Callable[..., DataFrame]
    needs: tuple[str, ...] = ()
    about: str = ""
    expectations: tuple[Expectation, ...] = ()


@dataclass
class Graph:
    """Contracts over raw rows, and datasets made of what they trust."""

    contracts: Mapping[str, Contract] = field(default_factory=dict)
    raw: Callable[[SparkSession, str], DataFrame] | None = None
    datasets: dict[str, Dataset] = field(default_factory=dict)

    def dataset(
        self, name: str, needs: Sequence[str] = (), about: str = "", expectations: Sequence[Expectation] = ()
    ) -> Callable[[Callable[..., DataFrame]], Callable[..., DataFrame]]:
        """Declares the decorated function, called with the needed tables in order, as a dataset."""

        def declare(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
            if name in self.datasets or name in self.contracts:
                raise ValueError(f"{name} is declared twice")
            self.datasets[name] = Dataset(name, make, tuple(needs), about, tuple(expectations))
            return make

        return declare

    def waves(self, wanted: Sequence[str] | None = None) -> list[list[str]]:
        """The wanted datasets (default: all) and what they need, each wave needing earlier ones only."""
        build_order(self.contracts)
        needs = {n: {r.parent for r in c.references} for n, c in self.contracts.items()}
        needs |= {n: set(d.needs) for n, d in self.datasets.items()}
        todo, chosen = list(needs if wanted is None else wanted), set()
        while todo:
            name = todo.pop()
            if name not in needs:
                raise ValueError(f"no dataset {name}")
            if name not in chosen:
                chosen.add(name)
                todo += needs[name]
        sorter = TopologicalSorter({n: needs[n] for n in chosen})
        sorter.prepare()
        waves = []
        while sorter.is_active():
            waves.append(sorted(sorter.get_ready()))
            sorter.done(*waves[-1])
        return waves

    def tables(self) -> list[str]:
        """Names of all tables a full run stores."""
        return [form.format(n) for form in LAYERS for n in self.contracts] + list(self.datasets)

    def layers(self) -> dict[str, tuple[str, str]]:
        """Table -> its layer and the contract or dataset it belongs to."""
        gated = {form.format(n): (layer, n) for form, layer in LAYERS.items() for n in self.contracts}
        return gated | {n: ("gold", n) for n in self.datasets}

    def run(
        self, spark: SparkSession, schema: str, wanted: Sequence[str] | None = None, limits: Limits = LIMITS, parallel: int = 8
    ) -> dict[str, DataFrame]:
        """Stores the datasets in ``schema`` and returns them as read back by name."""

        def parent(ref: str) -> Parent:
            gated = history(spark, f"{schema}.{ref}")[-1].about["metrics"][0]
            return Parent(read_table(spark, f"{schema}.{ref}"), self.contracts[ref].key, gated["passed"])

        def one(name: str) -> None:
            if name in self.contracts:
                contract = self.contracts[name]
                parents = {r.parent: parent(r.parent) for r in contract.references}
                landed = overwrite(self.raw(spark, name).drop(ROW_ID), f"{schema}.{RAW.format(name)}")
                publish_split(gate(with_row_id(landed, by_name=True), contract, parents, limits), schema)
            else:
                d = self.datasets[name]
                overwrite(d.make(*(read_table(spark, f"{schema}.{n}") for n in d.needs)), f"{schema}.{name}", d.expectations)

        waves = self.waves(wanted)
        with ThreadPool(parallel) as pool:
            for wave in waves:
                pool.map(inheritable_thread_target(spark)(one), wave, chunksize=1)
        return {n: read_table(spark, f"{schema}.{n}") for wave in waves for n in wave}

    def document(self, spark: SparkSession, schema: str, describer: Describer, about: str, parallel: int = 8) -> dict[str, list[str]]:
        """Comments and tags for the schema, every table of a full run and every column; returns what has no text.

        Running it again gives the same catalog.
        """
        comment_schema(spark, schema, about, {"datasets": str(len(self.tables()))})

        def one(entry: tuple[str, tuple[str, str]]) -> tuple[str, list[str]]:
            table, (layer, name) = entry
            text = self.datasets[name].about if name in self.datasets else describer.table(name)
            prefix = {"bronze": "As landed: ", "quarantine": "Rows not trusted: "}.get(layer, "")
            comment_table(spark, f"{schema}.{table}", prefix + (text or name), {"layer": layer, "dataset": name})

            def column(c: str) -> str | None:
                source = {k.source: k.name for k in self.contracts[name].columns} if name in self.contracts else {}
                return describer.column(name, source.get(c, c) if layer == "bronze" else c)

            return table, comment_columns(spark, f"{schema}.{table}", column)

        with ThreadPool(parallel) as pool:
            missing = pool.map(inheritable_thread_target(spark)(one), self.layers().items(), chunksize=1)
        return {table: columns for table, columns in missing if columns}
