"""A whole build: raw tables through the gate in reference order, each stored in one pass."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass
from datetime import datetime
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sluiceworks.contract import Contract, build_order
from sluiceworks.operators.duplicates import repeated_keys
from sluiceworks.operators.gate import QUARANTINED_AT, REASONS, Staged, gate
from sluiceworks.operators.keyed import LIMITS, Limits
from sluiceworks.operators.references import Parent
from sluiceworks.session import keep_files_open, workspace
from sluiceworks.sources.landing import landed_files, manifest_frame, presence, read_csv, require_present
from sluiceworks.sources.raw import MALFORMED, PROVENANCE, read_parquet
from sluiceworks.sources.store import dataset_folder, publish
from sluiceworks.sources.versions import Version

VERDICT = "verdict"
ORIGINAL = "_original"


@dataclass(frozen=True)
class Stored:
    """A gated dataset at rest: trusted and quarantined rows in one table, split by ``verdict``."""

    contract: Contract
    table: DataFrame
    rows: int
    clean: int

    @property
    def trusted(self) -> DataFrame:
        return self.table.where(F.col(VERDICT) == "trusted").select(*self.contract.names)

    @property
    def rejected(self) -> DataFrame:
        return self.table.where(F.col(VERDICT) == "quarantine").select(
            f"{ORIGINAL}.*", *[c for c in (*PROVENANCE, MALFORMED) if c in self.table.columns], REASONS
        )

    def quarantine(self, run_ts: datetime) -> DataFrame:
        return self.rejected.withColumn(QUARANTINED_AT, F.lit(run_ts).cast("timestamp"))

    def as_parent(self) -> Parent:
        return Parent(self.trusted, self.contract.key, self.clean)


def store(staged: Staged, path: str) -> Stored:
    """Both outputs from one evaluation of the gate: one write, partitioned by verdict.

    Trusted rows keep typed values only and quarantined rows original text only, so nothing is
    stored twice. The counts are taken by the write itself. Every call writes a version of its own below
    ``path``, so a build can be repeated in the same place and a failed one leaves the last as it was.
    """
    return _write_split(staged, f"{path}/version-{uuid.uuid4().hex}")


def _write_split(staged: Staged, path: str) -> Stored:
    clean = staged.is_clean
    names = staged.contract.names
    seen = Observation()
    split = staged.rows.observe(
        seen, F.count("*").alias("rows"), F.count_if(clean).alias("clean")
    ).select(
        F.when(clean, F.lit("trusted")).otherwise(F.lit("quarantine")).alias(VERDICT),
        *[F.when(clean, F.col(n)).alias(n) for n in names],
        F.when(~clean, F.struct(*staged.originals)).alias(ORIGINAL),
        *[F.when(~clean, F.col(c)).alias(c) for c in (*PROVENANCE, MALFORMED) if c in staged.rows.columns],
        REASONS,
    )
    keep_files_open(split.sparkSession)
    split.write.partitionBy(VERDICT).parquet(path)
    schema = T.StructType(
        [f for f in split.schema if f.name != VERDICT] + [T.StructField(VERDICT, T.StringType())]
    )
    table = staged.rows.sparkSession.read.schema(schema).parquet(path)
    return Stored(staged.contract, table, seen.get["rows"], seen.get["clean"])


QUARANTINE = "quarantine_{}"


def publish_split(staged: Staged, schema: str, keep: int = 1) -> Stored:
    """As ``store``, but committed under names: the trusted rows as ``<dataset>``, the others as ``quarantine_<dataset>``.

    Both tables are the two parts of one version, so they change together; the pass count of the gate is kept
    with it.
    """
    contract, spark = staged.contract, staged.rows.sparkSession
    version = Version(spark, dataset_folder(spark, schema, contract.dataset))
    try:
        stored = _write_split(staged, version.path)
    except Exception:
        version.discard()
        raise
    for part in ("trusted", "quarantine"):
        version.make_folder(f"{VERDICT}={part}")
    kept_aside = [f for f in stored.table.schema if f.name in (ORIGINAL, *PROVENANCE, MALFORMED, REASONS)]
    tables = {
        contract.dataset: (f"{VERDICT}=trusted", contract.trusted_schema),
        QUARANTINE.format(contract.dataset): (f"{VERDICT}=quarantine", T.StructType(kept_aside)),
    }
    gated = {"expectation": "quality_gate", "action": "drop", "passed": stored.clean, "failed": stored.rows - stored.clean}
    publish(spark, schema, version, tables, [gated], keep)
    return stored


def land(
    spark: SparkSession,
    landing: str,
    contracts: Mapping[str, Contract],
    run_ts: datetime,
    folder: str | None = None,
    parallel: int = 8,
) -> dict[str, DataFrame]:
    """Copies one CSV file (or folder) per dataset into stored raw tables and returns those.

    Fails before copying anything if a dataset's file is missing. The copies hold every value as it
    was, and a malformed line's whole text; only the file name and the time of the run are added.
    """
    folder = folder or workspace(spark, "raw")
    require_present(
        presence(landed_files(spark, landing, ".csv"), manifest_frame(spark, dict.fromkeys(contracts, 0)))
    )

    def copy(name: str) -> tuple[str, DataFrame]:
        path = f"{folder}/{name}/version-{uuid.uuid4().hex}"
        read_csv(spark, f"{landing}/{name}.csv", contracts[name], run_ts).write.parquet(path)
        return name, read_parquet(spark, path)

    with ThreadPool(parallel) as pool:
        return dict(pool.map(inheritable_thread_target(spark)(copy), contracts, chunksize=1))


def _may_be_large(raw: DataFrame, limits: Limits) -> bool:
    """Whether the trusted part of ``raw`` may have too many rows to be broadcast; reads no column."""
    return raw.select(F.lit(1)).limit(limits.broadcast_rows + 1).count() > limits.broadcast_rows


def build(
    spark: SparkSession,
    raw: Mapping[str, DataFrame],
    contracts: Mapping[str, Contract],
    folder: str | None = None,
    limits: Limits = LIMITS,
    parallel: int = 8,
) -> dict[str, Stored]:
    """Gates and stores every dataset; datasets of one wave run side by side.

    Children are checked against what is trusted of their parents, so a parent's quarantined row
    takes its children with it.
    """
    folder = folder or workspace(spark, "build")
    done: dict[str, Stored] = {}

    def look(name: str):
        return name, repeated_keys(raw[name], contracts[name], limits)

    def sized(name: str) -> tuple[str, bool]:
        return name, _may_be_large(raw[name], limits)

    def one(name: str) -> tuple[str, Stored]:
        contract = contracts[name]
        parents = {r.parent: done[r.parent].as_parent() for r in contract.references}
        staged = gate(raw[name], contract, parents, limits, repeated.get(name))
        return name, store(staged, f"{folder}/{name}")

    waves = build_order(contracts)
    with ThreadPool(parallel) as pool:
        parents = sorted({r.parent for c in contracts.values() for r in c.references})
        large = dict(pool.map(inheritable_thread_target(spark)(sized), parents, chunksize=1))
        # Without large parents, keys can be looked at before the parents are there.
        alone = [n for n, c in contracts.items() if not any(large[r.parent] for r in c.references)]
        repeated = dict(pool.map(inheritable_thread_target(spark)(look), alone, chunksize=1))
        for wave in waves:
            done.update(pool.map(inheritable_thread_target(spark)(one), wave, chunksize=1))
    return done
