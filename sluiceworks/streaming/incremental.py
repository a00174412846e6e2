"""The gate over data that land bit by bit, with the tables of one build over everything landed so far.

Each landing is an epoch: its raw rows are kept, and of all rows landed so far only those are decided again whose verdict it can
change. These are the rows that share a natural key with a new row (a late copy can turn a trusted row into a
conflict), and those that refer to a value of a parent's rows decided since. Which rows that are is told by a stored state of
keys, referring values and row ids, so old raw rows are read only where they are hit, and then go through the
gate together with the new ones.

Decided rows are appended, never rewritten: ``decided/<epoch>`` holds rows with their verdicts, ``superseded/<epoch>`` the ids of
rows that were decided anew, ``touched/<epoch>`` the values that rows elsewhere may refer to. A row counts as decided last.
An epoch becomes visible by its commit; one that died before is written again from the start, and a
batch that was committed already is skipped, so a restarted stream changes nothing twice.

Defined results: an empty batch only takes note of what parents decided; rows with a NULL in their key form one group, as
in the gate; malformed lines have no key and are decided once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceworks.contract import Contract, build_order
from sluiceworks.operators.audit import union_all
from sluiceworks.operators.checks import typed
from sluiceworks.operators.gate import REASONS, gate
from sluiceworks.operators.keyed import LIMITS, Limits, fits_broadcast
from sluiceworks.operators.references import Parent
from sluiceworks.session import checkpoint_folder
from sluiceworks.sources.raw import MALFORMED, PROVENANCE, ROW_ID, well_formed, with_row_id
from sluiceworks.sources.versions import Commit, Version, commits

EPOCH = "_epoch"
ORIGINAL = "_original"


class IncrementalGate:
    """One dataset below ``folder``; ``parents`` are the gates of the datasets it refers to."""

    def __init__(
        self, spark: SparkSession, contract: Contract, folder: str,
        parents: Mapping[str, IncrementalGate] | None = None, limits: Limits = LIMITS, referenced: tuple[str, ...] = (),
    ):
        self.spark, self.contract, self.limits = spark, contract, limits
        self.folder = folder.rstrip("/")
        self.parents = dict(parents or {})
        # Columns that other datasets refer to.
        self.referenced = tuple(dict.fromkeys((*contract.key, *referenced)))

    # --- what is stored

    def epochs(self) -> list[Commit]:
        return commits(self.spark, self.folder)

    def _parts(self, epochs: list[Commit], name: str) -> list[tuple[int, DataFrame]]:
        found = [(c.number, f"{c.path(self.folder)}/{name}") for c in epochs if name in c.about["parts"]]
        return [(n, self.spark.read.parquet(path)) for n, path in found]

    def _raw(self, epochs: list[Commit]) -> list[DataFrame]:
        """Raw rows with ids that sort by epoch: of equal copies, the one that landed first is kept."""
        return [
            with_row_id(part).withColumn(ROW_ID, F.struct(F.lit(n).alias("epoch"), f"{ROW_ID}.file", f"{ROW_ID}.row"))
            for n, part in self._parts(epochs, "raw")
        ]

    def _smaller(self, frame: DataFrame) -> DataFrame:
        """``frame``, to be broadcast if it is measured to be small, and only then: files of row ids are much smaller than they."""
        return F.broadcast(frame) if fits_broadcast(frame, self.limits) else frame.hint("merge")

    def current(self) -> DataFrame | None:
        """Every landed row once, with its latest verdict; nothing before the first epoch."""
        epochs = self.epochs()
        decided = [part.withColumn(EPOCH, F.lit(n)) for n, part in self._parts(epochs, "decided")]
        if not decided:
            return None
        rows = union_all(decided)
        superseded = [p.select(F.col(ROW_ID).alias("_id"), F.lit(n).alias("_since")) for n, p in self._parts(epochs, "superseded")]
        if not superseded:
            return rows
        last = self._smaller(union_all(superseded).groupBy("_id").agg(F.max("_since").alias("_since")))
        alive = F.col("_since").isNull() | (F.col(EPOCH) >= F.col("_since"))
        return rows.join(last, F.col(ROW_ID) == F.col("_id"), "left").where(alive).drop("_id", "_since")

    @property
    def trusted(self) -> DataFrame:
        rows = self.current()
        if rows is None:
            return self.spark.createDataFrame([], self.contract.trusted_schema)
        return rows.where(F.col(REASONS) == "").select(*self.contract.names)

    @property
    def rejected(self) -> DataFrame:
        """Original strings, provenance and reasons of the rows that are not trusted."""
        rows = self.current()
        if rows is None:
            return self.spark.createDataFrame([], self.contract.raw_schema).withColumn(REASONS, F.lit(""))
        extra = [c for c in (*PROVENANCE, MALFORMED) if c in rows.columns]
        return rows.where(F.col(REASONS) != "").select(f"{ORIGINAL}.*", *extra, REASONS)

    # --- an epoch

    def _hit(self, fresh: DataFrame, epochs: list[Commit], since: Mapping[str, int]) -> DataFrame | None:
        """Ids of earlier rows that this epoch can change."""
        state = [part for _, part in self._parts(epochs, "state")]
        if not state:
            return None
        state, hits = union_all(state), []
        keys = fresh.select(*[F.col(k).alias(f"_new_{k}") for k in self.contract.key]).distinct()
        same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in self.contract.key]
        hits.append(state.join(self._smaller(keys), same, "left_semi").select(ROW_ID))
        for ref in self.contract.references:
            parent = self.parents[ref.parent]
            news = [c for c in parent.epochs() if c.number > since.get(ref.parent, 0)]
            values = [p.select(F.col(ref.parent_column).alias("_value")) for _, p in parent._parts(news, "touched")]
            if values:
                changed = self._smaller(union_all(values).distinct())
                hits.append(state.join(changed, F.col(ref.column) == F.col("_value"), "left_semi").select(ROW_ID))
        return union_all(hits).distinct()

    def _same_keys(self, hit: DataFrame, epochs: list[Commit]) -> DataFrame:
        """All rows of the keys of ``hit``: copies are decided together."""
        state = union_all([part for _, part in self._parts(epochs, "state")])
        keys = state.join(self._smaller(hit), ROW_ID, "left_semi").select(*[F.col(k).alias(f"_new_{k}") for k in self.contract.key])
        same = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in self.contract.key]
        return state.join(self._smaller(keys.distinct()), same, "left_semi").select(ROW_ID)

    def apply(self, batch: DataFrame, batch_id: int | None = None) -> None:
        """Lands one batch of raw rows (all strings, with provenance) and commits the epoch.

        ``batch_id`` is a stream's number for it: batches up to the last committed one are skipped.
        """
        epochs = self.epochs()
        done = [c.about["batch"] for c in epochs if c.about["batch"] is not None]
        if batch_id is not None and done and batch_id <= done[-1]:
            return
        since = epochs[-1].about["parents"] if epochs else {}
        now = {n: (p.epochs() or [Commit(0, "", {})])[-1].number for n, p in self.parents.items()}
        version = Version(self.spark, self.folder)
        parts = ["raw"]

        def write(frame: DataFrame, name: str) -> DataFrame:
            frame.write.parquet(f"{version.path}/{name}")
            parts.append(name)
            return self.spark.read.schema(frame.schema).parquet(f"{version.path}/{name}")

        try:
            wanted = [c.source for c in self.contract.columns]
            batch.select(*wanted, *[c for c in (*PROVENANCE, MALFORMED) if c in batch.columns]).write.parquet(f"{version.path}/raw")
            itself = Commit(version.number, version.name, {"parts": ["raw"]})
            raw = self._raw([itself])[0]
            refers = [r.column for r in self.contract.references]
            state = typed(well_formed(raw), self.contract).select(*dict.fromkeys((*self.contract.key, *refers)), ROW_ID)
            fresh = write(state, "state")
            hit = self._hit(fresh, epochs, since)
            if hit is not None:
                hit = write(self._same_keys(hit, epochs), "superseded")
                if not hit.isEmpty():
                    ids = self._smaller(hit)
                    raw = union_all([raw, *(r.join(ids, ROW_ID, "left_semi").select(*raw.columns) for r in self._raw(epochs))])
            trusted = {n: Parent(p.trusted, p.contract.key) for n, p in self.parents.items()}
            staged = gate(raw, self.contract, trusted, self.limits)
            clean = staged.is_clean
            decided = staged.rows.select(
                ROW_ID,
                *[F.when(clean, F.col(n)).alias(n) for n in self.contract.names],
                F.when(~clean, F.struct(*staged.originals)).alias(ORIGINAL),
                *[F.when(~clean, F.col(c)).alias(c) for c in (*PROVENANCE, MALFORMED) if c in staged.rows.columns],
                REASONS,
            )
            write(decided, "decided")
            values = typed(well_formed(raw), self.contract).select(*self.referenced).distinct()
            write(values, "touched")
        except Exception:
            version.discard()
            raise
        version.commit({"parts": parts, "batch": batch_id, "parents": now})

    def stream(self, rows: DataFrame, checkpoint: str | None = None) -> None:
        """Runs a streaming frame of raw rows through the gate until all that has landed is decided."""
        where = checkpoint or f"{self.folder}/_stream"
        query = (
            rows.writeStream.foreachBatch(self.apply).option("checkpointLocation", where).trigger(availableNow=True).start()
        )
        query.awaitTermination()


class IncrementalFlow:
    """The gates of several datasets; what one decides anew reaches those that refer to it."""

    def __init__(self, spark: SparkSession, contracts: Mapping[str, Contract], folder: str, limits: Limits = LIMITS):
        checkpoint_folder(spark)
        self.gates: dict[str, IncrementalGate] = {}
        self.order = [n for wave in build_order(contracts) for n in wave]
        for name in self.order:
            used = tuple(r.parent_column for c in contracts.values() for r in c.references if r.parent == name)
            parents = {r.parent: self.gates[r.parent] for r in contracts[name].references}
            self.gates[name] = IncrementalGate(spark, contracts[name], f"{folder}/{name}", parents, limits, used)

    def land(self, batches: Mapping[str, DataFrame]) -> None:
        """One batch of each dataset that has one; the others follow what their parents decided."""
        for name in self.order:
            gate_ = self.gates[name]
            if name in batches:
                gate_.apply(batches[name])
            else:
                self._follow(gate_)

    def stream(self, sources: Mapping[str, DataFrame]) -> None:
        """All that has landed in the streaming ``sources``, parents first."""
        for name in self.order:
            if name in sources:
                self.gates[name].stream(sources[name])
            self._follow(self.gates[name])

    @staticmethod
    def _follow(gate_: IncrementalGate) -> None:
        epochs = gate_.epochs()
        if not epochs:
            return
        seen = epochs[-1].about["parents"]
        if any(p.epochs() and p.epochs()[-1].number > seen.get(n, 0) for n, p in gate_.parents.items()):
            raw = gate_._parts(epochs, "raw")[-1][1]
            gate_.apply(raw.limit(0))
