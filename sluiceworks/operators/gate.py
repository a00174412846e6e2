"""The quality gate: every row gets its reasons; rows without any are trusted, the rest kept apart."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.contract import Contract
from sluiceworks.operators.checks import FOUND, original, typed, typed_by, with_row_findings
from sluiceworks.operators.census import census, heaviest_bucket, weighed
from sluiceworks.operators.duplicates import verdicts_are_small, with_duplicate_findings, with_findings_in_place
from sluiceworks.operators.keyed import LIMITS, Findings, Limits
from sluiceworks.operators.references import Parent, large_references, with_reference_findings
from sluiceworks.sources.raw import MALFORMED, PROVENANCE, ROW_ID

REASONS = "_reasons"
QUARANTINED_AT = "_quarantined_at"
PART_ROWS, MOST_PART_ROWS = 150_000, 1_200_000


@dataclass(frozen=True)
class Staged:
    """All rows of a dataset after the gate: originals, typed values, provenance, reasons (``''`` = clean)."""

    contract: Contract
    rows: DataFrame

    @property
    def is_clean(self):
        return F.col(REASONS) == ""

    @property
    def originals(self):
        """The original columns under their source names, as text."""
        return [F.col(f"`{original(c.source)}`").cast("string").alias(c.source) for c in self.contract.columns]

    @property
    def trusted(self) -> DataFrame:
        """Rows without a reason: typed, conformed names, in contract order."""
        return self.rows.where(self.is_clean).select(*self.contract.names)

    @property
    def rejected(self) -> DataFrame:
        """The exact complement: original strings, provenance, reasons joined by commas."""
        return self.rows.where(~self.is_clean).select(
            *self.originals,
            *[c for c in (*PROVENANCE, MALFORMED) if c in self.rows.columns],
            REASONS,
        )

    def quarantine(self, run_ts: datetime) -> DataFrame:
        """``rejected`` with the time of the run."""
        return self.rejected.withColumn(QUARANTINED_AT, F.lit(run_ts).cast("timestamp"))

    def as_parent(self) -> Parent:
        return Parent(self.trusted, self.contract.key)


def gate(
    raw: DataFrame,
    contract: Contract,
    parents: Mapping[str, Parent] | None = None,
    limits: Limits = LIMITS,
    repeated: Findings | None = None,
) -> Staged:
    """Checks ``raw`` (all strings, with ``_row_id``) against its contract.

    Reasons come in a fixed order: ``malformed_line``, per column ``bad_``/``missing_``, rules, references, duplicates.
    ``repeated`` are the repeated keys if they are known already.
    """
    if ROW_ID not in raw.columns:
        raise ValueError(f"{contract.dataset}: raw rows need {ROW_ID}; see sources.with_row_id")
    known = dict(parents or {})
    large = large_references(contract, known, limits)
    together, by, parts = next((c for c in large if c in contract.key), None), None, None
    if together:
        total, most, used = weighed(raw, contract, together, [c for c in large if c != together])
        if most <= limits.task_rows:
            by, parts = [together], _parts(raw, total)
        else:
            together = None
    if not by:
        if repeated is None:
            repeated, used = census(raw, contract, large, limits)
        else:
            _, used = census(raw, contract, large, limits, keys=False)
        if not verdicts_are_small(repeated) and repeated.heaviest <= limits.task_rows:
            by, parts = contract.key, _parts(raw, raw.count())
    if by:
        # The rows travel once, and all their copies (and the parent's key) are there when they arrive.
        base = with_row_findings(typed_by(raw, contract, by, parts), contract)
        rows, copies = with_findings_in_place(base, contract)
        rows, orphans = with_reference_findings(rows, contract, known, used, limits, together)
    else:
        base = with_row_findings(typed(raw, contract), contract)
        rows, orphans = with_reference_findings(base, contract, known, used, limits)
        rows, copies = with_duplicate_findings(rows, contract, raw, repeated)
    reasons = F.col(FOUND)
    if orphans or copies:
        reasons = F.concat_ws(",", F.nullif(F.col(FOUND), F.lit("")), *orphans, *copies)
    staged = [c for c in base.columns if c != FOUND]
    return Staged(contract, rows.select(*[f"`{c}`" for c in staged], reasons.alias(REASONS)))


def _parts(raw: DataFrame, rows: int) -> int:
    """Partitions small enough to be sorted in a small part of a task's memory.

    Up to the bypass threshold rows go straight to the shuffle's files; with more partitions the side that writes them
    sorts as well, and may spill them. So beyond it partitions grow first, to what a task still holds.
    """
    straight = int(raw.sparkSession.sparkContext.getConf().get("spark.shuffle.sort.bypassMergeThreshold", "200"))
    session = int(raw.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(min(max(session, math.ceil(rows / PART_ROWS)), straight), math.ceil(rows / MOST_PART_ROWS))


def in_parts(rows: DataFrame, total: int, by: Sequence[str]) -> DataFrame:
    """All ``total`` rows dealt out by ``by``, no value of which is too heavy, in bounded parts; few stay where they are."""
    return rows.repartition(_parts(rows, total), *by) if total > PART_ROWS else rows


def dealt_out(keys: DataFrame, by: Sequence[str], limits: Limits = LIMITS) -> DataFrame:
    """Narrow rows that are to be counted per key, dealt out by ``by`` (a part of that key) uncounted.

    Where keys hardly repeat, counting before the shuffle saves nothing and holds a task's whole input in memory. Few rows
    stay where they are, and so do values heavier than a task's share: those do shrink before the shuffle.
    """
    total, most = heaviest_bucket(keys, by)
    return keys if most > limits.task_rows else in_parts(keys, total, by)


def dealt_out_if_many(
    rows: DataFrame, key: Sequence[str], by: Sequence[str] | None = None, limits: Limits = LIMITS
) -> DataFrame:
    """Rows that are to be grouped by ``key``, dealt out by ``by`` (a part of that key, or all) if a task could not hold its groups.

    Grouping starts before the shuffle and holds every group a task meets. With few groups that is little and saves the
    shuffle; with more than a part may have rows, it spills and saves hardly any. Values heavier than a task's share stay.
    """
    by = list(by or key)
    total = rows.count()
    if total <= MOST_PART_ROWS:
        return rows
    groups = rows.agg(F.approx_count_distinct(F.xxhash64(*key)).alias("groups")).first().groups
    if groups <= MOST_PART_ROWS or heaviest_bucket(rows, by)[1] > limits.task_rows:
        return rows
    return in_parts(rows, total, by)


def reason_counts(rejected: DataFrame) -> DataFrame:
    """``(reason, rows)`` from the comma-joined reasons of a quarantine."""
    return (
        rejected.select(F.explode(F.split(REASONS, ",")).alias("reason"))
        .groupBy("reason")
        .agg(F.count("*").alias("rows"))
    )
