"""Attaching per-key findings to wide rows without shuffling the rows when that can be avoided.

A finding frame has one row per key and a weight: how many wide rows share the key. It is
checkpointed in the shared folder and measured on the way. If it is small it is broadcast and the wide rows
stay where they are. If it is not, both sides are shuffled on the key, and keys with more rows
than one task should hold are spread over several tasks.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from sluiceworks.session import checkpoint_folder
from sluiceworks.sources.raw import ROW_ID


@dataclass(frozen=True)
class Limits:
    """Sizes the physical choices depend on. They never change a result."""

    broadcast_rows: int = 200_000
    broadcast_bytes: int = 32 * 1024 * 1024
    task_rows: int = 5_000_000
    heavy_keys: int = 50_000


LIMITS = Limits()


@dataclass(frozen=True)
class Findings:
    """A checkpointed finding frame and its measurements."""

    frame: DataFrame
    keys: tuple[str, ...]
    weight: str
    rows: int
    key_bytes: int
    total_weight: int
    heaviest: int
    limits: Limits

    def prefixed(self, prefix: str) -> Findings:
        """The same findings under prefixed key names."""
        frame = renamed(self.frame, list(self.keys), prefix)
        return replace(self, frame=frame, keys=tuple(prefix + k for k in self.keys))

    @property
    def small(self) -> bool:
        return self.rows <= self.limits.broadcast_rows and self.key_bytes <= self.limits.broadcast_bytes

    @property
    def rows_per_task(self) -> int:
        """At most ``heavy_keys`` keys can each weigh more than this."""
        return max(self.limits.task_rows, math.ceil(self.total_weight / self.limits.heavy_keys))


def settle(frame: DataFrame, keys: list[str], weight: str, limits: Limits = LIMITS) -> Findings:
    """Checkpoints a finding frame in the shared folder, measuring it on the way."""
    checkpoint_folder(frame.sparkSession)
    seen = Observation()
    stored = frame.observe(
        seen,
        F.count("*").alias("rows"),
        F.sum(text_bytes(keys)).alias("key_bytes"),
        F.sum(weight).alias("weight"),
        F.max(weight).alias("heaviest"),
    ).checkpoint()
    sizes = seen.get
    return Findings(
        stored, tuple(keys), weight, sizes["rows"], sizes["key_bytes"] or 0, sizes["weight"] or 0, sizes["heaviest"] or 0, limits
    )


def text_bytes(columns: list[str]) -> Column:
    """Size of the columns' values written out as text; at least one byte each."""
    sizes = [F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(1)) for c in columns]
    return reduce(lambda a, b: a + b, sizes)


def fits_broadcast(frame: DataFrame, limits: Limits = LIMITS) -> bool:
    """Counts rows and bytes, reading no more rows than the bound, and compares with the limits."""
    size = (
        frame.limit(limits.broadcast_rows + 1)
        .agg(F.count("*").alias("rows"), F.sum(text_bytes(frame.columns)).alias("bytes"))
        .first()
    )
    return size.rows <= limits.broadcast_rows and (size.bytes or 0) <= limits.broadcast_bytes


def merged(frame: DataFrame) -> DataFrame:
    """The side of a join that is not to be broadcast.

    Spark's own choice goes by the size of files. For few columns of compressed ones that can be a fiftieth of the rows,
    and the driver would collect them all.
    """
    return frame.hint("merge")


def same_key(keys: list[str], prefix: str) -> Column:
    """NULL-safe equality of the key columns with their prefixed twins."""
    return reduce(
        lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(prefix + k)) for k in keys]
    )


def renamed(frame: DataFrame, keys: list[str], prefix: str) -> DataFrame:
    return frame.withColumnsRenamed({k: prefix + k for k in keys})


def attach(rows: DataFrame, found: DataFrame, sizes: Findings, payload: float = 16) -> DataFrame:
    """Left join of ``found`` (one row per key of ``sizes``) to ``rows``; NULL keys match NULL keys.

    ``found`` holds no keys beyond those of ``sizes`` and on average ``payload`` bytes beside each, which count
    where it is to be broadcast. ``rows`` must carry ``_row_id``.
    """
    keys, prefix = list(sizes.keys), "_found_"
    if sizes.small and sizes.key_bytes + payload * sizes.rows <= sizes.limits.broadcast_bytes:
        other = F.broadcast(renamed(found, keys, prefix))
        return rows.join(other, same_key(keys, prefix), "left").drop(*[prefix + k for k in keys])
    heavy = sizes.frame.where(F.col(sizes.weight) > sizes.rows_per_task)
    return spread_join(rows, found, heavy, sizes, [ROW_ID], "left")


def spread_join(
    rows: DataFrame, other: DataFrame, heavy: DataFrame, sizes: Findings, identity: list[str], how: str
) -> DataFrame:
    """Shuffle join of ``rows`` with ``other`` (one row per key) in which no key is too much for a task.

    Keys above ``rows_per_task`` are few by the pigeonhole principle, so their list may be broadcast;
    it tells in how many parts each is cut. A row's part follows from its identity, so a task that is
    run again cuts the same way. ``other`` is repeated once per part, for heavy keys only. It is merged: its rows can be
    many times what Spark makes of the size of their files.
    """
    keys, prefix = list(sizes.keys), "_found_"
    parts = F.ceil(F.col(sizes.weight) / sizes.rows_per_task).cast("int")
    cuts = heavy.select(*keys, parts.alias("_parts"))
    cut_rows = (
        rows.join(F.broadcast(renamed(cuts, keys, "_cut_")), same_key(keys, "_cut_"), "left")
        .withColumn(
            "_part", F.coalesce(F.pmod(F.xxhash64(*identity), F.col("_parts")).cast("int"), F.lit(0))
        )
        .drop("_parts", *["_cut_" + k for k in keys])
    )
    copies = (
        renamed(other, keys, prefix)
        .join(F.broadcast(renamed(cuts, keys, "_cut_")), _twins(keys, prefix, "_cut_"), "left")
        .withColumn(
            prefix + "part", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
        )
        .drop("_parts", *["_cut_" + k for k in keys])
    )
    on = same_key(keys, prefix) & (F.col("_part") == F.col(prefix + "part"))
    return cut_rows.join(merged(copies), on, how).drop("_part", prefix + "part", *[prefix + k for k in keys])


def _twins(keys: list[str], left: str, right: str) -> Column:
    return reduce(lambda a, b: a & b, [F.col(left + k).eqNullSafe(F.col(right + k)) for k in keys])
