"""What became of given keys: their raw rows, the verdict on each, and the mart rows they are in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceworks.contract import Contract
from sluiceworks.operators.audit import union_all
from sluiceworks.operators.checks import with_key_values
from sluiceworks.operators.gate import REASONS
from sluiceworks.operators.keyed import LIMITS, Limits, fits_broadcast, renamed, same_key
from sluiceworks.sources.raw import SOURCE_FILE

LAYERS = ("1 raw", "2 trusted", "2 quarantine", "3 mart")


@dataclass(frozen=True)
class Trail:
    """How trusted rows lead into a mart: its frame, the columns of its groups made from a row, and what to show."""

    mart: DataFrame
    groups: Mapping[str, Column]
    shown: Sequence[str]


def _shown(columns: Sequence[str]) -> Column:
    return F.concat_ws(",", *[F.col(f"`{c}`").cast("string") for c in columns])


def trace(
    contract: Contract, raw: DataFrame, trusted: DataFrame, rejected: DataFrame, keys: DataFrame,
    trails: Mapping[str, Trail], limits: Limits = LIMITS,
) -> DataFrame:
    """``<key columns>, layer, place, detail`` for the rows of the given ``keys`` (distinct, typed, under the key's names).

    ``place`` is the file of a raw row, the reasons of a quarantined one, the name of a mart. Rows are looked up backwards
    from the keys, so nothing has to be carried through the marts; the keys are broadcast if measured to be small.
    """
    key = list(contract.key)
    hint = F.broadcast if fits_broadcast(keys, limits) else (lambda frame: frame)
    wanted, prefix = hint(renamed(keys.select(*key), key, "_wanted_")), "_key_"
    sources = [c.source for c in contract.columns]

    def of(rows: DataFrame, names: list[str]) -> DataFrame:
        typed_keys = rows.withColumnsRenamed({prefix + k: k for k in key}) if names[0].startswith(prefix) else rows
        return typed_keys.join(wanted, same_key(key, "_wanted_"), "left_semi")

    def text(rows: DataFrame, layer: str, place: Column, columns: Sequence[str]) -> DataFrame:
        return rows.select(*key, F.lit(layer).alias("layer"), place.alias("place"), _shown(columns).alias("detail"))

    def originals(rows: DataFrame, extra: str) -> DataFrame:
        # Only the key is typed; a source column of the same name gives way to it.
        keyed = with_key_values(rows, contract, prefix)
        kept = [F.col(f"`{c}`").alias(f"_text_{c}") for c in sources]
        return of(keyed.select(*[prefix + k for k in key], *kept, extra), [prefix + k for k in key])

    hits = of(trusted, key)
    found = [
        text(originals(raw, SOURCE_FILE), LAYERS[0], F.col(SOURCE_FILE), [f"_text_{c}" for c in sources]),
        text(hits, LAYERS[1], F.lit(""), contract.names),
        text(originals(rejected, REASONS), LAYERS[2], F.col(REASONS), [f"_text_{c}" for c in sources]),
    ]
    for name, trail in trails.items():
        # A mart may be grouped by columns that are named like the key.
        groups = hits.select(
            *[F.col(k).alias(prefix + k) for k in key], *[c.alias(f"_group_{g}") for g, c in trail.groups.items()]
        ).distinct()
        rows = trail.mart.select(*trail.groups, _shown(trail.shown).alias("detail"))
        joined = rows.join(hint(groups), same_key(list(trail.groups), "_group_"))
        named = [F.col(prefix + k).alias(k) for k in key]
        found.append(joined.select(*named, F.lit(LAYERS[3]).alias("layer"), F.lit(name).alias("place"), "detail"))
    return union_all(found)
