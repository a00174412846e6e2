"""Helpers shared by the operators: stored intermediates, arrow batches, crc folds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType, StructType

from sluiceworks.session import workspace

# Text handed to numpy at once; temporaries are some thirty times as large.
CHUNK_BYTES = 1 << 20
# Most that is broadcast of a table that was counted small.
BROADCAST_BYTES = 64 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def store(df: DataFrame, label: str) -> DataFrame:
    """Writes ``df`` to the shared folder and reads it back: lineage ends here, rows keep their ids."""
    spark = df.sparkSession
    path = workspace(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free(name: str, *frames: DataFrame) -> str:
    """``name``, with as many underscores before it as it takes to be no column of the frames."""
    taken = {c.lower() for f in frames for c in f.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def schema_of(df: DataFrame, more: str, *names: str) -> StructType:
    """The fields ``names`` of ``df`` (default: all) followed by those of the DDL text ``more``."""
    own = [df.schema[n] for n in names] if names else df.schema.fields
    return StructType([*own, *StructType.fromDDL(more).fields])


def fold(key: str = "doc_id", folds: int = 3) -> Column:
    """crc32 of the key as text, modulo ``folds``. A NULL key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def held_out(key: str = "doc_id", folds: int = 3, out: int = 1) -> Column:
    """Whether the key's fold is the one that nothing is learned from."""
    return fold(key, folds) == out


def _octets(frame: DataFrame) -> Column:
    """Size of a row: 8 bytes a column, and the content of texts and binaries."""
    long = [f.name for f in frame.schema if isinstance(f.dataType, StringType | BinaryType)]
    return sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in long), F.lit(8 * len(frame.columns))).cast("long")


def spread_join(rows: DataFrame, keyed: DataFrame, key: str, weight: str, by: str, how: str = "inner",
                share: int = 4096, small: int = 400_000) -> DataFrame:
    """Joins ``rows`` with the stored table ``keyed`` (one row per key; ``weight``: rows per key).

    A ``keyed`` of at most ``small`` rows and ``BROADCAST_BYTES`` is broadcast. Otherwise both sides are shuffled on the key, and a
    key with more than one ``share``-th of all rows is cut into parts by a hash of the column ``by``. There
    are fewer than ``share`` such keys whatever the data, so their list is broadcast. ``how``: inner, left or
    left_semi.
    """
    size = keyed.agg(F.count("*").alias("n"), F.sum(weight).alias("total"), F.sum(_octets(keyed)).alias("octets")).first()
    if size["n"] <= small and (size["octets"] or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(keyed), key, how)
    parts = F.ceil(F.col(weight) * share / F.lit(size["total"])).cast("int")
    hot = keyed.select(F.col(key).alias("_hot"), parts.alias("_parts")).filter("_parts > 1")
    salted = rows.join(F.broadcast(hot), rows[key] == hot["_hot"], "left").withColumn(
        "_salt", F.coalesce(F.pmod(F.xxhash64(by), F.col("_parts")), F.lit(0)).cast("int")
    )
    copies = keyed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    return salted.drop("_hot", "_parts").join(copies, [key, "_salt"], how).drop("_salt")


def texts_of(column: pa.Array) -> pa.Array:
    """A string array with 64-bit offsets and no NULLs (NULL becomes empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def buffers_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and row offsets (first 0) of a large_string array, without copying."""
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if not len(texts) or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def chunks(batch: pa.RecordBatch, text: int, limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    """Slices of a batch whose texts have about ``limit`` bytes (one row at least), with the texts."""
    texts = texts_of(batch.column(text))
    _, offsets = buffers_of(texts)
    start, n = 0, len(texts)
    while start < n:
        end = max(start + 1, int(np.searchsorted(offsets, offsets[start] + limit, "right")) - 1)
        yield batch.slice(start, end - start), texts.slice(start, end - start)
        start = end


def fmix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3, in place."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h
