"""Quality from compression: how much better a text packs beside good examples than beside bad ones.

Two zstandard dictionaries are built, one from texts labelled good, one from texts labelled bad. A text is cut at
spaces into pieces of about ``PIECE`` bytes, each compressed with either dictionary, so that the dictionary and
not the text's own beginning is what a piece finds its phrases in. The evidence is the compressed size beside the
bad dictionary less that beside the good one, over all pieces, per byte of text. A logistic curve, fitted on
labelled documents that the dictionaries have not seen, turns it into the probability of label 1.

What is learned from is bounded: at most ``LABELS`` labelled ids a class (the smallest by hash), of which a quarter
fits the curve and the others give about ``SAMPLE_BYTES`` of pieces a class, thinned by a hash of id and piece over whole
texts. Both dictionaries together have at most 2 * ``DICTIONARY`` bytes; they are all that is broadcast. Scoring is one
pass over the rows, without a shuffle.

Defined results: NULL and empty texts have evidence 0 and get the curve's value there. Labels count outside the
held-out fold only; NULL labels and ids teach nothing, and of repeated labels of an id the greatest counts.
Without labels of both classes every score is the share of good labels (0 without any). Repeated rows are scored one
by one; other columns of ``docs`` are left alone.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.common import chunks, held_out, schema_of
from sluiceworks.llm.toxicity import _logistic

PIECE = 2048
LEVEL = 3
DICTIONARY = 256 * 1024
LABELS = 20_000  # labelled ids a class that are learned from
SAMPLE_BYTES = 4 << 20  # about so many bytes of pieces a class go into a dictionary
CUT = 0.7
# Segment and match lengths of the dictionary builder.
_SEGMENT, _MATCH = 64, 8


def pieces(text: bytes, size: int = PIECE) -> Iterator[bytes]:
    """Consecutive parts of at most ``size`` bytes, cut after a space where the second half of one has any."""
    start = 0
    while start < len(text):
        end = min(len(text), start + size)
        if end < len(text):
            end = text.rfind(b" ", start + size // 2, end) + 1 or end
        yield text[start:end]
        start = end


def dictionary(samples: list[bytes], size: int = DICTIONARY) -> bytes:
    """A dictionary of at most ``size`` bytes; samples too few to build one from are taken as they are."""
    try:
        return zstandard.train_dictionary(size, samples, k=_SEGMENT, d=_MATCH).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(samples)[-size:]


class Pair:
    """Compressors beside the bad and the good dictionary."""

    def __init__(self, bad: bytes, good: bytes):
        self._both = [self._compressor(d) for d in (bad, good)]

    @staticmethod
    def _compressor(content: bytes) -> zstandard.ZstdCompressor:
        bare = dict(level=LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
        if not content:
            return zstandard.ZstdCompressor(**bare)
        beside = zstandard.ZstdCompressionDict(content)
        beside.precompute_compress(level=LEVEL)
        return zstandard.ZstdCompressor(dict_data=beside, **bare)

    def evidence(self, text: bytes) -> float:
        """Bytes that the good dictionary saves against the bad one, per byte of text."""
        bad, good = self._both
        saved = sum(len(bad.compress(p)) - len(good.compress(p)) for p in pieces(text))
        return saved / len(text) if text else 0.0


@dataclass(frozen=True)
class Model:
    bad: bytes
    good: bytes
    slope: float
    offset: float


def _flat(base: float) -> Model:
    base = min(max(base, 1e-6), 1 - 1e-6)
    return Model(b"", b"", 0.0, float(np.log(base / (1 - base))))


def evidence(docs: DataFrame, bad: bytes, good: bytes) -> DataFrame:
    """``docs`` with ``evidence`` in place of ``text``."""
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(*others, "text")
    shared = docs.sparkSession.sparkContext.broadcast((bad, good))

    def run(batches):
        both = Pair(*shared.value)
        for batch in batches:
            for part, texts in chunks(batch, len(others)):
                found = [both.evidence(t) for t in texts.cast(pa.large_binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found, pa.float64())], names=[*others, "evidence"])

    return rows.mapInArrow(run, schema_of(rows, "evidence double", *others))


def _samples(rows: DataFrame, share: dict[int, float]) -> dict[int, list[bytes]]:
    """Pieces of ``doc_id, label, text``, thinned by a hash of id and place to the ``share`` of each class."""

    def run(batches):
        for batch in batches:
            for part, texts in chunks(batch, 2):
                label, piece = [], []
                ids, labels = part.column(0).to_pylist(), part.column(1).to_pylist()
                for key, own, text in zip(ids, labels, texts.cast(pa.large_binary()).to_pylist(), strict=True):
                    for k, one in enumerate(pieces(text)):
                        if zlib.crc32(f"{key}/{k}".encode()) < share[own] * 2**32:
                            label.append(own)
                            piece.append(one)
                yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(piece, pa.binary())], names=["label", "piece"])

    out: dict[int, list[bytes]] = {0: [], 1: []}
    for row in rows.select("doc_id", "label", "text").mapInArrow(run, "label int, piece binary").sort("label", "piece").collect():
        out[row["label"]].append(bytes(row["piece"]))
    return out


def fit(docs: DataFrame, labels: DataFrame, label: str, learn: Column, ids: int = LABELS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Dictionaries and curve from the labelled documents that ``learn`` (a condition on ``doc_id``) allows."""
    known = (
        labels.select("doc_id", F.col(label).alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isin(0, 1) & learn)
        .groupBy("doc_id").agg(F.max("label").cast("int").alias("label"))
        .withColumn("_draw", F.xxhash64("doc_id"))
    )
    counted = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(counted) < 2:
        return _flat(float(1 in counted))
    # At most 2 * ids rows: a sort that keeps the first ones of every task, then the first of all.
    few = [known.filter(F.col("label") == c).orderBy("_draw", "doc_id").limit(ids) for c in (0, 1)]
    rows = docs.select("doc_id", "text").join(F.broadcast(few[0].unionByName(few[1])), "doc_id")
    teaching, fitting = (rows.filter(c) for c in (F.pmod("_draw", F.lit(4)) > 0, F.pmod("_draw", F.lit(4)) == 0))
    octets = teaching.groupBy("label").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    share = {0: 0.0, 1: 0.0} | {r["label"]: min(1.0, sample_bytes / r["n"]) if r["n"] else 0.0 for r in octets}
    samples = _samples(teaching, share)
    if not samples[0] or not samples[1]:
        return _flat(counted[1] / (counted[0] + counted[1]))
    bad, good = dictionary(samples[0]), dictionary(samples[1])
    found = evidence(fitting.select("label", "text"), bad, good).toPandas()
    y, x = found["label"].to_numpy(float), found["evidence"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return _flat(counted[1] / (counted[0] + counted[1]))
    return Model(bad, good, *_logistic(x, y))


def apply(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``evidence`` and ``score`` in place of ``text``."""
    found = evidence(docs, model.bad, model.good)
    return found.withColumn("score", 1 / (1 + F.exp(-(F.lit(model.slope) * F.col("evidence") + F.lit(model.offset)))))


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, evidence of every document; fold 2 of 4 teaches nothing."""
    out = held_out("doc_id", 4, 2)
    model = fit(docs, labels, "quality", ~out)
    return apply(docs.select("doc_id", "text"), model).select(
        "doc_id", out.alias("held_out"), "score", (F.col("score") >= CUT).cast("int").alias("predicted"), "evidence"
    )
