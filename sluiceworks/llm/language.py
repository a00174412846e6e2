"""Language identification: multinomial naive Bayes over hashed character n-grams.

``fit`` counts hashed 1- to 3-grams of lower-cased letters per language on Spark and turns them into
matrices of log probabilities (up to ``BLOCK`` languages x buckets each, so bounded by their shape). ``predict`` broadcasts one
and scores batches of documents in numpy: gather the column of every n-gram, add up per document. More than ``BLOCK``
languages are scored in rounds, each on the stored result of the one before.

Defined results: NULL text and text without a letter give ``und`` with score 0; so does everything
when nothing could be learned. Rows with NULL ``lang`` teach nothing. Rows with NULL ``doc_id`` are in
fold 0. Equal rows give equal results; equal scores go to the language that sorts first. Extra columns
are ignored.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.common import chunks, free, held_out, schema_of, store, texts_of

BITS = 16
SIZES = (1, 2, 3)
# The classifier is fitted on about this many documents of each language, chosen by hash.
TRAIN_DOCS = 20_000
BLOCK = 256  # languages a matrix
ALPHA = 0.1
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    prior: np.ndarray  # log, per language
    likelihood: np.ndarray  # log, languages x buckets, float32


@functools.lru_cache(maxsize=2)
def _letters(digits: bool) -> np.ndarray:
    return np.array([chr(c).isalnum() if digits else chr(c).isalpha() for c in range(0x110000)])


def letter_codes(texts: list[str], digits: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points of the lower-cased texts, each between two spaces, with all but letters (and digits, if
    asked for) as spaces; which are letters; where each text ends."""
    lowered = [f" {t.lower()} " for t in texts]
    ends = np.cumsum([len(t) for t in lowered], dtype=np.int64)
    codes = np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), "<u4").copy()
    letter = _letters(digits)[codes]
    codes[~letter] = 0x20
    return codes, letter, ends


def _grams(texts: list[str], bits: int):
    """For each n-gram size: bucket and starting place of the n-grams; and the ends of the texts."""
    codes, letter, ends = letter_codes(texts)
    for size in SIZES:
        n = len(codes) - size + 1
        if n <= 0:
            continue
        mixed = np.full(n, size * 0x165667B1 & 0xFFFFFFFF, np.uint32)
        used = letter[:n].copy()
        if size > 1:
            used |= letter[1 : n + 1]
        for k in range(size):
            mixed += codes[k : k + n] * _FACTORS[k]
            mixed ^= mixed >> np.uint32(15)
            mixed *= np.uint32(0x2C1B3C6D)
        at = np.flatnonzero(used)
        yield (mixed[at] >> np.uint32(32 - bits)), at, ends


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _counter(bits: int):
    def count(batches):
        totals: dict[str, np.ndarray] = {}
        for batch in batches:
            for part, texts in chunks(batch, 1):
                langs = np.array(part.column(0).to_pylist(), object)
                order = np.argsort(langs.astype(str), kind="stable")
                values = texts.to_pylist()
                values, langs = [values[i] for i in order], langs[order]
                cuts = np.flatnonzero(np.r_[True, langs[1:] != langs[:-1]])
                for a, b in zip(cuts, np.r_[cuts[1:], len(langs)], strict=True):
                    total = totals.setdefault(langs[a], np.zeros(1 << bits, np.int64))
                    for bucket, _, _ in _grams(values[a:b], bits):
                        total += np.bincount(bucket, minlength=1 << bits)
        for lang, total in totals.items():
            at = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(total[at])],
                names=["lang", "bucket", "n"],
            )

    return count


def fit(docs: DataFrame, bits: int = BITS, train_docs: int = TRAIN_DOCS, block: int = BLOCK) -> list[Model]:
    """One model for every ``block`` languages, in the order of their names; learns from ``text`` and ``lang`` of the rows that are not held out.

    ``train_docs`` bounds the labelled rows used per language: a language with more is thinned by a hash
    of id and length to about that many. Everything else, the prior included, counts all labelled rows.
    """
    spark = docs.sparkSession
    labelled = docs.select("doc_id", "text", "lang").filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out())
    sizes = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    names = sorted(sizes)
    if not names:
        return [Model((), np.zeros(0), np.zeros((0, 1 << bits), np.float32))]
    drawn = F.pmod(F.xxhash64("doc_id", F.length("text")), F.lit(1 << 20)) / F.lit(float(1 << 20))
    out = []
    for start in range(0, len(names), block):
        languages = tuple(names[start : start + block])
        shares = spark.createDataFrame([(k, min(1.0, train_docs / sizes[k])) for k in languages], "lang string, share double")
        sample = labelled.join(F.broadcast(shares), "lang").filter(drawn < F.col("share")).select("lang", "text")
        counted = sample.mapInArrow(_counter(bits), "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        found = counted.toArrow()
        counts = np.full((len(languages), 1 << bits), ALPHA)
        place = pc.index_in(found.column("lang"), pa.array(languages, pa.string()))
        np.add.at(counts, tuple(np.asarray(c.combine_chunks()) for c in (place, found.column("bucket"))), np.asarray(found.column("n")))
        prior = np.log(np.array([sizes[lang] for lang in languages], float) / sum(sizes.values()))
        out.append(Model(languages, prior, np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)))
    return out


def score_texts(texts: list[str], model: Model) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Per text: the model's best language, its log-likelihood, what all of the model's languages weigh against it in a tempered
    posterior, and the temperature."""
    if not model.languages or not texts:
        return ["und"] * len(texts), np.full(len(texts), -np.inf), np.full(len(texts), np.inf), np.ones(len(texts))
    bits = int(model.likelihood.shape[1]).bit_length() - 1
    total = np.zeros((len(model.languages), len(texts)))
    grams = np.zeros(len(texts))
    for bucket, at, ends in _grams(texts, bits):
        cuts = np.searchsorted(at, np.r_[0, ends])
        grams += np.diff(cuts)
        for k, row in enumerate(model.likelihood):
            running = np.r_[0.0, np.cumsum(row[bucket], dtype=np.float64)]
            total[k] += running[cuts[1:]] - running[cuts[:-1]]
    total += model.prior[:, None]
    best = total.argmax(axis=0)
    heat = np.maximum(1.0, grams / 100)
    top = total.max(axis=0)
    mass = np.exp((total - top) / heat).sum(axis=0)
    known = np.array([has_letter(t) for t in texts])
    names = [model.languages[b] if ok else "und" for b, ok in zip(best, known, strict=True)]
    return names, top, np.where(known, mass, np.inf), heat


def predict(docs: DataFrame, models: list[Model], lang: str = "_lang_pred", score: str = "_lang_score") -> DataFrame:
    """``docs`` columns kept, plus ``lang`` and ``score``."""
    names = [c for c in docs.columns if c not in (lang, score)]
    rows, top = docs.select(*names), free("_lang_top", docs)
    text = names.index("text")
    for number, model in enumerate(models):
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(batches, shared=shared, first=number == 0):
            for batch in batches:
                for part, texts in chunks(batch, text):
                    pred, best, mass, heat = score_texts(texts_of(texts).to_pylist(), shared.value)
                    own = part.columns[: len(names)]
                    if not first:  # with what the rounds before found; equal ones stay with the earlier name
                        known, weight, before = (part.column(len(names) + k) for k in range(3))
                        before, weight = before.to_numpy(), 1 / np.maximum(weight.to_numpy(), 1e-300)
                        weight = np.where(np.asarray(part.column(len(names) + 1)) > 0, weight, np.inf)
                        better = best > before
                        pred = [new if b else old for new, old, b in zip(pred, known.to_pylist(), better, strict=True)]
                        high = np.maximum(best, before)
                        mass = mass * np.exp((best - high) / heat) + weight * np.exp((before - high) / heat)
                        best = high
                    yield pa.RecordBatch.from_arrays(
                        [*own, pa.array(pred, pa.string()), pa.array(1 / mass), pa.array(best)], names=[*names, lang, score, top]
                    )

        rows = rows.mapInArrow(run, schema_of(rows.select(*names), f"`{lang}` string, `{score}` double, `{top}` double"))
        if number + 1 < len(models):
            rows = store(rows, "languages")
    return rows.drop(top)


def identify(docs: DataFrame, train: DataFrame | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learns from ``train`` (default: docs)."""
    rows = docs.select("doc_id", "text")
    scored = predict(rows, fit(docs if train is None else train))
    return scored.select(
        "doc_id", held_out().alias("held_out"), F.col("_lang_pred").alias("lang_pred"), F.col("_lang_score").alias("score")
    )


MIN_SCORE = 0.5


def accepted(docs: DataFrame, min_score: float = MIN_SCORE) -> DataFrame:
    """Documents with a letter whose language is predicted with a score of ``min_score`` or more."""
    lang, score = free("_lang_pred", docs), free("_lang_score", docs)
    scored = predict(docs, fit(docs), lang, score)
    return scored.filter((F.col(lang) != "und") & (F.col(score) >= min_score)).select(*docs.columns)
