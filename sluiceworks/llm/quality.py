r"""Quality rules with adaptive thresholds per language and source.

``measure`` takes word statistics of whole texts. ``sketch`` turns the documents that pass the base
rules into quantile sketches with logarithmic buckets, one per language, source and metric; a sketch is
a set of (bucket, count) rows, so merging is adding counts and partial aggregation does it before the
shuffle. ``fences`` reads quartiles off the sketches and sets each threshold three spreads away from
them. A group with fewer than ``MIN_DOCS`` documents takes the merged sketch of its language, a small
language that of all documents. ``judge`` joins the fences to the documents.

Defined results: NULL and empty texts have no words and fail the base rules. NULL languages and sources
are groups of their own. Repeated rows are measured and judged one by one. A metric at a fence passes.
Extra columns are ignored.
"""

from __future__ import annotations

import math
import string

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from sluiceworks.llm.common import buffers_of, chunks, spread_join, store
from sluiceworks.llm.words import IS_SPACE, Words, windows

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MIN_DOCS = 50
GAMMA = 1.02  # quantiles are right to one percent of their value
SPREADS = 3.0
ZERO = -1_000_000  # the bucket of value 0
# Metric: the least spread it is taken to have, and whether it is fenced below too.
METRICS = {
    "symbols_per_word": (0.05, False),
    "punctuation_per_word": (0.10, False),
    "upper_share": (0.03, False),
    "dup_line_share": (0.08, False),
    "repeat_share": (0.07, False),
    "chars_per_word": (0.50, True),
}
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_punctuation", "n_upper")


def _marks(characters: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(characters.encode())] = True
    return out


_SYMBOL = _marks("#*$%&|<>")
_PUNCTUATION = _marks(string.punctuation)
_UPPER = _marks(string.ascii_uppercase)
_BLANK = " \t\n\r\x0b\x0c"


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    running = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=running[1:])
    return running[offsets[1:]] - running[offsets[:-1]]


def repeated_words(words: Words, width: int = WINDOW) -> np.ndarray:
    """Per text, the words inside a run of ``width`` words that the text has twice or more."""
    marks = np.zeros(len(words.starts) + 1, np.int64)
    found, at = windows(words.hashes(), words.doc, width)
    if len(found):
        found ^= (words.doc[at].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        order = np.argsort(found)
        same = found[order][1:] == found[order][:-1]
        twice = at[order[np.r_[False, same] | np.r_[same, False]]]
        np.add.at(marks, twice, 1)
        np.add.at(marks, twice + width, -1)
    covered = np.cumsum(marks[:-1]) > 0
    return np.bincount(words.doc[covered], minlength=len(words.counts))


def text_counts(texts: pa.Array) -> dict[str, np.ndarray]:
    words = Words(texts)
    data, offsets = buffers_of(texts)
    lines, repeats = [], []
    for text in texts.to_pylist():
        used = [line for line in text.split("\n") if line.strip(_BLANK)]
        lines.append(len(used))
        repeats.append(len(used) - len(set(used)))
    return {
        "n_words": words.counts,
        "word_chars": _per_text(~IS_SPACE[data] & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_text(_SYMBOL[data], offsets),
        "n_dup_lines": np.array(repeats, np.int64),
        "n_repeat_words": repeated_words(words),
        "n_lines": np.array(lines, np.int64),
        "n_punctuation": _per_text(_PUNCTUATION[data], offsets),
        "n_upper": _per_text(_UPPER[data], offsets),
    }


def measure(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, the counts, ``base_failed`` and the metrics (0 where a text has no words)."""

    def run(batches):
        for batch in batches:
            for part, texts in chunks(batch, 3):
                found = text_counts(texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], *(pa.array(found[c], pa.int64()) for c in COUNTS)], names=["doc_id", "lang", "source", *COUNTS]
                )

    rows = docs.select("doc_id", "lang", "source", "text")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:3])
    counted = rows.mapInArrow(run, f"{fields}, " + ", ".join(f"{c} long" for c in COUNTS))

    def share(part: str, whole: str) -> Column:
        return F.coalesce(F.try_divide(F.col(part), F.col(whole)).cast("double"), F.lit(0.0))

    return counted.withColumns(
        {
            "base_failed": (F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
            "symbols_per_word": share("n_symbols", "n_words"),
            "punctuation_per_word": share("n_punctuation", "n_words"),
            "upper_share": share("n_upper", "word_chars"),
            "dup_line_share": share("n_dup_lines", "n_lines"),
            "repeat_share": share("n_repeat_words", "n_words"),
            "chars_per_word": share("word_chars", "n_words"),
        }
    )


def sketch(measured: DataFrame) -> DataFrame:
    """``lang, source, metric, bucket, n``: the quantile sketches of the documents that pass the base rules."""
    # Counting whole tuples of buckets first would not shrink anything, so metrics are unpivoted at once.
    value = F.col("value")
    bucket = F.when(value > 0, F.ceil(F.log(value) / F.lit(math.log(GAMMA)))).otherwise(F.lit(ZERO)).cast("int")
    return (
        measured.filter(~F.col("base_failed"))
        .unpivot(["lang", "source"], list(METRICS), "metric", "value")
        .groupBy("lang", "source", "metric", bucket.alias("bucket"))
        .agg(F.count("*").alias("n"))
    )


def merge(sketches: DataFrame, *by: str) -> DataFrame:
    return sketches.groupBy(*by, "metric", "bucket").agg(F.sum("n").alias("n"))


def fences(sketches: DataFrame, *by: str) -> DataFrame:
    """Per group and metric: ``docs`` in the sketch, ``low`` and ``high``."""
    group = Window.partitionBy(*by, "metric")
    counted = sketches.withColumns(
        {
            "total": F.sum("n").over(group),
            "upto": F.sum("n").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)),
            "value": F.when(F.col("bucket") == ZERO, 0.0).otherwise(2 * F.pow(F.lit(GAMMA), F.col("bucket")) / (GAMMA + 1)),
        }
    )
    read = counted.groupBy(*by, "metric").agg(
        F.max("total").alias("docs"),
        F.min(F.when(4 * F.col("upto") >= F.col("total"), F.col("value"))).alias("q1"),
        F.min(F.when(4 * F.col("upto") >= 3 * F.col("total"), F.col("value"))).alias("q3"),
    )
    least = F.create_map(*(F.lit(x) for m, (s, _) in METRICS.items() for x in (m, s)))[F.col("metric")]
    below = F.col("metric").isin([m for m, (_, two_sided) in METRICS.items() if two_sided])
    spread = SPREADS * F.greatest(F.col("q3") - F.col("q1"), least)
    return read.select(
        *by, "metric", "docs",
        F.when(below, F.col("q1") - spread).otherwise(F.lit(float("-inf"))).alias("low"),
        (F.col("q3") + spread).alias("high"),
    )


def group_key(*by: str) -> Column:
    return F.to_json(F.struct(*by))


def _wide(limits: DataFrame, *by: str) -> DataFrame:
    """One row per group: a map from metric to its fences."""
    return limits.groupBy(*by).agg(
        F.max("docs").alias("docs"), F.map_from_entries(F.collect_list(F.struct("metric", F.struct("low", "high")))).alias("limits")
    )


def thresholds(sketches: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``key`` (language and source), ``docs`` and ``limits`` in force for it."""
    own = _wide(fences(sketches, "lang", "source"), "lang", "source")
    by_lang = _wide(fences(merge(sketches, "lang"), "lang"), "lang").select(
        F.col("lang").alias("_lang"), F.col("docs").alias("lang_docs"), F.col("limits").alias("lang_limits")
    )
    # The fences of all documents together are one row per metric, so they become a literal.
    overall = {r["metric"]: (r["low"], r["high"]) for r in fences(merge(sketches)).collect()}
    fallback = F.create_map(
        *(x for m in METRICS for low, high in [overall.get(m, (float("-inf"), float("inf")))]
          for x in (F.lit(m), F.struct(F.lit(low).alias("low"), F.lit(high).alias("high"))))
    )
    joined = own.join(by_lang, F.col("lang").eqNullSafe(F.col("_lang")))
    return joined.select(
        group_key("lang", "source").alias("key"), "docs",
        F.when(F.col("docs") >= min_docs, F.col("limits"))
        .when(F.col("lang_docs") >= min_docs, F.col("lang_limits"))
        .otherwise(fallback).alias("limits"),
    )


def judge(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The measured documents with ``kept`` and ``reasons`` (the metrics outside their fences)."""
    measured = store(measure(docs).withColumn("key", group_key("lang", "source")), "quality")
    limits = store(thresholds(store(sketch(measured), "quality-sketch"), min_docs), "quality-limits")
    outside = [
        F.when((F.col(m) < F.col("limits")[m]["low"]) | (F.col(m) > F.col("limits")[m]["high"]), F.lit(m)) for m in METRICS
    ]
    # Groups without a document that passes the base rules have no fences, and need none.
    judged = spread_join(measured, limits, "key", "docs", "doc_id", "left").withColumn("reasons", F.concat_ws(",", *outside))
    return judged.withColumn("kept", ~F.col("base_failed") & (F.col("reasons") == ""))


def report(docs: DataFrame) -> DataFrame:
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "reasons"
    )
