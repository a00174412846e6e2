r"""Toxicity from class-conditional Kneser-Ney models of character n-grams.

Texts are lower-cased words of letters and digits. The ``ORDER``-grams of characters inside words are counted per
class (toxic, ordinary) over all labelled documents that may be learned from. Each class has an interpolated
Kneser-Ney model

    p(x | h) = (max(n(hx) - D, 0) + D * T(h) * shared(x | h')) / n(h)

whose lower orders are shared: continuation counts of both classes together, smoothed down to a uniform
distribution. So a rare expression is judged by its class only as far as its own counts go and
otherwise by what both classes have in common. Where an n-gram is new and its context is not, the shared counts
cancel out and the difference is that of the two backoff weights, ``D * T(h) / n(h)`` (1 in a class that has not seen the
context). Where the toxic class has not seen the context, both models use the shared counts and the difference is 0. The difference of the two log-likelihoods is added up per word. Classes
also differ a little in languages and styles, which tilts every word, so what counts is the part of a word's
difference beyond ``MARGIN``. Its mean over the words of a text is the length-normalised evidence, turned into a
probability by a logistic curve fitted on labelled documents that the models have not seen.

Counts, continuation counts and models are Spark aggregations. The table of log-likelihood ratios is broadcast
if it has at most ``BROADCAST_GRAMS`` rows of n-grams and contexts (12 bytes each); a larger one is joined by shuffle.

Defined results: NULL and empty texts and texts without a word have no evidence. Labels are used for
rows outside fold 1 only; NULL labels teach nothing, and of repeated labels the greatest counts. Without labels
of both classes every score is the share of toxic labels (0 without any). Repeated rows are scored one by one.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.common import chunks, fmix, held_out, schema_of, store
from sluiceworks.llm.language import letter_codes

ORDER = 8
MARGIN = 3.5  # nats by which a word must speak for toxic to count; least mean log loss on calibration rows of two table sizes
FLOOR = 0.005  # evidence per word that is as good as none
DISCOUNT = 0.75
BROADCAST_GRAMS = 4_000_000
CALIBRATION_ROWS = 20_000  # the logistic curve is fitted on about this many labelled rows
CUT = 0.7


# ---------------------------------------------------------------- n-grams


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the words of all texts, each word after ``ORDER - 1`` spaces, and where each text ends.

    So no n-gram reaches over a word's beginning, and a word's first characters have a context of their own.
    """
    codes, letter, ends = letter_codes(texts, digits=True)
    keep = letter.copy()
    keep[1:] |= letter[:-1]  # the character after a word is the space between words
    keep[np.r_[0, ends[:-1]]] = True  # and so is the first of a text
    times = np.where(keep, np.where(letter, 1, ORDER - 1), 0)
    return np.repeat(codes, times), np.cumsum(times)[ends - 1]


def _hashes(codes: np.ndarray, size: int = ORDER) -> np.ndarray:
    """Of the ``size``-grams that begin at each place."""
    n = len(codes) - size + 1
    out = np.zeros(max(n, 0), np.uint64)
    wide = codes.astype(np.uint64)
    for k in range(size if n > 0 else 0):
        out *= np.uint64(0x100000001B3)
        out += wide[k : k + n]
    return fmix(out)


def _places(codes: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where n-grams begin that lie in one text and end in a word or on the space after one; their texts."""
    n = max(0, len(codes) - ORDER + 1)
    letter = codes != 0x20
    last = letter[ORDER - 1 :] | letter[ORDER - 2 : -1] if n else np.zeros(0, bool)
    at = np.flatnonzero(last)
    text = np.searchsorted(ends, at, "right")
    inside = at + ORDER <= ends[text] if len(at) else np.zeros(0, bool)
    return at[inside], text[inside]


def gram_hash(grams: list[str]) -> np.ndarray:
    """Hashes of n-grams and of contexts, which are one character shorter."""
    out = np.zeros(len(grams), np.uint64)
    lengths = np.array([len(g) for g in grams], np.int64)
    for size in (ORDER, ORDER - 1):
        at = np.flatnonzero(lengths == size)
        codes = np.frombuffer("".join(grams[i] for i in at).encode("utf-32-le", "surrogatepass"), "<u4")
        out[at] = _hashes(codes, size)[::size]
    return out


def _merge(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, codes, counts = (np.concatenate(x) for x in zip(*parts, strict=True))
    _, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
    total = np.stack([np.bincount(inverse, counts[:, c], len(first)).astype(np.int64) for c in (0, 1)], axis=1)
    return keys[first], codes[first], total


def count_grams(labelled: DataFrame) -> DataFrame:
    """Stored ``gram, n_ord, n_tox`` over ``text, toxic``."""

    def run(batches):
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def emit(found):
            _, codes, counts = found
            grams = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
            grams = [grams[i : i + ORDER] for i in range(0, len(grams), ORDER)]
            return pa.RecordBatch.from_arrays(
                [pa.array(grams, pa.string()), pa.array(counts[:, 0]), pa.array(counts[:, 1])], names=["gram", "n_ord", "n_tox"]
            )

        for batch in batches:
            for part, texts in chunks(batch, 0):
                toxic = np.asarray(part.column(1)).astype(np.int64)
                codes, ends = _codes(texts.to_pylist())
                at, text = _places(codes, ends)
                if not len(at):
                    continue
                keys, first, inverse = np.unique(_hashes(codes)[at], return_index=True, return_inverse=True)
                side = toxic[text]
                counts = np.stack([np.bincount(inverse[side == c], minlength=len(keys)) for c in (0, 1)], axis=1)
                parts.append((keys, codes[at[first][:, None] + np.arange(ORDER)], counts))
                if len(parts) == 8:
                    parts = [_merge(parts)]
                if len(parts[0][0]) > 1_000_000:
                    yield emit(_merge(parts))
                    parts = []
        if parts:
            yield emit(_merge(parts))

    counted = labelled.select("text", "toxic").mapInArrow(run, "gram string, n_ord long, n_tox long")
    return store(counted.groupBy("gram").agg(F.sum("n_ord").alias("n_ord"), F.sum("n_tox").alias("n_tox")), "grams")


def shared_orders(grams: DataFrame) -> DataFrame:
    """``gram, p`` for all grams one shorter: Kneser-Ney on continuation counts of both classes together."""
    levels = []
    longer = grams.select("gram")
    for size in range(ORDER - 1, 0, -1):
        level = store(longer.groupBy(F.right("gram", F.lit(size)).alias("gram")).agg(F.count("*").alias("c")), "continuations")
        levels.append(level)
        longer = level.select("gram")
    p = None
    for size, level in enumerate(reversed(levels), 1):
        contexts = level.groupBy(F.left("gram", F.lit(size - 1)).alias("h")).agg(F.sum("c").alias("s"), F.count("*").alias("t"))
        own = level.select("gram", "c", F.left("gram", F.lit(size - 1)).alias("h"), F.right("gram", F.lit(size - 1)).alias("lower")).join(contexts, "h")
        if p is None:
            lower = own.withColumn("q", 1 / F.greatest(F.col("t"), F.lit(1)))
        else:
            lower = own.join(p.select(F.col("gram").alias("lower"), F.col("p").alias("q")), "lower")
        value = (F.greatest(F.col("c") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col("t") * F.col("q")) / F.col("s")
        p = store(lower.select("gram", value.alias("p")), "shared")
    return p


def ratios(grams: DataFrame) -> DataFrame:
    """Stored ``gram, ratio``: log p(x | h, toxic) - log p(x | h, ordinary) of n-grams hx that were seen.

    A context h, one character shorter, is there too, with the ratio of every hx that was not seen.
    """
    head, tail = F.left("gram", F.lit(ORDER - 1)), F.right("gram", F.lit(ORDER - 1))
    contexts = store(
        grams.groupBy(head.alias("h")).agg(
            F.sum("n_ord").alias("s_ord"), F.sum("n_tox").alias("s_tox"),
            F.count_if(F.col("n_ord") > 0).alias("t_ord"), F.count_if(F.col("n_tox") > 0).alias("t_tox"),
        ).filter("s_tox > 0"), "contexts",
    )
    joined = (
        grams.select("*", head.alias("h"), tail.alias("lower")).join(contexts, "h")
        .join(shared_orders(grams).select(F.col("gram").alias("lower"), "p"), "lower")
    )

    def log_p(side: str):
        mass = F.greatest(F.col(f"n_{side}") - DISCOUNT, F.lit(0.0)) + DISCOUNT * F.col(f"t_{side}") * F.col("p")
        return F.log(F.when(F.col(f"s_{side}") > 0, mass / F.col(f"s_{side}")).otherwise(F.col("p")))

    def log_backoff(side: str):
        weight = DISCOUNT * F.col(f"t_{side}") / F.col(f"s_{side}")
        return F.when(F.col(f"s_{side}") > 0, F.log(weight)).otherwise(0.0)

    seen = joined.select("gram", (log_p("tox") - log_p("ord")).alias("ratio"))
    unseen = contexts.select(F.col("h").alias("gram"), (log_backoff("tox") - log_backoff("ord")).alias("ratio"))
    return store(seen.unionByName(unseen), "ratios")


# ---------------------------------------------------------------- scores


@dataclass(frozen=True)
class Table:
    keys: np.ndarray  # sorted hashes
    values: np.ndarray

    @staticmethod
    def of(rows: DataFrame) -> Table:
        def hashed(batches):
            for batch in batches:
                keys = gram_hash(batch.column(0).to_pylist()).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column(1).cast(pa.float32())], names=["key", "ratio"])

        found = rows.select("gram", "ratio").mapInArrow(hashed, "key long, ratio float").toArrow()
        keys, values = (np.asarray(found.column(c).combine_chunks()) for c in ("key", "ratio"))
        keys = keys.view(np.uint64)
        order = np.argsort(keys)
        return Table(keys[order], values[order])

    def _look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.minimum(np.searchsorted(self.keys, hashes), len(self.keys) - 1)
        known = self.keys[place] == hashes
        return np.where(known, self.values[place], 0.0), known

    def evidence(self, texts: list[str]) -> np.ndarray:
        """Mean over the words of each text of what their log-likelihood differences exceed the margin by."""
        codes, ends = _codes(texts)
        at, text = _places(codes, ends)
        if not len(at) or not len(self.keys):
            return np.zeros(len(texts))
        value, known = self._look_up(_hashes(codes)[at])
        new = np.flatnonzero(~known)
        value[new] = self._look_up(_hashes(codes, ORDER - 1)[at[new]])[0]
        begins = np.flatnonzero(codes[at + ORDER - 2] == 0x20)  # the n-gram of a word's first character
        words = np.maximum(0, np.add.reduceat(value, begins) - MARGIN)
        text = text[begins]
        return np.bincount(text, words, len(texts)) / np.maximum(1, np.bincount(text, minlength=len(texts)))


def evidence(docs: DataFrame, table: DataFrame, limit: int = BROADCAST_GRAMS) -> DataFrame:
    """``docs`` with ``evidence`` in place of ``text``."""
    others = [c for c in docs.columns if c != "text"]
    rows = docs.select(*others, "text")
    if table.count() > limit:
        return _by_join(rows, table, others)
    shared = docs.sparkSession.sparkContext.broadcast(Table.of(table))

    def run(batches):
        for batch in batches:
            for part, texts in chunks(batch, len(others)):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(shared.value.evidence(texts.to_pylist()))], names=[*others, "evidence"]
                )

    return rows.mapInArrow(run, schema_of(rows, "evidence double", *others))


def _words(text: str) -> list[str]:
    codes, letter, _ = letter_codes([text], digits=True)
    return codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").split(" ")


def _by_join(rows: DataFrame, table: DataFrame, others: list[str]) -> DataFrame:
    """The same with the table shuffled: distinct words meet it n-gram by n-gram, rows meet the words that count."""
    numbered = store(rows.withColumn("_row", F.monotonically_increasing_id()), "scored-rows")

    def split(batches):
        for batch in batches:
            for part, texts in chunks(batch, 1):
                row, word, n = [], [], []
                for r, text in zip(part.column(0).to_pylist(), texts.to_pylist(), strict=True):
                    counts = Counter(_words(text))
                    counts.pop("", None)
                    row += [r] * len(counts)
                    word += counts.keys()
                    n += counts.values()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row, pa.int64()), pa.array(word, pa.string()), pa.array(n, pa.int64())], names=["_row", "word", "n"]
                )

    def spell(batches):
        for batch in batches:
            word, place, gram = [], [], []
            for w in batch.column(0).to_pylist():
                padded = " " * (ORDER - 1) + w + " "
                n = len(padded) - ORDER + 1
                for size in (ORDER, ORDER - 1):
                    gram += [padded[i : i + size] for i in range(n)]
                    place += range(n)
                    word += [w] * n
            yield pa.RecordBatch.from_arrays(
                [pa.array(word, pa.string()), pa.array(place, pa.int32()), pa.array(gram, pa.string())], names=["word", "place", "gram"]
            )

    words = numbered.select("_row", "text").mapInArrow(split, "_row long, word string, n long")
    spelled = words.select("word").distinct().mapInArrow(spell, "word string, place int, gram string")
    # Every word begins with one of a few n-grams, so each of those meets copies of its table row.
    parts = 64
    salted = spelled.withColumn("_part", F.pmod(F.xxhash64("word"), F.lit(parts)).cast("int"))
    copies = table.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    # At each place the n-gram counts if it is in the table, else its context. A word is as long as its own letters.
    placed = salted.join(copies, ["gram", "_part"]).repartition("word").groupBy("word", "place").agg(F.max_by("ratio", F.length("gram")).alias("ratio"))
    telling = placed.groupBy("word").agg((F.sum("ratio") - MARGIN).alias("beyond")).filter("beyond > 0")
    sizes = words.groupBy("_row").agg(F.sum("n").alias("words"))
    summed = words.join(telling, "word").groupBy("_row").agg(F.sum(F.col("n") * F.col("beyond")).alias("beyond"))
    found = numbered.drop("text").join(sizes, "_row", "left").join(summed, "_row", "left")
    return found.select(*others, F.coalesce(F.col("beyond") / F.col("words"), F.lit(0.0)).alias("evidence"))


@dataclass(frozen=True)
class Model:
    table: DataFrame
    slope: float
    offset: float


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a little shrinkage."""
    scale = float(x.std()) or 1.0
    design = np.c_[x / scale, np.ones(len(x))]
    beta = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - 0.01 * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return float(max(beta[0], 0.0) / scale), float(beta[1])


def fit(docs: DataFrame, labels: DataFrame, calibration_rows: int = CALIBRATION_ROWS, limit: int = BROADCAST_GRAMS) -> Model:
    """Learns from the labelled documents outside fold 1; a quarter of them sets the logistic curve.

    ``calibration_rows`` bounds the rows the curve is fitted on (thinned by a hash of the id); the models
    count all the others, whatever their number.
    """
    known = (
        labels.select("doc_id", "toxic").filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    )
    known = store(known.withColumn("_draw", F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20))), "labels")
    n, toxic = known.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    hinted = F.broadcast(known) if n <= 400_000 else known.hint("shuffle_hash")
    labelled = docs.select("doc_id", "text").join(hinted, "doc_id").select("text", "toxic", "_draw")
    quarter = 1 << 18
    table = ratios(count_grams(labelled.filter(F.col("_draw") >= quarter)))
    share = min(1.0, calibration_rows / max(1, n / 4))
    sample = labelled.filter(F.col("_draw") < int(quarter * share)).select("toxic", "text")
    found = evidence(sample, table, limit).toPandas()
    y, x = found["toxic"].to_numpy(float), np.log(found["evidence"].to_numpy(float) + FLOOR)
    if not len(y) or y.min() == y.max():
        base = min(max(toxic / n, 1e-6), 1 - 1e-6) if n else 1e-6
        return Model(table, 0.0, float(np.log(base / (1 - base))))
    return Model(table, *_logistic(x, y))


def score(docs: DataFrame, labels: DataFrame, limit: int = BROADCAST_GRAMS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    model = fit(docs, labels, limit=limit)
    found = evidence(docs.select("doc_id", "text"), model.table, limit)
    probability = 1 / (1 + F.exp(-(F.lit(model.slope) * F.log(F.col("evidence") + FLOOR) + F.lit(model.offset))))
    return found.select("doc_id", held_out().alias("held_out"), probability.alias("score")).withColumn(
        "predicted", (F.col("score") >= CUT).cast("int")
    )
