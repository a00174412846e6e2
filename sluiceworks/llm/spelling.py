r"""Spelling variants: words one edit apart, each led to the most frequent spelling near it.

Words are counted over whole texts. Vocabulary words then look for neighbours by their edits: each word makes all its
deletions and all its replacements by a greater character (a pair that differs by an insertion or by a smaller
character is made by its other word). Edits are not spelled out: a polynomial hash of a word changes by a known term with each
edit, so all edits of a batch of words are one numpy expression. They are probed against blocked Bloom filters, sharded by
length: a filter block is one 64-bit number that holds about ``LOAD`` words of one length, built by a ``bit_or``
aggregation. Only positives travel: they are joined with the vocabulary by their hash, and the spelled words decide.

At most ``ROUND_BLOCKS`` blocks (8 bytes each) are broadcast at a time; a larger vocabulary is probed in several rounds, each
with the next blocks. Counts and vocabulary live in stored tables; a word has a bounded number of edits, so no key
grows with the data except in following forms to their roots, where ``spread_join`` cuts hot ones.

Defined results: NULL texts have no words, a NULL id counts as empty text in the misspelling rule, repeated rows count each time,
an empty table gives no rows, and other columns are left alone. Ties go to the word smallest in code-point order. Words
of any length take part.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.common import chunks, fmix, spread_join, store

RUNS = re.compile(r"[A-Za-zÀ-ÿ]+")
MISSPELL = 97
MIN_LENGTH, MIN_COUNT = 5, 3
LEAD = 2  # a form is at least so many times as frequent
LOAD = 4  # words a filter block
BITS = 5  # bits a word sets in its block
ROUND_BLOCKS = 1 << 22
PROBES = 1 << 20  # edits in memory at a time, about
_BASE = 0x9E3779B97F4A7C15


# ---------------------------------------------------------------- words


def occurrences(text: str, key: str, count: Counter) -> None:
    """Adds the words of one text; a run whose checksum with the document's id divides evenly loses one character."""
    # Bytes are lower-cased in ASCII only.
    runs = Counter(RUNS.findall(text.encode().lower().decode()))
    start = zlib.crc32(f"{key}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % MISSPELL == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
        if len(run) >= MIN_LENGTH:
            count[run] += n


def count_words(docs: DataFrame) -> DataFrame:
    """``word, n`` of every word of ``MIN_LENGTH`` characters or more, counted within tasks first."""

    def run(batches):
        count: Counter = Counter()

        def emit():
            return pa.RecordBatch.from_arrays(
                [pa.array(count.keys(), pa.string()), pa.array(count.values(), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for part, texts in chunks(batch, 1):
                for key, text in zip(part.column(0).to_pylist(), texts.to_pylist(), strict=True):
                    occurrences(text, key, count)
                if len(count) > 300_000:
                    yield emit()
                    count.clear()
        if count:
            yield emit()

    rows = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text").filter("text IS NOT NULL")
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- hashes and filters


def _code(points: np.ndarray) -> np.ndarray:
    """A well-mixed 64-bit number per character."""
    return fmix((points.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93))


def _powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), _BASE, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Spelled:
    """Characters of a list of words and the sums their hashes are made of.

    The hash of a word is ``fmix(sum(code(c_i) * base**i))``, so an edit adds a term to the sum, and a deletion shifts the rest.
    """

    def __init__(self, words: list[str]):
        self.lengths = np.array([len(w) for w in words], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        self.points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        self.codes = _code(self.points)
        self.word = np.repeat(np.arange(len(words)), self.lengths)
        self.place = np.arange(len(self.points)) - self.starts[self.word]
        self.power = _powers(int(self.lengths.max(initial=0)) + 1)
        self.terms = self.codes * self.power[self.place]
        # Running sums over all words; differences modulo 2**64 are the sums of parts of a word.
        self.running = np.r_[np.zeros(1, np.uint64), np.cumsum(self.terms, dtype=np.uint64)]
        self.sums = self.running[self.ends] - self.running[self.starts]

    def hashes(self) -> np.ndarray:
        return fmix(self.sums.copy())

    def deletions(self, at: np.ndarray) -> np.ndarray:
        """Hash of each word without its character at the places ``at`` of all characters."""
        word = self.word[at]
        before = self.running[at] - self.running[self.starts[word]]
        after = self.running[self.ends[word]] - self.running[at + 1]
        return fmix(before + after * np.uint64(pow(_BASE, -1, 1 << 64)))

    def replacements(self, at: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Hash of each word with its character at the places ``at`` replaced."""
        change = (_code(points) - self.codes[at]) * self.power[self.place[at]]
        return fmix(self.sums[self.word[at]] + change)


def _mask(hashes: np.ndarray) -> np.ndarray:
    """``BITS`` of 64 bits, taken from the hash's low half (the block comes from the high one)."""
    out = np.zeros(len(hashes), np.uint64)
    for k in range(BITS):
        out |= np.uint64(1) << ((hashes >> np.uint64(6 * k)) & np.uint64(63))
    return out


def _block(hashes: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Which of ``blocks`` blocks a hash belongs to."""
    return (((hashes >> np.uint64(32)) * blocks.astype(np.uint64)) >> np.uint64(32)).astype(np.int64)


class Layout:
    """First block and number of blocks of every length's filter; sparse in the lengths."""

    def __init__(self, counted: dict[int, int]):
        self.lengths = np.array(sorted(counted), np.int64)
        self.sizes = np.array([-(-counted[n] // LOAD) for n in self.lengths.tolist()], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.total = int(self.sizes.sum())

    def place(self, lengths: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """The block of each hash of a word of the given length; -1 where no word has that length."""
        at = np.minimum(np.searchsorted(self.lengths, lengths), len(self.lengths) - 1)
        out = self.first[at] + _block(hashes, self.sizes[at])
        return np.where(self.lengths[at] == lengths, out, -1)


def with_hashes(words: DataFrame) -> DataFrame:
    """``id, length, word, n`` of ``word, n``."""

    def run(batches):
        for batch in batches:
            own = Spelled(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [pa.array(own.hashes().view(np.int64)), pa.array(own.lengths), batch.column(0), batch.column(1)],
                names=["id", "length", "word", "n"],
            )

    return words.select("word", "n").mapInArrow(run, "id long, length long, word string, n long")


def filter_blocks(vocabulary: DataFrame, layout: Layout) -> DataFrame:
    """``block, bits`` of all filters."""

    def run(batches):
        for batch in batches:
            hashes = batch.column(0).to_numpy().view(np.uint64)
            place = layout.place(batch.column(1).to_numpy(), hashes)
            yield pa.RecordBatch.from_arrays(
                [pa.array(place), pa.array(_mask(hashes).view(np.int64))], names=["block", "bits"]
            )

    masks = vocabulary.select("id", "length").mapInArrow(run, "block long, bits long")
    return masks.groupBy("block").agg(F.bit_or("bits").alias("bits"))


# ---------------------------------------------------------------- probing


def _positives(words: list[str], alphabet: np.ndarray, layout: Layout, first: int, bits: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Edits that the filter blocks ``first`` onwards hold: word, edited hash, place, new character (0: deleted)."""
    own = Spelled(words)

    def hits(at, points, hashes, lengths):
        place = layout.place(lengths, hashes) - first
        inside = np.flatnonzero((place >= 0) & (place < len(bits)))
        mask = _mask(hashes[inside])
        inside = inside[(bits[place[inside]] & mask) == mask]
        return own.word[at[inside]], hashes[inside], own.place[at[inside]], points[inside]

    step = max(1, PROBES // max(1, len(alphabet)))
    for start in range(0, len(own.points), step):
        at = np.arange(start, min(start + step, len(own.points)))
        # Of equal characters in a row, deleting the first gives the same as deleting another.
        once = at[(own.place[at] == 0) | (own.points[at] != own.points[np.maximum(at - 1, 0)])]
        yield hits(once, np.zeros(len(once), np.uint32), own.deletions(once), own.lengths[own.word[once]] - 1)
        greater = len(alphabet) - np.searchsorted(alphabet, own.points[at], "right")
        each = np.repeat(at, greater)
        points = alphabet[len(alphabet) - 1 - (np.arange(len(each)) - np.repeat(np.cumsum(greater) - greater, greater))]
        yield hits(each, points, own.replacements(each, points), own.lengths[own.word[each]])


def candidates(vocabulary: DataFrame, layout: Layout, alphabet: np.ndarray, blocks: DataFrame, room: int = ROUND_BLOCKS) -> DataFrame:
    """``id, near_id, place, letter`` of all edits that a filter takes for a word; ``room`` blocks are broadcast a round."""
    spark = vocabulary.sparkSession
    schema = "id long, near_id long, place long, letter int"
    out = None
    for first in range(0, max(layout.total, 1), room):
        found = blocks.filter(F.col("block").between(first, first + room - 1)).toArrow()
        bits = np.zeros(min(room, layout.total - first), np.uint64)
        bits[found["block"].to_numpy() - first] = found["bits"].to_numpy().view(np.uint64)
        shared = spark.sparkContext.broadcast((layout, alphabet, first, bits))

        def run(batches, shared=shared):
            layout, alphabet, first, bits = shared.value
            for batch in batches:
                ids, words = batch.column(0).to_numpy(), batch.column(1).to_pylist()
                for lo in range(0, len(words), 2048):
                    for word, near, place, letter in _positives(words[lo : lo + 2048], alphabet, layout, first, bits):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(ids[lo + word]), pa.array(near.view(np.int64)), pa.array(place), pa.array(letter.astype(np.int32))],
                            names=["id", "near_id", "place", "letter"],
                        )

        positives = vocabulary.select("id", "word").mapInArrow(run, schema)
        if layout.total > room:
            positives = store(positives, "spelling-positives")
        out = positives if out is None else out.unionByName(positives)
    return out


def edited(word: Column, place: Column, letter: Column) -> Column:
    """The word without its character at ``place``, or with ``letter`` there."""
    new = F.when(letter > 0, F.char(letter)).otherwise(F.lit(""))
    return F.concat(F.substring(word, F.lit(1), place), new, F.substring(word, place + 2, F.length(word)))


def neighbours(vocabulary: DataFrame, room: int = ROUND_BLOCKS) -> DataFrame:
    """Stored ``word, n, near, near_n``: each pair of words one edit apart, once, of the stored ``id, length, word, n``."""
    counted = {r["length"]: r["count"] for r in vocabulary.groupBy("length").count().collect()}
    letters = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).filter("c <> ''").distinct()
    alphabet = np.array(sorted(ord(r["c"]) for r in letters.collect()), np.uint32)
    layout = Layout(counted or {0: 1})
    blocks = filter_blocks(vocabulary, layout)
    if layout.total > room:
        blocks = store(blocks, "spelling-filters")
    found = candidates(vocabulary, layout, alphabet, blocks, room)
    near = vocabulary.select(F.col("id").alias("near_id"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    # False positives end here, before any word is spelled beside them.
    pairs = found.join(near.hint("shuffle_hash"), "near_id").join(vocabulary.select("id", "word", "n").hint("shuffle_hash"), "id")
    exact = edited(F.col("word"), F.col("place").cast("int"), F.col("letter")) == F.col("near")
    return store(pairs.filter(exact).select("word", "n", "near", "near_n"), "spelling-pairs")


# ---------------------------------------------------------------- forms and roots


def forms(vocabulary: DataFrame, pairs: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n`` of every word."""
    both = pairs.unionByName(
        pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    )
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form"))).alias("best")
    )
    found = vocabulary.select("word", "n").join(best, "word", "left")
    leads = -F.col("best.less") >= LEAD * F.col("n")
    return found.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(leads, F.col("best.form")).alias("form"), F.when(leads, -F.col("best.less")).alias("form_n"),
    )


def roots(formed: DataFrame, small: int = 400_000) -> DataFrame:
    """``word, root`` of the words that have a form (stored ``word, form``): pointers are doubled until all have arrived.

    A form is at least twice as frequent as its word, so there are no circles and the rounds are few. Words that have arrived
    drop out of the rounds.
    """
    linked = formed.filter("form IS NOT NULL")
    # ``next`` is followed as long as it has a form itself.
    steps = store(linked.select("word", F.col("form").alias("next")), "spelling-steps")
    done = None
    while True:
        uses = steps.groupBy("next").agg(F.count("*").alias("_uses"))
        onward = steps.select(F.col("word").alias("next"), F.col("next").alias("after"))
        if done is not None:
            onward = onward.unionByName(done.select(F.col("word").alias("next"), F.col("root").alias("after")))
        keyed = store(uses.join(onward, "next"), "spelling-onward")
        moved = spread_join(steps, keyed, "next", "_uses", "word", "left", small=small)
        moved = store(moved.select("word", F.coalesce("after", "next").alias("next"), F.col("after").isNotNull().alias("going")), "spelling-moved")
        arrived = moved.filter("NOT going").select("word", F.col("next").alias("root"))
        done = arrived if done is None else done.unionByName(arrived)
        steps = moved.filter("going").select("word", "next")
        if steps.isEmpty():
            return done


def variants(docs: DataFrame, room: int = ROUND_BLOCKS) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of ``MIN_LENGTH`` characters and ``MIN_COUNT`` occurrences."""
    vocabulary = store(with_hashes(count_words(docs).filter(F.col("n") >= MIN_COUNT)), "spelling-words")
    formed = store(forms(vocabulary, neighbours(vocabulary, room)), "spelling-forms")
    return formed.join(roots(formed), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
