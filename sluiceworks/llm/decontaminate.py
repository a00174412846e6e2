r"""Benchmark decontamination: BM25 with block-max bounds over an inverted index of test items.

The test items are the collection, every training passage is a query. Impacts are BM25 weights divided by
the score an item gives itself, so one threshold fits items of any length. A document is cut into segments as
long as the longest item; a passage is two neighbouring segments, so whatever is copied lies whole in one of
them. Items are kept in blocks with the greatest impact per term, as sparse postings; as in block-max WAND, only
the blocks whose summed maxima reach the threshold are opened and scored exactly, which loses nothing. Document
frequencies, mean length and longest item are counted by Spark over all items; a large benchmark is dealt into
several indexes, built in tasks, and neither scores nor passages depend on how many there are. What is
retrieved is verified on the words in order: the runs of ``GRAM`` words of the question part of the item and
of its answer part (the last fifth) that stand in the passage.

Words are runs of letters and digits in lower case. Defined results: NULL and empty texts and items
without words match nothing; repeated rows and repeated items match one by one; ties keep the earliest
passage. An empty benchmark matches nothing. Other columns pass through ``clean``.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.llm.common import chunks, schema_of, store, texts_of
from sluiceworks.llm.words import IS_BREAK, Words, windows

K1, B = 1.2, 0.75
THRESHOLD = 0.6
GRAM = 3
ANSWER_SHARE = 0.2
MIN_QUESTION, MIN_ANSWER = 0.5, 0.5
BLOCK = 8
# Characters of test items in one broadcast index; a larger benchmark is queried in several rounds.
INDEX_CHARS = 8_000_000
CELLS = 1 << 20  # bounds (segments x blocks) and postings that are added up at a time, about


@dataclass
class Totals:
    """Figures of all test items with words, whatever index they are in."""

    items: int
    mean: float
    span: int  # words of the longest item
    terms: np.ndarray | None = None  # sorted hashes, of one index's words at least; None: the items at hand are all
    frequency: np.ndarray | None = None


@dataclass
class Item:
    item_id: object
    terms: np.ndarray
    impacts: np.ndarray
    question: np.ndarray
    answer: np.ndarray


@dataclass
class Index:
    terms: np.ndarray  # sorted hashes of the index's words
    starts: np.ndarray  # postings of each term: starts[t] : starts[t + 1]
    blocks: np.ndarray  # block of each posting
    maxima: np.ndarray  # greatest impact of the term in that block
    items: list[Item]
    span: int  # words of the longest item


def _grams(words: np.ndarray) -> np.ndarray:
    width = min(GRAM, len(words))
    return np.unique(windows(words, np.zeros(len(words), int), width)[0]) if width else words


def _words(texts: pa.Array) -> tuple[Words, np.ndarray]:
    split = Words(pc.utf8_lower(texts), IS_BREAK)
    return split, split.hashes()


def build(ids: list, texts: list[str | None], totals: Totals | None = None) -> Index:
    """The index of some test items; ``totals`` (default: of these alone) are those of all."""
    split, hashes = _words(texts_of(pa.array(texts, pa.string())))
    rows = [(ids[d], hashes[split.first[d] : split.first[d + 1]]) for d in range(len(ids)) if split.counts[d]]
    terms, frequency = np.unique(np.concatenate([np.unique(w) for _, w in rows] or [hashes[:0]]), return_counts=True)
    if totals is None:
        lengths = [len(w) for _, w in rows]
        totals = Totals(len(rows), sum(lengths) / max(1, len(rows)), max(lengths, default=1))
    elif totals.terms is not None:
        frequency = totals.frequency[np.searchsorted(totals.terms, terms)]
    idf = np.log1p((totals.items - frequency + 0.5) / (frequency + 0.5))
    items = []
    for item_id, words in rows:
        own, count = np.unique(words, return_counts=True)
        at = np.searchsorted(terms, own)
        impact = idf[at] * count * (K1 + 1) / (count + K1 * (1 - B + B * len(words) / totals.mean))
        cut = len(words) - max(1, round(ANSWER_SHARE * len(words)))
        items.append(Item(item_id, at, impact / impact.sum(), _grams(words[:cut]), _grams(words[cut:])))
    # Items with many words in common get neighbouring places, which tightens the bounds of a block.
    items.sort(key=lambda i: (int(i.terms[np.argmin(idf[i.terms])]), str(i.item_id)))
    term = np.concatenate([i.terms for i in items] or [np.zeros(0, np.int64)])
    block = np.repeat(np.arange(len(items)) // BLOCK, [len(i.terms) for i in items])
    impacts = np.concatenate([i.impacts for i in items] or [np.zeros(0)])
    order = np.lexsort((block, term))
    term, block, impacts = term[order], block[order], impacts[order]
    new = np.flatnonzero(np.r_[True, (term[1:] != term[:-1]) | (block[1:] != block[:-1])][: len(term)])
    maxima = np.maximum.reduceat(impacts, new) if len(new) else impacts
    starts = np.searchsorted(term[new], np.arange(len(terms) + 1))
    return Index(terms, starts, block[new], maxima, items, totals.span)


def _share(of: np.ndarray, among: np.ndarray) -> float:
    return float(np.isin(of, among).mean()) if len(of) else 1.0


def search(index: Index, texts: pa.Array) -> list[list[dict]]:
    """For each text the verified items: item_id, score, overlaps, first and last word of the passage."""
    out: list[list[dict]] = [[] for _ in range(len(texts))]
    split, hashes = _words(texts)
    if not len(split.starts) or not index.items:
        return out
    place = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
    hit = np.flatnonzero(index.terms[place] == hashes)
    segments = -(-split.counts // index.span)
    base = np.r_[0, np.cumsum(segments)]
    segment = base[split.doc[hit]] + (hit - split.first[split.doc[hit]]) // index.span
    # Distinct terms of each segment.
    pairs = np.unique(segment * len(index.terms) + place[hit])
    segment, term = np.divmod(pairs, len(index.terms))
    cuts = np.searchsorted(segment, np.arange(base[-1] + 1))
    doc_of = np.repeat(np.arange(len(segments)), segments)
    joined = np.r_[doc_of[1:] == doc_of[:-1], False]  # whether the next segment belongs to the same text
    best: dict[tuple[int, int], dict] = {}
    present = np.zeros(len(index.terms), bool)
    width_of = -(-len(index.items) // BLOCK)
    postings = np.diff(index.starts)[term]
    before = np.r_[0, np.cumsum(postings)]
    start, total = 0, int(base[-1])
    while start < total:
        # Segments whose bounds, and those of the segment after them, are added up together.
        room = max(1, CELLS // width_of)
        end = max(start + 1, min(start + room, total, int(np.searchsorted(before[cuts], before[cuts[start]] + CELLS, "right")) - 1))
        until = min(end + 1, total)
        pair = np.arange(cuts[start], cuts[until])
        owner = np.repeat(pair, postings[pair])
        posting = np.arange(len(owner)) - np.repeat(before[pair] - before[cuts[start]], postings[pair]) + index.starts[term[owner]]
        cell = (segment[owner] - start) * width_of + index.blocks[posting]
        bounds = np.bincount(cell, index.maxima[posting], (end + 1 - start) * width_of).reshape(-1, width_of)
        upper = bounds[:-1] + np.where(joined[start:end, None], bounds[1:], 0)
        for row, block in zip(*np.nonzero(upper >= THRESHOLD - 1e-4), strict=True):
            at = start + row
            after = at + 1 + joined[at]
            have = term[cuts[at] : cuts[after]]
            present[:] = False
            present[have] = True
            doc = doc_of[at]
            first = split.first[doc] + (at - base[doc]) * index.span
            last = min(first + (after - at) * index.span, split.first[doc + 1])
            for k in range(block * BLOCK, min((block + 1) * BLOCK, len(index.items))):
                item = index.items[k]
                score = float(item.impacts[present[item.terms]].sum())
                if score < THRESHOLD:
                    continue
                words = hashes[first:last]
                width = {min(GRAM, len(words))} | {1, 2, GRAM}
                grams = np.concatenate([windows(words, np.zeros(len(words), int), w)[0] for w in width])
                question, answer = _share(item.question, grams), _share(item.answer, grams)
                if question < MIN_QUESTION or answer < MIN_ANSWER:
                    continue
                found = best.get((doc, k))
                if found is None or score > found["score"]:
                    best[doc, k] = {
                        "item_id": item.item_id, "score": score, "question_overlap": question, "answer_overlap": answer,
                        "first_word": int(first - split.first[doc]), "last_word": int(last - split.first[doc] - 1),
                    }
        start = end
    for (doc, _), found in sorted(best.items()):
        out[doc].append(found)
    return out


def _counted(items: DataFrame) -> DataFrame:
    """``part, term, n`` of the items: in how many of a part's items each word stands. Term NULL: ``n`` words, one row an item."""

    def run(batches):
        for batch in batches:
            part = batch.column(0).to_numpy()
            split, hashes = _words(texts_of(batch.column(1)))
            # Each word once an item, then counted within its part.
            own = np.unique(np.stack([split.doc.astype(np.int64), hashes.view(np.int64)], 1), axis=0)
            pairs, n = np.unique(np.stack([part[own[:, 0]], own[:, 1]], 1), axis=0, return_counts=True)
            long = split.counts > 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.r_[pairs[:, 0], part[long]]),
                    pa.array(np.r_[pairs[:, 1], np.zeros(long.sum(), np.int64)], mask=np.r_[np.zeros(len(n), bool), np.ones(long.sum(), bool)]),
                    pa.array(np.r_[n, split.counts[long]]),
                ],
                names=["part", "term", "n"],
            )

    return items.select("part", "text").mapInArrow(run, "part long, term long, n long")


def indexes(benchmark: DataFrame, chars: int = INDEX_CHARS) -> list[Broadcast]:
    """Broadcast indexes of the test items, as many as keep each below ``chars`` characters.

    The driver holds one index at a time.
    """
    spark = benchmark.sparkSession
    items = benchmark.select("item_id", "text")
    rounds = 1 + (items.agg(F.sum(F.length("text"))).first()[0] or 0) // chars
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)).cast("long"))
    counted = store(_counted(dealt), "item-words")
    lengths = counted.filter("term IS NULL").agg(F.count("*").alias("n"), F.sum("n").alias("words"), F.max("n").alias("span")).first()
    totals = Totals(lengths["n"], (lengths["words"] or 0) / max(1, lengths["n"]), lengths["span"] or 1)
    if rounds == 1:  # the items at hand are all
        rows = items.orderBy("item_id", "text").collect()
        return [spark.sparkContext.broadcast(build([r["item_id"] for r in rows], [r["text"] for r in rows], totals))]
    # The frequency of a word over all parts, for each part that has it.
    each = counted.filter("term IS NOT NULL").groupBy("term", "part").agg(F.sum("n").alias("n"))
    everywhere = each.groupBy("term").agg(F.sum("n").alias("frequency"))
    known = each.select("term", "part").join(everywhere, "term")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = left.sort_by([("item_id", "ascending"), ("text", "ascending")])
        terms, frequency = right["term"].to_numpy().view(np.uint64), right["frequency"].to_numpy()
        order = np.argsort(terms)
        own = Totals(totals.items, totals.mean, totals.span, terms[order], frequency[order])
        index = build(rows["item_id"].to_pylist(), rows["text"].to_pylist(), own)
        return pa.table({"part": left["part"][:1], "index": pa.array([pickle.dumps(index)], pa.binary())})

    built = store(dealt.groupBy("part").cogroup(known.groupBy("part")).applyInArrow(run, "part long, index binary"), "item-indexes")
    out = []
    for r in built.select("part").orderBy("part").collect():
        blob = built.filter(F.col("part") == r["part"]).first()["index"]
        out.append(spark.sparkContext.broadcast(pickle.loads(blob)))
    return out


def matches(docs: DataFrame, benchmark: DataFrame, chars: int = INDEX_CHARS) -> DataFrame:
    """One row per document and test item found in it."""
    rows = docs.select("doc_id", "text")
    item_id = benchmark.schema["item_id"].dataType.simpleString()
    more = f"item_id {item_id}, score double, question_overlap double, answer_overlap double, first_word long, last_word long"
    schema = schema_of(rows, more, "doc_id")

    def run_on(index: Broadcast):
        def run(batches):
            from pyspark.sql.pandas.types import to_arrow_schema

            types = to_arrow_schema(schema)
            for batch in batches:
                for part, texts in chunks(batch, 1):
                    found = search(index.value, texts)
                    flat = [m for each in found for m in each]
                    of = pa.array([i for i, each in enumerate(found) for _ in each], pa.int64())
                    columns = [pa.array([m[f.name] for m in flat], f.type) for f in list(types)[1:]]
                    yield pa.RecordBatch.from_arrays([part.column(0).take(of), *columns], schema=types)

        return run

    found = [rows.mapInArrow(run_on(index), schema) for index in indexes(benchmark, chars)]
    out = found[0]
    for more_found in found[1:]:
        out = out.unionByName(more_found)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, chars: int = INDEX_CHARS) -> DataFrame:
    """The documents that hold no test item, with all their columns; rows stay where they are."""
    out = docs
    text = docs.columns.index("text")
    for index in indexes(benchmark, chars):

        def run(batches, index=index):
            for batch in batches:
                for part, texts in chunks(batch, text):
                    keep = [not found for found in search(index.value, texts)]
                    yield part.filter(pa.array(keep, pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
