r"""Ranked lexical search: the best documents of every test item, by dual-tree search.

Documents are vectors over the terms of the items (a term's saturated count there), items are vectors of term
weights, a score is their product. Both sides are trees: items in groups of ``ITEM_LEVELS`` neighbours, documents in
groups of ``DOC_LEVELS``. A node holds the maximum of every coordinate below it, so the product of two nodes bounds all
scores between them. The search goes down both trees together and drops a pair of nodes as soon as its bound is
below the weakest kth score among the node's items; a whole batch of documents goes that way at once. A pair that could
still tie is kept, so the result is exact. All figures are integers; sums of doubles are used while they are exact.

How it runs: one pass over the texts keeps, per document, its length and its counts of item terms (stored). From
these come the number of documents, their length and the document frequencies by aggregation. The vectors are dealt
by range of their rarest item term and a hash of the id, so that alike documents share batches and no term is one task's
alone; a sample of ``SEEDS`` documents is searched first and gives every item a score to beat. Tasks emit their best
``K`` documents per item; a window over those gives the ranks. Items are collected in blocks of ``BLOCK_CHARS`` characters,
one round each, whatever the size of the benchmark.

Terms are compared by 64-bit hashes. Defined results: NULL and empty texts have no terms; a document without terms is not counted and
never found, an item without terms finds nothing; repeated documents and repeated items are ranked one by one; equal scores go by
ascending doc_id, NULL ids last; empty tables give no rows. Other columns are left alone.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from sluiceworks.llm.common import chunks, schema_of, store, texts_of
from sluiceworks.llm.words import IS_BREAK, Words

K = 10
SCALE = 1_000_000_000
ITEM_LEVELS = (64, 8, 1, 1)
DOC_LEVELS = (512, 64, 8, 1)
SEEDS = 4096  # documents searched first, about
BLOCK_CHARS = 8_000_000  # characters of items searched with in one round
CELLS = 1 << 21  # products that are added up at a time, about
KEPT = 200_000  # found documents a task holds before it keeps the best only
EXACT = 1 << 53  # doubles count exactly up to here


# ---------------------------------------------------------------- counts of terms


def _terms(texts: pa.Array) -> tuple[Words, np.ndarray]:
    split = Words(texts, IS_BREAK)
    return split, split.hashes(lower=True)


def _runs(sizes: np.ndarray) -> np.ndarray:
    """0, 1, … within each run of the given sizes."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def vectors(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """``doc_id, n, term, tf`` of the documents with a term: its length and its counts of the sorted ``terms``."""
    rows = docs.select("doc_id", "text")
    schema = schema_of(rows, "n long, term array<int>, tf array<int>", "doc_id")
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches):
        terms = shared.value
        types = to_arrow_schema(schema)
        for batch in batches:
            for part, texts in chunks(batch, 1):
                split, hashes = _terms(texts)
                place = np.minimum(np.searchsorted(terms, hashes), max(0, len(terms) - 1))
                hit = np.flatnonzero(terms[place] == hashes) if len(terms) else np.zeros(0, np.int64)
                pairs, tf = np.unique(split.doc[hit] * max(1, len(terms)) + place[hit], return_counts=True)
                doc, term = np.divmod(pairs, max(1, len(terms)))
                some = np.flatnonzero(split.counts)
                ends = np.r_[0, np.searchsorted(doc, some, "right")].astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v.astype(np.int32))) for v in (term, tf)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(some)), pa.array(split.counts[some].astype(np.int64)), *lists], schema=types
                )

    return rows.mapInArrow(run, schema)


def frequencies(found: DataFrame, size: int) -> np.ndarray:
    """How many of the stored vectors hold each of ``size`` terms."""

    def run(batches):
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["term", "df"])

    counted = found.select("term").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    out = np.zeros(size, np.int64)
    out[counted["term"].to_numpy()] = counted["df"].to_numpy()
    return out


def weights(documents: int, df: np.ndarray) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)


# ---------------------------------------------------------------- trees


@dataclass
class Level:
    """Nodes of one level of the item tree as postings: of term ``t`` those at ``starts[t] : starts[t + 1]``."""

    starts: np.ndarray
    nodes: np.ndarray
    maxima: np.ndarray
    count: int
    parent: np.ndarray  # of each node, on the level above
    first: np.ndarray  # of each node, its first item
    exact: bool  # whether doubles can add the scores up


class Items:
    """The items of one round, neighbours alike, in levels from the top down; ``rows`` is where each item stood."""

    def __init__(self, terms: list[np.ndarray], weight: np.ndarray):
        rarest = [int(t[np.argmax(weight[t])]) if len(t) else -1 for t in terms]
        self.rows = np.array(sorted(range(len(terms)), key=lambda r: (rarest[r], r)), np.int64)
        term = np.concatenate([terms[r] for r in self.rows] or [np.zeros(0, np.int64)])
        item = np.repeat(np.arange(len(self.rows)), [len(terms[r]) for r in self.rows])
        self.weight = weight
        self.levels = [self._level(k, term, item) for k in range(len(ITEM_LEVELS))]

    def _level(self, k: int, term: np.ndarray, item: np.ndarray) -> Level:
        size, count = ITEM_LEVELS[k], len(self.rows)
        nodes = -(-count // size)
        pairs = np.unique(term * max(1, nodes) + item // size)
        of, node = np.divmod(pairs, max(1, nodes))
        top = np.bincount(node, self.weight[of], nodes) if nodes else np.zeros(0)
        first = np.arange(nodes) * size
        above = first // ITEM_LEVELS[k - 1] if k else np.zeros(nodes, np.int64)
        starts = np.searchsorted(of, np.arange(len(self.weight) + 1))
        return Level(starts, node, self.weight[of], nodes, above, first, bool(top.max(initial=0) * 1_000_000 < EXACT))


def _products(level: Level, node: np.ndarray, term: np.ndarray, x: np.ndarray, nodes: int, alive: np.ndarray) -> np.ndarray:
    """Sums of ``x`` times maxima between ``nodes`` document nodes and all item nodes, where ``alive``; 0 elsewhere."""
    out = np.zeros(nodes * level.count, np.int64)
    many = level.starts[term + 1] - level.starts[term]
    before = np.r_[0, np.cumsum(many)]
    start = 0
    while start < len(term):
        end = max(start + 1, int(np.searchsorted(before, before[start] + CELLS, "right")) - 1)
        sizes = many[start:end]
        at = np.repeat(level.starts[term[start:end]], sizes) + _runs(sizes)
        cell = np.repeat(node[start:end], sizes) * level.count + level.nodes[at]
        use = alive.ravel()[cell]
        cell, value = cell[use], (np.repeat(x[start:end], sizes) * level.maxima[at])[use]
        if level.exact:
            out += np.bincount(cell, value, len(out)).astype(np.int64)
        else:
            np.add.at(out, cell, value)
        start = end
    return out.reshape(nodes, level.count)


class Search:
    """Best documents of every item among those seen, starting from the scores ``floor`` that others reached."""

    def __init__(self, items: Items, floor: np.ndarray, k: int = K):
        self.items, self.k = items, k
        self.kth = floor.copy()
        self.found: list[pa.Table] = []
        self.held = 0
        self.scored = 0  # pairs of document and item that were scored

    def batch(self, ids: pa.Array, n: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, documents: int, words: int) -> None:
        """Documents by place: their ids, lengths, and entries ``doc`` (ascending), ``term``, ``tf``."""
        m = 10 + (90 * n * documents) // max(1, words)
        x = (SCALE * tf) // (1000 * tf + 8 * m[doc])
        alive = np.ones((1, 1), bool)  # pairs of nodes still to look at, on the level before
        for size, above, level in zip(DOC_LEVELS, (DOC_LEVELS[0], *DOC_LEVELS[:-1]), self.items.levels, strict=True):
            nodes = -(-len(n) // size)
            parents = np.arange(nodes) * size // above
            alive = alive[parents][:, level.parent] if level.count else np.zeros((nodes, 0), bool)
            own = alive.any(axis=1)
            if not own.any():
                return
            pairs = doc // size * len(self.items.weight) + term
            use = np.flatnonzero(own[doc // size])
            order = use[np.argsort(pairs[use], kind="stable")]
            new = np.flatnonzero(np.r_[True, pairs[order[1:]] != pairs[order[:-1]]][: len(order)])
            if not len(new):
                return
            node, t = np.divmod(pairs[order[new]], len(self.items.weight))
            bounds = _products(level, node, t, np.maximum.reduceat(x[order], new), nodes, alive)
            if size > 1:
                weakest = np.minimum.reduceat(self.kth, level.first)
                alive = alive & (bounds > 0) & (bounds >= weakest)
        self.scored += int(alive.sum())
        at, item = np.nonzero(alive & (bounds > 0) & (bounds >= self.kth))
        if len(at):
            columns = [pa.array(item), pa.array(bounds[at, item]), ids.take(pa.array(at))]
            self.found.append(pa.table(columns, names=["item", "score", "doc_id"]))
            self.held += len(at)
            if self.held > min(KEPT, max(4 * self.k * len(self.kth), 1)):
                self.keep()

    def keep(self) -> pa.Table | None:
        """Only the best ``k`` documents of each item are left; the last of ``k`` is the score to reach."""
        if not self.found:
            return None
        rows = pa.concat_tables(self.found).sort_by([("item", "ascending"), ("score", "descending"), ("doc_id", "ascending")])
        item = rows["item"].to_numpy()
        sizes = np.bincount(item, minlength=len(self.kth))
        place = _runs(sizes)
        rows = rows.filter(pa.array(place < self.k))
        last = np.cumsum(np.minimum(sizes, self.k)) - 1
        full = sizes >= self.k
        self.kth[full] = np.maximum(self.kth[full], rows["score"].to_numpy()[last[full]])
        self.found, self.held = [rows], len(rows)
        return rows


def _batches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``ids, n, doc, term, tf`` of ``DOC_LEVELS[0]`` vectors at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, DOC_LEVELS[0]):
            part = batch.slice(start, DOC_LEVELS[0])
            sizes = np.diff(part.column(2).offsets.to_numpy())
            term, tf = (part.column(c).flatten().to_numpy().astype(np.int64) for c in (2, 3))
            yield part.column(0), part.column(1).to_numpy(), np.repeat(np.arange(part.num_rows), sizes), term, tf


def search(found: DataFrame, items: Items, floor: np.ndarray, documents: int, words: int, k: int = K) -> DataFrame:
    """``item, score, doc_id``: every task's best ``k`` of its vectors per item, by the item's row."""
    schema = schema_of(found, "item long, score long", "doc_id").fields
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in (*schema[1:], schema[0]))
    shared = found.sparkSession.sparkContext.broadcast((items, floor))

    def run(batches):
        items, floor = shared.value
        best = Search(items, floor, k)
        for each in _batches(batches):
            best.batch(*each, documents, words)
        rows = best.keep()
        if rows is not None:
            rows = rows.set_column(0, "item", pa.array(items.rows[rows["item"].to_numpy()]))
            yield from rows.combine_chunks().to_batches()

    return found.select("doc_id", "n", "term", "tf").mapInArrow(run, fields)


def _top(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def rank(docs: DataFrame, benchmark: DataFrame, k: int = K, chars: int = BLOCK_CHARS, seeds: int = SEEDS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of each item with a score above 0."""
    spark = docs.sparkSession
    items = benchmark.select("item_id", "text")
    rounds = 1 + (items.agg(F.sum(F.length("text"))).first()[0] or 0) // chars
    dealt = items.withColumn("part", F.pmod(F.xxhash64("item_id", "text"), F.lit(rounds)))
    out = None
    for part in range(rounds):
        rows = dealt.filter(F.col("part") == part).orderBy("item_id", "text").select("item_id", "text").toArrow()
        split, hashes = _terms(texts_of(rows["text"]))
        terms = np.unique(hashes)
        own = [np.searchsorted(terms, np.unique(hashes[a:b])) for a, b in zip(split.first[:-1], split.first[1:], strict=True)]
        found = store(vectors(docs, terms), "term-vectors")
        documents, words = found.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = frequencies(found, len(terms))
        tree = Items(own, weights(documents, df))
        # Alike documents side by side: by the rarest of their terms.
        order = spark.sparkContext.broadcast(np.argsort(np.argsort(df, kind="stable")))

        def keyed(batches, order=order):
            for batch in batches:
                entries = batch.column(2)
                key = np.full(batch.num_rows, -1, np.int64)
                some = np.flatnonzero(np.diff(entries.offsets.to_numpy()))
                if len(some):
                    starts = entries.offsets.to_numpy()[some] - entries.offsets.to_numpy()[0]
                    key[some] = np.minimum.reduceat(order.value[entries.flatten().to_numpy()], starts)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(key)], names=[*batch.schema.names, "_key"])

        useful = found.filter(F.size("term") > 0)
        placed = useful.mapInArrow(keyed, schema_of(useful, "_key long")).withColumn("_salt", F.xxhash64("doc_id", "n"))
        floor = np.zeros(len(tree.rows), np.int64)
        sample = useful.filter(F.pmod(F.xxhash64("doc_id", "n"), F.lit(max(1, documents // max(1, seeds)))) == 0)
        reached = _top(search(sample, tree, floor, documents, words, k), k).filter(F.col("rank") == k).select("item", "score").toArrow()
        place = np.argsort(tree.rows)
        floor[place[reached["item"].to_numpy()]] = reached["score"].to_numpy()
        near = placed.repartitionByRange("_key", "_salt").sortWithinPartitions("_key", "_salt")
        best = _top(search(near, tree, floor, documents, words, k), k)
        ids = pa.table({"item": pa.array(np.arange(rows.num_rows)), "item_id": rows["item_id"]})
        names = spark.createDataFrame(ids)
        part_found = best.join(F.broadcast(names), "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")
        if rounds > 1:
            part_found = store(part_found, "ranked")
        out = part_found if out is None else out.unionByName(part_found)
    return out


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_SPLIT = rf"regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL = rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, {_SPLIT} AS terms FROM documents WHERE text IS NOT NULL),
lengths AS (SELECT r, doc_id, CAST(len(terms) AS BIGINT) AS n FROM docs WHERE len(terms) > 0),
totals AS (SELECT CAST(count(*) AS BIGINT) AS total, CAST(sum(n) AS BIGINT) AS words FROM lengths),
wanted AS (SELECT DISTINCT i, item_id, unnest(terms) AS term FROM (SELECT row_number() OVER () AS i, item_id, {_SPLIT} AS terms FROM benchmark)),
counts AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(terms) AS term FROM docs) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * total + 2 AS DOUBLE) / CAST(2 * df + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM (SELECT term, count(*) AS df FROM counts GROUP BY term), totals
),
scores AS (
  SELECT i, item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * total) // words)))) AS BIGINT) AS score
  FROM wanted JOIN counts USING (term) JOIN weights USING (term) JOIN lengths USING (r), totals
  GROUP BY i, item_id, r, doc_id
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""
