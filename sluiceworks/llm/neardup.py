r"""MinHash near-dedup by a chosen-path set similarity join.

A document's set is its distinct shingles of ``WORDS`` lower-cased words. Documents with equal sets are one
class. Each class has ``TOKENS`` minwise tokens; a tree sends it down paths chosen by pairs of its tokens
(which pairs, is drawn from the node), so classes that are similar keep meeting. Nodes that are small enough are
compared exhaustively on tokens; larger ones branch again. Independent trees are repeated until a pair at the
threshold is missed with a probability below ``MISS``.

What meets is only a candidate. Candidates form groups; a group of up to ``DIRECT`` classes is settled on full
sets, in one task or in pairs of blocks. A larger one is settled node by node: small nodes whole, nodes that
would not shrink by linking all their classes to one pivot and comparing what is left over with everybody in
blocks. Tasks return a spanning forest of the links they confirm, never the pairs, and components join the
forests. Nothing is capped: every pair that meets is either confirmed, refuted, or already connected.

Defined results: NULL and empty texts and texts without a word have an empty set, link to nothing and are
kept; a text with fewer than ``WORDS`` words has one shingle. Repeated rows are exact copies. Rows with a NULL id are
compared like others; a component's id is the smallest non-NULL id in it, and NULL ids equal it only if there is
none (then they are kept). Other columns pass through ``keep_one``. An empty table gives no rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sluiceworks.llm.common import chunks, fmix, free, schema_of, spread_join, store
from sluiceworks.llm.components import components
from sluiceworks.llm.words import Words, windows

WORDS = 5
TOKENS = 64
LEVELS = 4  # of branching; each adds a pair of tokens to the path
BRANCHES = 2  # pairs drawn at each node below the root
LEAF = 1024  # classes in a node that is compared exhaustively
GROUP = 1024  # classes, and
GROUP_SHINGLES = 2_000_000  # shingles settled in one go
DIRECT = 8192  # classes of a group whose pairs are compared once each; beyond it, node by node
MISS = 1e-6

_SEEDS = fmix(np.arange(1, 2 * TOKENS + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F))
_XOR, _ODD = _SEEDS[:TOKENS], _SEEDS[TOKENS:] | np.uint64(1)


@dataclass(frozen=True)
class Threshold:
    """Links: 100 * intersection >= percent * union."""

    percent: int

    @property
    def trees(self) -> int:
        meet = (self.percent / 100) ** 2
        path = meet * (1 - (1 - meet) ** BRANCHES) ** (LEVELS - 1)
        return math.ceil(math.log(MISS) / math.log(1 - path))

    @property
    def agreeing(self) -> int:
        """Tokens in common, five standard deviations below what the threshold makes expected."""
        p = self.percent / 100
        return max(1, math.floor(TOKENS * p - 5 * math.sqrt(TOKENS * p * (1 - p))))

    def links(self, sets: list[np.ndarray]) -> np.ndarray:
        """Which of the sets are linked, as a symmetric matrix: exact, from products of incidence matrices."""
        sizes = np.array([len(x) for x in sets])
        row = np.repeat(np.arange(len(sets)), sizes)
        _, column, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
        shared = often[column] > 1  # others add to no intersection
        row, column = row[shared], (np.cumsum(often > 1) - 1)[column[shared]]
        order = np.argsort(column, kind="stable")
        row, column = row[order], column[order]
        both = np.zeros((len(sets), len(sets)))
        for start in range(0, int(column[-1]) + 1 if len(column) else 0, 4096):
            part = slice(*np.searchsorted(column, (start, start + 4096)))
            incidence = np.zeros((len(sets), 4096), np.float32)
            incidence[row[part], column[part] - start] = 1
            both += incidence @ incidence.T
        return 100 * both >= self.percent * (sizes[:, None] + sizes[None, :] - both)


# ---------------------------------------------------------------- sets and tokens


def shingle_sets(texts: pa.Array) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    words = Words(texts)
    hashes = words.hashes(lower=True)
    found, at = windows(hashes, words.doc, WORDS)
    cuts = np.searchsorted(words.doc[at], np.arange(len(words.counts) + 1))
    out = []
    for d, n in enumerate(words.counts):
        if 0 < n < WORDS:
            whole = hashes[words.first[d] : words.first[d + 1]]
            out.append(windows(whole, np.zeros(n, int), int(n))[0])
        else:
            out.append(np.unique(found[cuts[d] : cuts[d + 1]]))
    return out


def class_of(shingles: np.ndarray) -> int | None:
    """A 64-bit name of the set; None for the empty set."""
    if not len(shingles):
        return None
    total = fmix(shingles * np.uint64(0xE7037ED1A0B428DB)).sum(dtype=np.uint64)
    return int(fmix(np.array([total], np.uint64) ^ np.uint64(len(shingles)))[0].astype(np.int64))


def tokens_of(shingles: np.ndarray) -> np.ndarray:
    least = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for start in range(0, len(shingles), 2048):  # so that long texts need no more memory
        mixed = (shingles[start : start + 2048, None] ^ _XOR) * _ODD
        np.minimum(least, (mixed ^ (mixed >> np.uint64(29))).min(axis=0), out=least)
    return (fmix(least) >> np.uint64(32)).astype(np.uint32)


def sketch(docs: DataFrame, *more: str) -> DataFrame:
    """Stored: doc_id, n_shingles, cls (NULL for the empty set), tokens, mark, and the columns ``more`` of ``docs``.

    ``mark`` tells rows with one id apart by their texts.
    """
    rows = docs.select("doc_id", "text", _mark().alias("mark"), *more)

    def run(batches):
        for batch in batches:
            for part, texts in chunks(batch, 1):
                sets = shingle_sets(texts)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([class_of(s) for s in sets], pa.int64()),
                        pa.array([tokens_of(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                        *part.columns[2:],
                    ],
                    names=["doc_id", "n_shingles", "cls", "tokens", "mark", *more],
                )

    schema = schema_of(rows, "n_shingles long, cls long, tokens binary, mark long", "doc_id")
    return store(rows.mapInArrow(run, StructType([*schema.fields, *(docs.schema[c] for c in more)])), "sketch")


def _mark() -> Column:
    return F.xxhash64("text")


def full_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Stored ``cls, n, shingles`` of the ``wanted`` classes (columns ``cls``, and ``rep``, ``mark``: one of their rows).

    Texts of those rows alone are read again, however many others have their id; the list is broadcast if it is
    short.
    """
    asked = wanted.count()
    ids = wanted.select(F.col("rep").alias("_rep"), F.col("mark").alias("_mark"), F.col("cls").alias("_cls"))
    hinted = F.broadcast(ids) if asked <= 400_000 else ids.hint("shuffle_hash")
    rows = docs.select("doc_id", "text", _mark().alias("_own"))
    rows = rows.join(hinted, F.col("doc_id").eqNullSafe(F.col("_rep")) & (F.col("_own") == F.col("_mark"))).select("_cls", "text")

    def run(batches):
        for batch in batches:
            for part, texts in chunks(batch, 1):
                sets = shingle_sets(texts)
                # Marks are hashes: what else may share one is told apart by its class.
                own = [(c, s) for c, s in zip(part.column(0).to_pylist(), sets, strict=True) if class_of(s) == c]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([c for c, _ in own], pa.int64()),
                        pa.array([len(s) for _, s in own], pa.int64()),
                        pa.array([s.tobytes() for _, s in own], pa.binary()),
                    ],
                    names=["cls", "n", "shingles"],
                )

    found = store(rows.mapInArrow(run, "cls long, n long, shingles binary"), "sets")
    if found.count() > asked:  # rows with one id and one text
        found = store(found.dropDuplicates(["cls"]), "sets")
    return found


# ---------------------------------------------------------------- the trees


def _pairs(node: np.ndarray, branch: int) -> tuple[np.ndarray, np.ndarray]:
    """The two token places that branch ``branch`` of each node looks at."""
    drawn = fmix(node ^ np.uint64(0x8EBC6AF09C88C6E3 * (branch + 1) & 0xFFFFFFFFFFFFFFFF))
    first = drawn % np.uint64(TOKENS)
    return first, (first + 1 + (drawn >> np.uint64(32)) % np.uint64(TOKENS - 1)) % np.uint64(TOKENS)


def _child(node: np.ndarray, branch: int, tokens: np.ndarray) -> np.ndarray:
    first, second = _pairs(node, branch)
    rows = np.arange(len(node))
    a, b = tokens[rows, first.astype(np.int64)], tokens[rows, second.astype(np.int64)]
    pair = (a.astype(np.uint64) << np.uint64(32)) | b.astype(np.uint64)
    return fmix(fmix(pair ^ np.uint64(0x589965CC75374CC3)) + node * np.uint64(2 * branch + 3))


def _matrix(column: pa.Array) -> np.ndarray:
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, "<u4").reshape(-1, TOKENS)


def roots(classes: DataFrame, trees: int) -> DataFrame:
    """``node, cls``: the first node of every class in every tree."""

    def run(batches):
        for batch in batches:
            tokens, cls = _matrix(batch.column(1)), batch.column(0)
            for tree in range(trees):
                node = np.full(len(tokens), fmix(np.array([tree + 1], np.uint64))[0], np.uint64)
                yield pa.RecordBatch.from_arrays([pa.array(_child(node, 0, tokens).view(np.int64)), cls], names=["node", "cls"])

    return classes.select("cls", "tokens").mapInArrow(run, "node long, cls long")


def branch(members: DataFrame, classes: DataFrame) -> DataFrame:
    """``node, cls``: the members' nodes one level down."""

    def run(batches):
        for batch in batches:
            node = np.asarray(batch.column(0)).view(np.uint64)
            tokens = _matrix(batch.column(2))
            for b in range(BRANCHES):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_child(node, b, tokens).view(np.int64)), batch.column(1)], names=["node", "cls"]
                )

    return with_class(members.select("node", "cls"), classes, "tokens").mapInArrow(run, "node long, cls long")


def with_class(members: DataFrame, classes: DataFrame, *columns: str) -> DataFrame:
    return members.join(classes.select("cls", *columns), "cls").select(*members.columns, *columns)


def meet(entries: DataFrame) -> DataFrame:
    """Stored ``node, cls, size, pivot`` of nodes in which two classes or more meet."""
    nodes = store(entries.groupBy("node").agg(F.count("*").alias("size"), F.min("cls").alias("pivot")).filter("size > 1"), "nodes")
    return store(spread_join(entries, nodes, "node", "size", "cls").select("node", "cls", "size", "pivot"), "members")


def grow(classes: DataFrame, threshold: Threshold) -> tuple[DataFrame, DataFrame]:
    """Members of the leaves, and of nodes that are still large after the last level."""
    members = meet(roots(classes, threshold.trees))
    leaves = members.filter(F.col("size") <= LEAF)
    large = members.filter(F.col("size") > LEAF)
    for _ in range(LEVELS - 1):
        if large.isEmpty():
            break
        members = meet(branch(large, classes))
        leaves = leaves.unionByName(members.filter(F.col("size") <= LEAF))
        large = members.filter(F.col("size") > LEAF)
    return leaves, large


# ---------------------------------------------------------------- comparing inside tasks


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Consecutive rows with the same first column, which must be sorted, across batches."""
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(0))
        cuts = np.r_[0, np.flatnonzero(keys[1:] != keys[:-1]) + 1, len(keys)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and keys[a] != key:
                yield pa.Table.from_batches(held)
                held = []
            key = keys[a]
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _close(tokens: np.ndarray, agreeing: int) -> np.ndarray:
    """Which pairs of rows have enough tokens in common, as a symmetric matrix."""
    same = np.zeros((len(tokens), len(tokens)), np.uint8)
    for column in tokens.T:
        same += column[:, None] == column[None, :]
    return same >= agreeing


def _spanning(links: np.ndarray) -> list[tuple[int, int]]:
    """A star for each connected component of the matrix, from its first row."""
    out = []
    fresh = np.ones(len(links), bool)
    for x in range(len(links)):
        if not fresh[x]:
            continue
        fresh[x] = False
        reached = links[x] & fresh
        while reached.any():
            found = np.flatnonzero(reached)
            fresh[found] = False
            out += [(x, int(y)) for y in found]
            reached = links[found].any(axis=0) & fresh
    return out


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())], names=["a", "b"]
    )


def candidates(leaves: DataFrame, classes: DataFrame, threshold: Threshold) -> DataFrame:
    """``a, b``: per leaf, a spanning forest of the classes with enough tokens in common."""
    agreeing = threshold.agreeing
    rows = with_class(leaves.select("node", "cls"), classes, "tokens").repartition("node").sortWithinPartitions("node", "cls")

    def run(batches):
        found: list[tuple[int, int]] = []
        for unit in _runs(batches):
            cls = unit.column(1).to_pylist()
            found += [(cls[x], cls[y]) for x, y in _spanning(_close(_matrix(unit.column(2)), agreeing))]
            if len(found) > 10_000:
                yield _edges(found)
                found = []
        yield _edges(found)

    return rows.mapInArrow(run, "a long, b long")


def settle(units: DataFrame, sets: DataFrame, threshold: Threshold) -> DataFrame:
    """``a, b``: per unit, a spanning forest of the confirmed links.

    ``units``: ``unit, cls, every`` - pairs in which neither class has ``every`` are left to other units.
    """
    rows = with_class(units.select("unit", "cls", "every"), sets, "shingles").repartition("unit").sortWithinPartitions("unit", "cls")

    def run(batches):
        found: list[tuple[int, int]] = []
        for unit in _runs(batches):
            if unit.num_rows == 1:
                continue
            cls, every = unit.column("cls").to_pylist(), unit.column("every").to_pylist()
            links = threshold.links([np.frombuffer(s, np.uint64) for s in unit.column("shingles").to_pylist()])
            links &= np.array(every)[:, None] | np.array(every)[None, :]
            found += [(cls[x], cls[y]) for x, y in _spanning(links)]
            if len(found) > 10_000:
                yield _edges(found)
                found = []
        yield _edges(found)

    return rows.mapInArrow(run, "a long, b long")


def _sized(members: DataFrame) -> DataFrame:
    return members.groupBy("grp").agg(F.count("*").alias("size"), F.sum("n").alias("shingles"))


def _parts(size: str, shingles: str) -> Column:
    """Blocks of which two fit a task."""
    return F.ceil(F.greatest(2 * F.col(size) / GROUP, 2 * F.col(shingles) / GROUP_SHINGLES)).cast("int")


def _block(parts: str) -> Column:
    return F.pmod(F.xxhash64("cls"), F.col(parts)).cast("int")


def _every(last: Column) -> Column:
    return F.explode(F.sequence(F.lit(0), last - 1))


def in_blocks(members: DataFrame) -> DataFrame:
    """``unit, cls, every`` from ``grp, cls, n``: groups as units that fit a task.

    A group beyond the limits is cut into blocks, and each pair of blocks is a unit, so all pairs still meet.
    """
    fits = (F.col("size") <= GROUP) & (F.col("shingles") <= GROUP_SHINGLES)
    counted = store(_sized(members).withColumn("parts", F.when(fits, 1).otherwise(_parts("size", "shingles"))), "groups")
    placed = spread_join(members, counted, "grp", "size", "cls").withColumn("block", _block("parts"))
    spread = placed.withColumn("other", _every(F.col("parts")))
    low, high = F.least("block", "other"), F.greatest("block", "other")
    return spread.select(F.xxhash64("grp", low, high).alias("unit"), "cls", F.lit(True).alias("every"))


def against(rest: DataFrame, members: DataFrame) -> DataFrame:
    """``unit, cls, every`` in which each of ``rest`` meets all ``members`` of its group (``grp, cls, n``).

    Both are cut into blocks; a member is copied once per block of the rest, which are few where most
    classes were linked to the pivot.
    """
    few = _sized(rest).select("grp", F.col("size").alias("rest_size"), _parts("size", "shingles").alias("rest_parts"))
    many = _sized(members).select("grp", "size", _parts("size", "shingles").alias("parts"))
    counted = store(few.join(many, "grp"), "blocks")
    asking = (
        spread_join(rest, counted, "grp", "rest_size", "cls").withColumn("row", _block("rest_parts"))
        .withColumn("column", _every(F.col("parts"))).withColumn("every", F.lit(True))
    )
    asked = (
        spread_join(members, counted, "grp", "size", "cls").withColumn("column", _block("parts"))
        .withColumn("row", _every(F.col("rest_parts"))).withColumn("every", F.lit(False))
    )
    both = asking.select("grp", "row", "column", "cls", "every").unionByName(asked.select("grp", "row", "column", "cls", "every"))
    return both.select(F.xxhash64("grp", "row", "column").alias("unit"), "cls", "every")


def by_pivot(large: DataFrame, sets: DataFrame, threshold: Threshold) -> tuple[DataFrame, DataFrame]:
    """Links of large nodes' classes to the node's pivot, and the units of what is left to compare.

    A class linked to the pivot is connected with all others that are. The others are compared with each other
    and, where one of them is within twice the threshold's distance of the pivot, with the linked ones: from
    further away nothing linked to the pivot can be reached (Jaccard distances obey the triangle inequality).
    """
    pivots = with_class(large.select("node", F.col("pivot").alias("cls"), "size").distinct(), sets, "shingles").select(
        "node", "size", F.col("cls").alias("_pivot"), F.col("shingles").alias("_with")
    )
    rows = with_class(large.select("node", "cls"), sets, "n", "shingles")
    joined = spread_join(rows, store(pivots, "pivots"), "node", "size", "cls").select("node", "cls", "n", "_pivot", "shingles", "_with")

    def run(batches):
        for batch in batches:
            similarity = []
            for a, b in zip(batch.column(4).to_pylist(), batch.column(5).to_pylist(), strict=True):
                x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                similarity.append(both / (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(similarity)], names=["node", "cls", "n", "_pivot", "similarity"]
            )

    measured = store(joined.mapInArrow(run, "node long, cls long, n long, _pivot long, similarity double"), "pivoted")
    near = F.col("similarity") * 100 >= threshold.percent - 1e-9
    links = measured.filter(near & (F.col("cls") != F.col("_pivot"))).select(F.col("_pivot").alias("a"), F.col("cls").alias("b"))
    rest = measured.filter(~near).select(F.col("node").alias("grp"), "cls", "n", "similarity")
    reaching = rest.filter(F.col("similarity") * 100 >= 2 * threshold.percent - 100 - 1e-9).select("grp").distinct()
    linked = measured.filter(near).select(F.col("node").alias("grp"), "cls", "n")
    members = rest.drop("similarity").unionByName(linked.join(reaching, "grp", "left_semi"))
    return links, against(rest.drop("similarity"), members)


# ---------------------------------------------------------------- all together


def link_classes(docs: DataFrame, classes: DataFrame, threshold: Threshold) -> DataFrame:
    """``node, root`` of all classes that are linked to another."""
    leaves, large = grow(classes, threshold)
    met = candidates(leaves, classes, threshold).unionByName(large.select(F.col("pivot").alias("a"), F.col("cls").alias("b")))
    groups = components(met)
    named = groups.select(F.col("node").alias("cls"), F.col("root").alias("grp"))
    sets = full_sets(docs, named.join(classes.select("cls", "rep", "mark"), "cls").select("cls", "rep", "mark"))
    members = named.join(sets.select("cls", "n"), "cls").select("grp", "cls", "n")
    sizes = store(_sized(members), "sizes")
    sized = store(spread_join(members, sizes, "grp", "size", "cls").select("grp", "cls", "n", "size"), "sized")
    links = settle(in_blocks(sized.filter(F.col("size") <= DIRECT).select("grp", "cls", "n")), sets, threshold)
    big = sized.filter(F.col("size") > DIRECT).select("cls", "n")
    if not big.isEmpty():
        nodes = leaves.select("node", "cls").join(big, "cls").select(F.col("node").alias("grp"), "cls", "n")
        links = links.unionByName(settle(in_blocks(nodes), sets, threshold))
        wide = large.join(big.select("cls"), "cls", "left_semi")
        if not wide.isEmpty():
            direct, rest = by_pivot(wide, sets, threshold)
            links = links.unionByName(direct).unionByName(settle(rest, sets, threshold))
    return components(links)


def cluster(docs: DataFrame, percent: int = 85, *more: str) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every row, and its columns ``more``."""
    threshold = Threshold(percent)
    rows = sketch(docs, *more)
    classes = store(
        rows.filter(F.col("cls").isNotNull()).groupBy("cls")
        .agg(
            F.min("doc_id").alias("rep"), F.min_by("mark", "doc_id").alias("least"), F.min("mark").alias("any"),
            F.count("*").alias("copies"), F.first("tokens").alias("tokens"),
        )
        # Without an id, any text of the class will do.
        .select("cls", "rep", F.when(F.col("rep").isNull(), F.col("any")).otherwise(F.col("least")).alias("mark"), "copies", "tokens"),
        "classes",
    )
    found = link_classes(docs, classes, threshold)
    rooted = classes.select("cls", "rep", "copies").join(found.withColumnRenamed("node", "cls"), "cls", "left")
    linked = rooted.filter(F.col("root").isNotNull())
    firsts = linked.groupBy("root").agg(F.min("rep").alias("first"), F.count("*").alias("n"))
    resolved = spread_join(linked, store(firsts, "firsts"), "root", "n", "cls").select("cls", "copies", "first")
    alone = rooted.filter(F.col("root").isNull()).select("cls", "copies", F.col("rep").alias("first"))
    named = store(resolved.unionByName(alone), "resolved")
    out = spread_join(rows.select("doc_id", "n_shingles", "cls", *more), named, "cls", "copies", "doc_id", "left")
    first = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("first"))
    return out.select("doc_id", "n_shingles", first.alias("component_id"), F.col("doc_id").eqNullSafe(first).alias("kept"), *more)


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The documents without those that are near-duplicates of one with a smaller id.

    Rows are told apart by id and text, so others that share the id of one that goes (NULL included) stay. Of
    near-duplicates that all have the kept id every one stays.
    """
    found = cluster(docs.select("doc_id", "text", _mark().alias("_text")), percent, "_text")
    key, print_ = free("_gone", docs), free("_text", docs)
    gone = store(found.filter(~F.col("kept")).select(F.col("doc_id").alias(key), F.col("_text").alias(print_)).distinct(), "near-duplicates")
    hinted = F.broadcast(gone) if gone.count() <= 400_000 else gone.hint("shuffle_hash")
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (_mark() == F.col(print_))
    return docs.join(hinted, same, "left_anti").select(*docs.columns)
