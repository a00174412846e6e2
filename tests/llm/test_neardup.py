import itertools
import random

import numpy as np
import pytest

from sluiceworks.llm import components, neardup

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shingles(text):
    words = (text or "").encode().translate(LOWER).split()
    if 0 < len(words) < 5:
        return {tuple(words)}
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


class Union:
    def __init__(self):
        self.parent = {}

    def find(self, x):
        self.parent.setdefault(x, x)
        while self.parent[x] != x:
            x = self.parent[x]
        return x

    def join(self, x, y):
        x, y = sorted((self.find(x), self.find(y)))
        self.parent[y] = x


def brute(rows, percent):
    sets = [(i, shingles(t)) for i, t in rows]
    groups, by_gram = Union(), {}
    for k, (_, s) in enumerate(sets):
        groups.find(k)
        for j in {j for g in s for j in by_gram.get(g, ())}:
            both = len(s & sets[j][1])
            if 100 * both >= percent * len(s | sets[j][1]):
                groups.join(j, k)
        for g in s:
            by_gram.setdefault(g, []).append(k)
    first = {}
    for k, (i, _) in enumerate(sets):
        root = groups.find(k)
        first[root] = i if first.get(root) is None else first[root] if i is None else min(first[root], i)
    return sorted(
        ((i, len(s), first[groups.find(k)], i == first[groups.find(k)]) for k, (i, s) in enumerate(sets)), key=repr
    )


def result(docs, percent=85):
    got = neardup.cluster(docs, percent).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got), key=repr)


def rows_of(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]


def test_like_brute_force(documents):
    assert result(documents) == brute(rows_of(documents), 85)


def near_copies(n, words=120):
    """A chain of copies, each with a few words changed, a group of copies of one text, and strangers."""
    draw = random.Random(11)
    text = [f"w{draw.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        copy = list(text)
        for _ in range(draw.randrange(5)):
            copy[draw.randrange(words)] = f"x{draw.randrange(10**6)}"
        out.append(" ".join(copy))
        if i % 10 == 0:
            text = copy
    out += ["The Same text on every page of the site"] * n
    out += [" ".join(f"z{draw.randrange(10**6)}" for _ in range(40)) for _ in range(n)]
    return list(enumerate(out))


def test_large_groups_by_blocks_nodes_and_pivots(docs_of, monkeypatch):
    rows = near_copies(150)
    docs = docs_of(*rows)
    want = brute(rows, 85)
    for name, value in (("LEAF", 16), ("GROUP", 24)):
        monkeypatch.setattr(neardup, name, value)
    assert result(docs) == want  # pairs of blocks
    monkeypatch.setattr(neardup, "DIRECT", 30)  # nodes, pivots, what is left over
    join = neardup.spread_join

    def spread(rows, keyed, key, weight, by, how="inner"):
        return join(rows, keyed, key, weight, by, how, share=64, small=0)

    monkeypatch.setattr(neardup, "spread_join", spread)
    monkeypatch.setattr(components, "spread_join", spread)
    assert result(docs) == want  # and everything shuffled, with hot keys cut


def test_odd_rows(odd):
    more = odd.selectExpr("*", "1 AS cls", "2 AS rep", "3 AS kept", "4 AS tokens")
    assert result(more) == brute(rows_of(odd), 85)
    assert result(odd.limit(0)) == []


def test_threshold_is_exact(docs_of):
    # NULL ids stand by themselves only where a component has no other.
    # 20 shared shingles of 23 and of 24 in all: 86.9 % and 83.3 %.
    base = [f"a{i}" for i in range(24)]
    docs = docs_of((1, " ".join(base)), (2, " ".join([*base, "b1", "b2", "b3"])), (3, " ".join([*base, "c1", "c2", "c3", "c4"])), (4, "X y"), (5, "x  Y"), (None, "n n"), (None, "n n"))
    assert [(r[0], r[2]) for r in result(docs)] == [(1, 1), (2, 1), (3, 3), (4, 4), (5, 4), (None, None), (None, None)]


def test_keep_one(documents):
    kept = neardup.keep_one(documents.selectExpr("*", "1 AS cls"))
    assert kept.columns == [*documents.columns, "cls"]
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r[0] for r in brute(rows_of(documents), 80) if r[3])


def test_keep_one_with_null_and_repeated_ids(docs_of):
    text = " ".join(f"w{i}" for i in range(200))
    other, third = (" ".join(f"{c}{i}" for i in range(50)) for c in "xy")
    docs = docs_of((1, text), (None, text + " end"), (None, other), (None, None), (3, third), (3, "start " + text), (4, text), (4, text), (4, ""))
    kept = [(r["doc_id"], r["text"]) for r in neardup.keep_one(docs).collect()]
    assert sorted(kept, key=repr) == sorted([(1, text), (None, other), (None, None), (3, third), (4, "")], key=repr)


def test_recall_of_the_trees(spark):
    """Pairs at the threshold meet in some leaf."""
    draw = np.random.default_rng(4)
    sets = []
    for _ in range(300):
        both, own = draw.integers(0, 2**63, 170, dtype=np.uint64), draw.integers(0, 2**63, (2, 15), dtype=np.uint64)
        sets += [np.unique(np.r_[both, o]) for o in own]
    rows = [(k, bytearray(neardup.tokens_of(s).tobytes())) for k, s in enumerate(sets)]
    classes = spark.createDataFrame(rows, "cls long, tokens binary").cache()
    leaves, large = neardup.grow(classes, neardup.Threshold(85))
    together = {}
    for r in leaves.unionByName(large).select("node", "cls").collect():
        together.setdefault(r["node"], []).append(r["cls"])
    met = {p for nodes in together.values() for p in itertools.combinations(sorted(nodes), 2)}
    assert sum((2 * k, 2 * k + 1) in met for k in range(300)) == 300


def test_components(spark):
    draw = random.Random(1)
    chain = [(i, i + 1) for i in range(200)]
    star = [(1000, 1001 + i) for i in range(200)]
    loose = [(draw.randrange(2000, 2400), draw.randrange(2000, 2400)) for _ in range(250)]
    groups = Union()
    for a, b in chain + star + loose:
        groups.join(a, b)
    frame = spark.createDataFrame(chain + star + loose + [(3000, 3000)], "a long, b long")
    got = {r["node"]: r["root"] for r in components.components(frame).collect()}
    linked = {x for p in chain + star + loose if p[0] != p[1] for x in p}
    assert got == {x: groups.find(x) for x in linked}
    assert components.components(frame.limit(0)).collect() == []


def test_rows_that_share_an_id_meet_their_own_class_only(spark, docs_of):
    """As many texts as rows with NULL or one id: each is read for its own class, whatever the others hold."""
    import random

    draw = random.Random(5)
    base = [f"w{draw.randint(0, 10**6)}" for _ in range(120)]
    rows = []
    for i in range(400):
        words = list(base)
        words[draw.randint(0, 119)] = f"x{i}"
        rows.append((None if i % 2 else 7, " ".join(words)))
    docs = docs_of(*rows, (7, rows[0][1]), (9, "other words that are by themselves here"))
    found = neardup.cluster(docs, 85).collect()
    assert len(found) == 402
    assert {r["component_id"] for r in found} == {7, 9}
    classes = neardup.sketch(docs).filter("cls IS NOT NULL").groupBy("cls").agg({"doc_id": "min"}).count()
    assert classes == 401


def test_names_in_use(documents):
    given = documents.selectExpr("*", "'mine' AS _text", "4 AS _gone", "5 AS mark", "6 AS tokens")
    assert neardup.keep_one(given).select("_text", "_gone", "mark", "tokens").distinct().collect() == [("mine", 4, 5, 6)]
