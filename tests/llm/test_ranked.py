import math
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sluiceworks.llm import queries, ranked

SPLIT = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t) for t in SPLIT.findall(text or "")]


def brute_force(docs, items, k=10):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    total, words = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for d, b, n in bags:
            m = 10 + (90 * n * total) // words
            score = 0
            for t in set(terms(text)):
                if b[t]:
                    w = math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                    score += w * ((1000000000 * b[t]) // (1000 * b[t] + 8 * m))
            if score > 0:
                found.append((-score, d is None, d or 0, d))
        out += [(item, r, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def rows_of(found):
    return sorted((tuple(r) for r in found.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@pytest.fixture(scope="module")
def words():
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(400)]

    def text(n):
        return " ".join(vocabulary[int(400 * rng.random() ** 2)] for _ in range(n))

    docs = [(i, text(int(rng.integers(1, 120)))) for i in range(1500)]
    docs += [(5000 + i, docs[3][1]) for i in range(700)]  # a third are copies
    return docs, [(i, text(30)) for i in range(37)]


def test_whole_tables_against_sql(spark, folder):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    assert rows_of(queries.op13_ranked_search(spark, folder)) == sorted(con.sql(ranked.SQL).fetchall(), key=str)


@pytest.mark.parametrize("chars, seeds, levels", [(8_000_000, 4096, None), (900, 16, None), (8_000_000, 64, (16, 4, 2, 1))])
def test_against_brute_force(spark, docs_of, monkeypatch, words, chars, seeds, levels):
    docs, items = words
    if levels:
        monkeypatch.setattr(ranked, "ITEM_LEVELS", levels)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = ranked.rank(docs_of(*docs).repartition(5), bench, chars=chars, seeds=seeds)
    assert rows_of(found) == brute_force(docs, items)


def _local(words, floor=None, cells=None, order=None, monkeypatch=None):
    docs, items = words
    names = sorted({t for _, text in items for t in terms(text)})
    place = {t: i for i, t in enumerate(names)}
    own = [np.unique([place[t] for t in terms(text)]) for _, text in items]
    bags = [Counter(terms(t)) for _, t in docs]
    n = np.array([sum(b.values()) for b in bags], np.int64)
    df = np.array([sum(t in b for b in bags) for t in names])
    tree = ranked.Items(own, ranked.weights(len(docs), df))
    best = ranked.Search(tree, np.zeros(len(items), np.int64) if floor is None else floor)
    order = np.arange(len(docs)) if order is None else order
    for lo in range(0, len(docs), 512):
        part = order[lo : lo + 512]
        entries = [(i, place[t], c) for i, d in enumerate(part) for t, c in sorted(bags[d].items()) if t in place]
        doc, term, tf = (np.array(x, np.int64) for x in zip(*entries, strict=True))
        best.batch(pa.array([docs[d][0] for d in part]), n[part], doc, term, tf, len(docs), int(n.sum()))
    rows = best.keep().to_pylist()
    return best, sorted((items[tree.rows[r["item"]]][0], r["doc_id"], r["score"]) for r in rows)


def test_pairs_are_pruned_and_none_is_lost(words):
    docs, items = words
    want = sorted((i, d, s) for i, _, d, s in brute_force(docs, items))
    plain, found = _local(words)
    assert found == want
    again, found = _local(words, floor=plain.kth)
    assert found == want
    assert again.scored < plain.scored < len(docs) * len(items)


def test_sums_beyond_doubles(words, monkeypatch):
    monkeypatch.setattr(ranked, "EXACT", 0)
    monkeypatch.setattr(ranked, "CELLS", 1 << 10)
    docs, items = words
    assert _local(words)[1] == sorted((i, d, s) for i, _, d, s in brute_force(docs, items))


def test_odd_rows(spark, odd):
    items = [(1, "same TEXT again"), (1, "same TEXT again"), (2, None), (3, "...  "), (None, "word5x5 a"), (4, "\U0001f600 é odd"), (5, "12 34")]
    bench = spark.createDataFrame([(*i, "x") for i in items], "item_id long, text string, doc_id string")
    docs = [(r["doc_id"], r["text"]) for r in odd.collect()]
    clash = odd.withColumns({"item_id": F.lit("i"), "n": F.lit(0.5), "term": F.lit(1), "rank": F.lit(2), "_key": F.lit(0)})
    assert rows_of(ranked.rank(clash, bench)) == brute_force(docs, items)
    assert ranked.rank(odd.limit(0), bench).count() == 0
    nothing = ranked.rank(odd, bench.limit(0))
    assert nothing.columns == ["item_id", "rank", "doc_id", "score"]
    assert nothing.count() == 0
