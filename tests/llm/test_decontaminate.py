import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from sluiceworks.llm import decontaminate as d
from sluiceworks.llm.common import texts_of

WORD = re.compile(r"[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall((text or "").lower())


def grams(found, width):
    return {tuple(found[i : i + width]) for i in range(len(found) - width + 1)}


def brute(docs, items):
    """Every passage against every item by plain BM25, then the overlaps."""
    items = [(i, words(t)) for i, t in items if words(t)]
    df = Counter(w for _, ws in items for w in set(ws))
    mean = sum(len(ws) for _, ws in items) / len(items)
    idf = {w: math.log1p((len(items) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    span = max(len(ws) for _, ws in items)
    out = set()
    for doc, text in docs:
        ws = words(text)
        starts = list(range(0, len(ws), span))
        for item, own in items:
            count = Counter(own)
            weight = {w: idf[w] * c * (d.K1 + 1) / (c + d.K1 * (1 - d.B + d.B * len(own) / mean)) for w, c in count.items()}
            cut = len(own) - max(1, round(d.ANSWER_SHARE * len(own)))
            parts = [grams(p, min(d.GRAM, len(p))) for p in (own[:cut], own[cut:])]
            for a in starts:
                passage = ws[a : a + 2 * span]
                have = set(passage)
                if sum(x for w, x in weight.items() if w in have) < d.THRESHOLD * sum(weight.values()) - 1e-9:
                    continue
                shares = [len({g for g in p if g in grams(passage, len(g))}) / len(p) if p else 1.0 for p in parts]
                if shares[0] >= d.MIN_QUESTION and shares[1] >= d.MIN_ANSWER:
                    out.add((doc, item))
    return out


@pytest.fixture(scope="module")
def benchmark_items(spark, folder):
    return spark.read.parquet(f"{folder}/benchmark.parquet")


def found(docs, items, **more):
    return {(r["doc_id"], r["item_id"]) for r in d.matches(docs, items, **more).collect()}


def test_like_brute_force(documents, benchmark_items):
    docs = documents.limit(70).collect()
    items = benchmark_items.collect()
    want = brute([(r["doc_id"], r["text"]) for r in docs], [(r["item_id"], r["text"]) for r in items])
    got = found(documents.limit(70), benchmark_items)
    assert got == want


def test_planted_passages_and_clean_documents(documents, benchmark_items):
    items = {r["item_id"]: words(r["text"]) for r in benchmark_items.collect()}
    five = {i: grams(ws, 5) for i, ws in items.items()}
    got = found(documents, benchmark_items)
    for r in documents.collect():
        have = grams(words(r["text"]), 5)
        for i, g in five.items():
            share = len(g & have) / len(g)
            if share >= 0.8:
                assert (r["doc_id"], i) in got
            if share < 0.2:
                assert (r["doc_id"], i) not in got


def test_rounds_of_a_large_benchmark(documents, benchmark_items):
    assert found(documents, benchmark_items, chars=1000) == found(documents, benchmark_items)


def test_scores_do_not_depend_on_the_rounds(documents, benchmark_items):
    """Same scores and passages from one index and from many, and one index like plain numpy."""
    one, many = (sorted(map(tuple, d.matches(documents, benchmark_items, chars=c).collect())) for c in (d.INDEX_CHARS, 1000))
    assert one and one == many
    assert len(d.indexes(benchmark_items, 1000)) > 1
    rows = benchmark_items.orderBy("item_id", "text").collect()
    alone = d.build([r["item_id"] for r in rows], [r["text"] for r in rows])
    given = d.indexes(benchmark_items)[0].value
    assert alone.span == given.span and all(np.array_equal(a.impacts, b.impacts) for a, b in zip(alone.items, given.items, strict=True))


def test_clean(documents, benchmark_items):
    hit = {a for a, _ in found(documents, benchmark_items)}
    more = documents.selectExpr("*", "1 AS score", "2 AS item_id")
    for chars in (1000, d.INDEX_CHARS):
        kept = d.clean(more, benchmark_items, chars=chars)
        assert kept.columns == more.columns
        assert sorted(r["doc_id"] for r in kept.collect()) == sorted(r["doc_id"] for r in documents.collect() if r["doc_id"] not in hit)


def test_bounds_lose_nothing():
    draw = np.random.default_rng(2)
    texts = [" ".join(f"w{x}" for x in draw.integers(0, 60, 12)) for _ in range(40)]
    docs = [" ".join(f"w{x}" for x in draw.integers(0, 60, 30)) + " " + texts[i] for i in range(40)]
    index = d.build(list(range(40)), texts)
    got = {(i, m["item_id"]) for i, each in enumerate(d.search(index, texts_of(pa.array(docs)))) for m in each}
    assert got == brute(list(enumerate(docs)), list(enumerate(texts))) and {(i, i) for i in range(40)} <= got


def test_odd_rows(spark, odd, docs_of, benchmark_items):
    item = "What is the answer to the great question of life, asked in 1979? Forty-two, of course."
    items = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (None, "one two three four five six seven eight")], "item_id long, text string")
    docs = docs_of((1, "x " * 500 + item.upper() + " y" * 500), (1, item), (None, item), (2, item[:30]), (3, "ONE, two; three four-five six seven eight!"))
    got = Counter((r["doc_id"], r["item_id"]) for r in d.matches(docs, items).collect())
    assert got == {(1, 1): 4, (None, 1): 2, (3, None): 1}
    assert d.matches(odd.limit(0), items).collect() == []
    assert d.matches(odd, items.limit(0)).collect() == []
    assert d.clean(odd, items.limit(0)).count() == odd.count()
