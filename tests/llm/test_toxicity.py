import math
import zlib
from collections import Counter

import numpy as np
import pytest

from sluiceworks.llm import toxicity


@pytest.fixture(scope="module")
def larger(spark):
    base = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{base}/documents.parquet"), spark.read.parquet(f"{base}/labels.parquet")


def test_held_out_documents(larger):
    docs, labels = larger
    got = {r["doc_id"]: r for r in toxicity.score(docs, labels).collect()}
    assert len(got) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got.values())
    held = [x for x in labels.collect() if zlib.crc32(str(x["doc_id"]).encode()) % 3 == 1]
    assert all(got[x["doc_id"]]["held_out"] for x in held)
    toxic = np.array([got[x["doc_id"]]["score"] for x in held if x["toxic"]])
    clean = np.array([got[x["doc_id"]]["score"] for x in held if not x["toxic"]])
    assert (toxic[:, None] > clean[None, :]).mean() >= 0.85
    assert (clean >= 0.7).mean() <= 0.05


def test_only_text_and_learnable_labels_count(larger):
    docs, labels = larger
    held = "crc32(cast(cast(doc_id AS string) AS binary)) % 3 = 1"
    flipped = labels.selectExpr("doc_id", f"IF({held}, 1 - toxic, toxic) AS toxic")
    a = {r["doc_id"]: r["score"] for r in toxicity.score(docs, labels).collect()}
    more = docs.selectExpr("doc_id", "text", "1 AS evidence", "2 AS toxic", "3 AS score")
    b = {r["doc_id"]: r["score"] for r in toxicity.score(more, flipped).collect()}
    assert a == pytest.approx(b, abs=1e-9)


def words(text):
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def spell(word):
    padded = " " * (toxicity.ORDER - 1) + word + " "
    return [padded[i : i + toxicity.ORDER] for i in range(len(padded) - toxicity.ORDER + 1)]


def test_ratios_like_brute_force(spark):
    rows = [("you fool, you absolute fool", 1), ("foolish of me; to fool with tools", 0), ("the tool is cool", 0), ("cool é 12", 1), (None, 1), ("", 0)]
    frame = spark.createDataFrame(rows, "text string, toxic int")
    counts = [Counter(), Counter()]
    for text, side in rows:
        for word in words(text or ""):
            counts[side].update(spell(word))
    grams = toxicity.count_grams(frame)
    assert {r["gram"]: (r["n_ord"], r["n_tox"]) for r in grams.collect()} == {
        g: (counts[0][g], counts[1][g]) for g in counts[0] | counts[1]
    }
    both, d = set(counts[0] | counts[1]), toxicity.DISCOUNT

    def shared(gram, longer):
        """Kneser-Ney on the number of different characters before."""
        here = Counter(g[1:] for g in longer)
        beside = [n for g, n in here.items() if g[:-1] == gram[:-1]]
        lower = shared(gram[1:], set(here)) if len(gram) > 1 else 1 / len(here)
        return (max(here[gram] - d, 0) + d * len(beside) * lower) / sum(beside)

    def backoff(beside):
        return math.log(d * len(beside) / sum(beside)) if beside else 0.0

    want = {}
    for g in both:
        p, logs = shared(g[1:], both), []
        beside = [[n for h, n in c.items() if h[:-1] == g[:-1]] for c in counts]
        for side in (0, 1):
            mass = max(counts[side][g] - d, 0) + d * len(beside[side]) * p
            logs.append(math.log(mass / sum(beside[side]) if beside[side] else p))
        if beside[1]:
            want[g] = logs[1] - logs[0]
            want[g[:-1]] = backoff(beside[1]) - backoff(beside[0])
    got = {r["gram"]: r["ratio"] for r in toxicity.ratios(grams).collect()}
    assert got == pytest.approx(want)


def test_evidence_by_broadcast_and_by_join(spark, odd, documents):
    known = {g for w in ("same", "text", "word1x1") for g in spell(w)} | {g[:-1] for w in ("same", "word1", "there", "w") for g in spell(w)}
    table = spark.createDataFrame([(g, 0.4 + len(g.strip()) / 10) for g in known], "gram string, ratio double")
    table = table.groupBy("gram").agg({"ratio": "max"}).toDF("gram", "ratio").cache()
    ratio = {r["gram"]: np.float32(r["ratio"]) for r in table.collect()}

    def brute(text):
        found = [max(0.0, sum(float(ratio.get(g, ratio.get(g[:-1], 0))) for g in spell(w)) - toxicity.MARGIN) for w in words(text or "")]
        return sum(found) / len(found) if found else 0.0

    for docs in (odd.select("doc_id", "text"), documents.limit(40).select("doc_id", "text")):
        want = sorted((str(r["doc_id"]), brute(r["text"])) for r in docs.collect())
        for limit in (toxicity.BROADCAST_GRAMS, 0):
            got = sorted((str(r["doc_id"]), r["evidence"]) for r in toxicity.evidence(docs, table, limit).collect())
            assert [g[0] for g in got] == [w[0] for w in want]
            assert [g[1] for g in got] == pytest.approx([w[1] for w in want], abs=1e-5)


def test_whole_texts_with_unseen_n_grams_like_the_two_models(spark, docs_of):
    rows = [("fools and idiots you fool", 1), ("a foolish food idea, idle tool", 0), ("idiot fooling", 1), ("food for all of you", 0)]
    table = toxicity.ratios(toxicity.count_grams(spark.createDataFrame(rows, "text string, toxic int")))
    counts = [Counter(), Counter()]
    for text, side in rows:
        for word in words(text):
            counts[side].update(spell(word))
    d, stored = toxicity.DISCOUNT, {r["gram"]: r["ratio"] for r in table.collect()}

    def difference(gram):
        """Of two models that are asked for any character; only what was seen needs the shared counts."""
        if gram in counts[0] or gram in counts[1]:
            return stored.get(gram, 0.0)
        beside = [[n for g, n in c.items() if g[:-1] == gram[:-1]] for c in counts]
        if not beside[1]:
            return 0.0
        shared = 0.123  # whatever it is
        p = [d * len(b) * shared / sum(b) if b else shared for b in beside]
        return math.log(p[1]) - math.log(p[0])

    texts = ["fooled idiotic fools", "idiotsx fooly foolishness", "unseen words only", "you foox", ""]
    want = []
    for text in texts:
        found = [max(0.0, sum(map(difference, spell(w))) - toxicity.MARGIN) for w in words(text)]
        want.append(sum(found) / len(found) if found else 0.0)
    assert any(g not in counts[0] | counts[1] and difference(g) for t in texts for w in words(t) for g in spell(w))
    docs = docs_of(*enumerate(texts)).select("doc_id", "text")
    for limit in (toxicity.BROADCAST_GRAMS, 0):
        got = {r["doc_id"]: r["evidence"] for r in toxicity.evidence(docs, table, limit).collect()}
        assert [got[i] for i in range(len(texts))] == pytest.approx(want, abs=1e-5)


def test_odd_rows_and_missing_labels(spark, odd):
    labels = spark.createDataFrame([(1, None), (None, 1), (7, 1), (7, 0), (99, 1)], "doc_id long, toxic int")
    assert len(toxicity.score(odd, labels).collect()) == odd.count()
    none = toxicity.score(odd, labels.limit(0)).collect()
    assert len(none) == odd.count() and all(r["score"] < 0.01 for r in none)
    assert toxicity.score(odd.limit(0), labels).collect() == []
