import re

import pytest

from sluiceworks.llm import quality

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    seen, places = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            places.update(p for i in at for p in range(i, i + 8))
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(places),
        "base_failed": n < 20 or 100 * len(places) > 30 * n,
    }


@pytest.mark.parametrize("which", ["documents", "odd"])
def test_base_counts(which, request):
    docs = request.getfixturevalue(which)
    got = sorted(map(str, (r.asDict() for r in quality.measure(docs).select("doc_id", *brute("")).collect())))
    assert got == sorted(str({"doc_id": d["doc_id"], **brute(d["text"])}) for d in docs.collect())


def test_report_keeps_clean_documents(spark, folder, documents):
    got = {r["doc_id"]: r for r in quality.report(documents).collect()}
    labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
    passed = [x for x in labels if not got[x["doc_id"]]["base_failed"]]
    clean = [x for x in passed if x["quality"] == 1]
    junk = [x for x in passed if x["quality"] == 0]
    assert sum(got[x["doc_id"]]["kept"] for x in clean) >= 0.95 * len(clean)
    assert sum(got[x["doc_id"]]["kept"] for x in junk) <= 0.3 * len(junk)
    assert not any(r["kept"] and r["base_failed"] for r in got.values())


def test_quantiles_of_sketches(spark):
    rows = [("en", "s", False, i / 100) for i in range(1, 1001)]
    frame = spark.createDataFrame(rows, "lang string, source string, base_failed boolean, v double")
    wide = frame.selectExpr("lang", "source", "base_failed", *[f"v AS {m}" for m in quality.METRICS])
    halves = [quality.sketch(wide.filter(f"v * 100 % 2 < 1 = {b}")) for b in ("true", "false")]
    merged = quality.merge(halves[0].unionByName(halves[1]), "lang")
    fence = quality.fences(merged, "lang").filter("metric = 'chars_per_word'").first()
    assert fence["docs"] == 1000
    assert fence["high"] == pytest.approx(7.5 + 3 * 5.0, rel=0.03)
    assert fence["low"] == pytest.approx(2.5 - 3 * 5.0, rel=0.03)


def test_odd_and_empty(odd):
    got = quality.report(odd.selectExpr("*", "1 AS kept", "2 AS key")).collect()
    assert len(got) == odd.count()
    assert quality.report(odd.limit(0)).collect() == []


def test_shuffled_thresholds_give_the_same(documents, monkeypatch):
    want = sorted(map(str, quality.report(documents).collect()))
    join = quality.spread_join
    monkeypatch.setattr(quality, "spread_join", lambda *a: join(*a, share=4, small=0))
    assert sorted(map(str, quality.report(documents).collect())) == want
