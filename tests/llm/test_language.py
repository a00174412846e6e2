import zlib

from sluiceworks.llm import language


def test_held_out_accuracy(documents):
    got = {r["doc_id"]: r for r in language.identify(documents).collect()}
    docs = documents.collect()
    assert len(got) == len(docs)
    held = [d for d in docs if zlib.crc32(str(d["doc_id"]).encode()) % 3 == 1]
    assert all(got[d["doc_id"]]["held_out"] for d in held)
    assert sum(r["held_out"] for r in got.values()) == len(held)
    right = sum(got[d["doc_id"]]["lang_pred"] == d["lang"] for d in held)
    assert right >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_ids_and_sources_are_no_inputs(documents):
    a = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.identify(documents, documents).collect()}
    b = language.identify(documents.selectExpr("doc_id", "text"), documents)
    assert a == {r["doc_id"]: (r["lang_pred"], r["score"]) for r in b.collect()}


def test_odd_rows(odd, documents):
    got = language.identify(odd, documents).collect()
    assert len(got) == odd.count()
    by_id = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    for i in (1, 2, 3, 8):
        assert (by_id[i]["lang_pred"], by_id[i]["score"]) == ("und", 0.0)
    assert by_id[4]["lang_pred"] != "und"
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False, False]


def test_nothing_to_learn_from(spark, odd):
    empty = odd.limit(0)
    assert language.identify(empty).collect() == []
    assert {r["lang_pred"] for r in language.identify(odd, empty).collect()} == {"und"}


def test_clashing_columns_pass_through(odd, documents):
    more = odd.selectExpr("*", "1 AS _lang_pred", "2 AS score", "3 AS held_out")
    model = language.fit(documents)
    out = language.predict(more, model)
    assert out.filter("score = 2 AND held_out = 3").count() == odd.count()
    kept = language.accepted(documents.selectExpr("*", "7 AS score"))
    assert kept.columns == [*documents.columns, "score"]
    assert kept.count() >= 0.98 * documents.count()


def test_any_number_of_languages(spark, docs_of):
    """More languages than a matrix holds: the same answers in rounds, names and scores."""
    import random

    draw = random.Random(1)
    letters = [chr(0x3B1 + i) for i in range(24)] + [chr(97 + i) for i in range(26)]
    rows = []
    for n in range(600):
        own = draw.sample(letters, 3)
        rows += [(3 * n + k, " ".join("".join(draw.choices(own, k=4)) for _ in range(30)), f"l{n:04}") for k in range(3)]
    docs = docs_of(*rows, (9999, None, "l0001"), (9998, "12", None), (9997, "", "l0002"))
    one = language.predict(docs, language.fit(docs, 12, block=1000)).collect()
    many = language.fit(docs, 12, block=90)
    assert len(many) == 7
    got = {r["doc_id"]: (r["_lang_pred"], r["_lang_score"]) for r in language.predict(docs, many).collect()}
    for r in one:
        assert got[r["doc_id"]][0] == r["_lang_pred"]
        assert abs(got[r["doc_id"]][1] - r["_lang_score"]) < 1e-9
    assert got[9999] == got[9998] == ("und", 0.0)
    learned = [r for r in one if zlib.crc32(str(r["doc_id"]).encode()) % 3 != 1 and r["lang"]]
    assert sum(r["_lang_pred"] == r["lang"] for r in learned) > 0.9 * len(learned)


def test_against_brute_force(docs_of):
    """Every likelihood added up n-gram by n-gram from counts of the training texts."""
    import numpy as np

    rows = [(i, t, lang) for i, (t, lang) in enumerate([("aab ab", "x"), ("abb bba b", "y"), ("ab ab aa", "x"), ("bbb ba", "y"), ("cab", "z")] * 8)]
    learned = [(t, lang) for i, t, lang in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    bits = 10

    def buckets(text):
        return [int(b) for bucket, _, _ in language._grams([text], bits) for b in bucket]

    names = sorted({lang for _, lang in learned})
    counts = {lang: np.full(1 << bits, language.ALPHA) for lang in names}
    for t, lang in learned:
        for b in buckets(t):
            counts[lang][b] += 1
    docs = docs_of(*rows)
    for r in language.predict(docs, language.fit(docs, bits)).collect():
        grams = buckets(r["text"])
        total = {
            lang: np.log(sum(x == lang for _, x in learned) / len(learned)) + sum(np.log(c[b] / c.sum()) for b in grams)
            for lang, c in counts.items()
        }
        best = max(names, key=lambda lang: total[lang])
        assert r["_lang_pred"] == best
        heat = max(1.0, len(grams) / 100)
        assert abs(r["_lang_score"] - 1 / sum(np.exp((v - total[best]) / heat) for v in total.values())) < 1e-4


def test_a_given_column_of_that_name_is_kept(odd, documents):
    kept = language.accepted(documents.selectExpr("*", "'mine' AS _lang_pred", "3 AS _lang_score"))
    assert kept.select("_lang_pred", "_lang_score").distinct().collect() == [("mine", 3)]
