import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from sluiceworks.llm import spelling


def counted(rows):
    """Word counts by the rule, character by character."""
    count = Counter()
    for key, text in rows:
        runs, run = [], ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += chr(ord(c) + 32) if "A" <= c <= "Z" else c
            elif run:
                runs.append(run)
                run = ""
        for run in runs:
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def brute_force(words):
    """Every pair of words, compared by removing one character of either or both."""
    holes, near = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            holes[w[:i] + "\0" + w[i + 1 :]].add(w)
            shorter = w[:i] + w[i + 1 :]
            if shorter in words:
                near[w].add(shorter)
                near[shorter].add(w)
    for group in holes.values():
        for w in group:
            near[w] |= group - {w}
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= 2 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items())


def rows_of(found):
    return sorted(tuple(r) for r in found.select("word", "form", "root", "n", "n_near", "form_n").collect())


def same(a, b):
    assert [tuple(str(x) for x in r) for r in a] == [tuple(str(x) for x in r) for r in b]


def test_whole_table_against_brute_force(spark, documents):
    rows = [tuple(r) for r in documents.select("doc_id", "text").collect()]
    want = brute_force(counted(rows))
    assert len(want) > 1000 and any(w[1] for w in want)
    same(rows_of(spelling.variants(documents)), want)


def test_several_rounds_and_long_chains(spark, docs_of):
    # Each word is one character from the next and twice as frequent; all are one chain to one root.
    chain = ["a" * k + "b" * (12 - k) for k in range(8)]
    text = [" ".join(w for k, w in enumerate(chain) for _ in range(3 * 2**k))]
    more = [" ".join(f"{a}{b}{c}dede" for a in "abcde" for b in "éèêàz" for c in "xyzÿß")] * 3
    docs = docs_of(*[(i, t) for i, t in enumerate(text + more)])
    want = brute_force(counted([(i, t) for i, t in enumerate(text + more)]))
    whole = rows_of(spelling.variants(docs))
    same(whole, want)
    same(rows_of(spelling.variants(docs, room=7)), want)
    assert {r[2] for r in whole if r[0] in chain[1:]} <= {chain[-1]} | set(chain)


def test_forms_meet_a_shuffled_table(spark):
    pairs = [(f"w{i:03}", f"w{i // 2:03}") for i in range(1, 200)]
    formed = spark.createDataFrame(pairs + [("w000", None)], "word string, form string")
    want = {w: "w000" for w, _ in pairs}
    assert {r["word"]: r["root"] for r in spelling.roots(formed, small=0).collect()} == want
    assert {r["word"]: r["root"] for r in spelling.roots(formed).collect()} == want


def test_hashes_of_edits():
    words = ["abcde", "aabbccdd", "éàüß", "a"]
    own = spelling.Spelled(words)
    at = np.arange(len(own.points))
    shorter = [w[:i] + w[i + 1 :] for w in words for i in range(len(w))]
    assert (own.deletions(at) == spelling.Spelled(shorter).hashes()).all()
    other = [w[:i] + "ÿ" + w[i + 1 :] for w in words for i in range(len(w))]
    assert (own.replacements(at, np.full(len(at), ord("ÿ"), np.uint32)) == spelling.Spelled(other).hashes()).all()


def test_filters_hold_every_word(spark):
    words = [f"word{i:05}" for i in range(5000)] + ["longer" * k for k in range(1, 30)]
    vocabulary = spelling.with_hashes(spark.createDataFrame([(w, 3) for w in words], "word string, n long"))
    layout = spelling.Layout({r["length"]: r["count"] for r in vocabulary.groupBy("length").count().collect()})
    blocks = {r["block"]: r["bits"] for r in spelling.filter_blocks(vocabulary, layout).collect()}
    assert set(blocks) <= set(range(layout.total))

    def held(some):
        own = spelling.Spelled(some)
        place = layout.place(own.lengths, own.hashes())
        masks = spelling._mask(own.hashes()).view(np.int64)
        return [p >= 0 and blocks.get(p, 0) & m == m for p, m in zip(place.tolist(), masks.tolist(), strict=True)]

    assert all(held(words))
    assert sum(held([f"void{i:05}" for i in range(5000)])) < 100


@pytest.mark.parametrize("word", ["ab" * 4000, "é" * 3000])
def test_very_long_words(spark, docs_of, word):
    texts = [f"{word} {word} {word} {word[1:]} {word[1:]} {word[1:]} {word[1:]} {word[1:]} {word[1:]}"] * 2
    rows = list(enumerate(texts))
    same(rows_of(spelling.variants(docs_of(*rows))), brute_force(counted(rows)))


def test_odd_rows(spark, odd):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect()] * 2
    docs = odd.unionByName(odd).withColumns({"word": F.lit(1), "n": F.lit("n"), "id": F.lit(0), "root": F.lit(None).cast("int")})
    same(rows_of(spelling.variants(docs)), brute_force(counted(rows)))
    assert spelling.variants(odd.limit(0)).count() == 0
    nothing = spelling.variants(odd.withColumn("text", F.lit(None).cast("string")))
    assert nothing.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert nothing.count() == 0
