import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from sluiceworks.llm import packing

PATH = public_tokenizers.path(packing.VOCABULARY)


def reference():
    return Tokenizer.from_file(PATH)


def test_ids_are_those_of_the_vocabulary(documents):
    own, other = packing.Tokens(PATH), reference()
    texts = [r["text"] for r in documents.limit(60).collect()]
    texts += ["", " ", "  a  b\n c", "\x1c x", "a　 b c", "<|endoftext|> hi", "x<|endoftext|>y", "<|endoftext|><|endoftext|>", "a  <|endoftext|>\n\n b <|endoftext", "<|endoftext|>", "it's  \n\n  x ", "x" * 5000, "é́ \U0001f600"]
    for text in texts:
        assert own.ids(text) == np.array(other.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.text(alphabet="ab '.\n\t \x1cé1", max_size=40), st.just("<|endoftext|>")), max_size=4).map("".join))
def test_any_white_space(text):
    own, other = packing._tokens(PATH), reference()
    assert own.ids(text) == np.array(other.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def check(rows, docs, capacity):
    other = reference()
    want = Counter()
    for d in docs:
        ids = [*other.encode(d["text"] or "", add_special_tokens=False).ids, packing.END]
        cuts = [0, *range(len(ids) % capacity or capacity, len(ids) + 1, capacity)]
        for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
            want[d["doc_id"], piece, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == want
    places = defaultdict(list)
    for r in rows:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for spots in places.values():
        end = 0
        for offset, length in sorted(spots):
            assert offset == end
            end += length
        assert end <= capacity
    return len(places)


@pytest.mark.parametrize("capacity", [2048, 64])
def test_pack(documents, capacity):
    docs = documents.limit(80)
    rows = packing.pack(docs, capacity).collect()
    n = check(rows, docs.collect(), capacity)
    assert n <= 1.02 * sum(r["length"] for r in rows) / capacity + 2


def test_odd_rows(odd):
    rows = packing.pack(odd.selectExpr("*", "1 AS piece", "2 AS length", "3 AS _row")).collect()
    check(rows, odd.collect(), 2048)
    assert packing.pack(odd.limit(0)).collect() == []


def test_sequences_hold_the_ids(documents):
    packed = packing.pack(documents.limit(30), 256, with_ids=True)
    for r in packing.sequences(packed).collect():
        assert len(r["ids"]) == 4 * sum(d["length"] for d in r["documents"]) <= 1024
        at = 0
        for d in r["documents"]:
            assert d["offset"] == at
            at += d["length"]


def fewest(counts, capacity):
    """Exhaustive search, for small cases."""
    items = sorted((s for s, n in counts.items() for _ in range(n)), reverse=True)
    best = [len(items)]

    def put(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity and bins[k] not in bins[:k]:
                put(i + 1, [*bins[:k], bins[k] + items[i], *bins[k + 1 :]])
        put(i + 1, [*bins, items[i]])

    put(0, [])
    return best[0]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=11))
def test_plan_is_right_and_close_to_optimal(sizes):
    counts = dict(Counter(sizes))
    fillings = packing.plan(counts, 20)
    used = Counter()
    for filling, n in fillings:
        assert sum(filling) <= 20
        for s in filling:
            used[s] += n
    assert used == Counter(counts)
    n = sum(n for _, n in fillings)
    least = fewest(counts, 20)
    assert packing.bound(counts, 20) <= least <= n <= sum(n for _, n in packing.best_fit(counts, 20))
    assert n == least


def test_branching_beats_best_fit():
    counts = {6: 2, 5: 2, 4: 2, 3: 1, 2: 2, 7: 1}
    assert sum(n for _, n in packing.plan(counts, 10)) == fewest(counts, 10)


def test_counts_of_any_size():
    counts = {1500: 10**12, 548: 10**12, 700: 3 * 10**11}
    fillings = packing.plan(counts, 2048)
    assert sum(n for _, n in fillings) == 10**12 + 15 * 10**10  # no 700 goes with a 1500
