from collections import defaultdict

import pytest

from sluiceworks.llm import lines

BLANK = " \t\n\x0b\x0c\r"


def brute(rows, min_sites):
    sites, first = defaultdict(set), {}
    for d in rows:
        for line in (d["text"] or "").split("\n"):
            key = line.strip(BLANK)
            if key:
                sites[key].add(d["source"])
                if d["doc_id"] is not None:
                    first[key] = min(first.get(key, d["doc_id"]), d["doc_id"])
    out = []
    for d in rows:
        text = d["text"]
        if text is not None:
            text = "\n".join(
                x for x in text.split("\n")
                if len(sites.get(x.strip(BLANK), ())) < min_sites or d["doc_id"] == first.get(x.strip(BLANK))
            )
        out.append((d["doc_id"], text))
    return sorted(out, key=repr)


def result(docs, min_sites):
    return sorted(((r["doc_id"], r["text"]) for r in lines.dedup(docs, min_sites).collect()), key=repr)


@pytest.mark.parametrize("min_sites", [2, lines.MIN_SITES, 12])
def test_like_brute_force(documents, min_sites):
    assert result(documents, min_sites) == brute(documents.collect(), min_sites)


def test_odd_rows(odd):
    assert result(odd, 2) == brute(odd.collect(), 2)
    assert lines.dedup(odd.limit(0)).collect() == []


def test_rows_of_one_id_and_null_ids(docs_of):
    docs = docs_of((1, " x \ny", "", "a"), (1, "x", "", "b"), (2, "x\nx\n\nz", "", "c"), (None, "x", "", None))
    got = {(r["doc_id"], r["text"], r["n_removed"]) for r in lines.dedup(docs, 3).collect()}
    assert got == {(1, " x \ny", 0), (1, "x", 0), (2, "\nz", 2), (None, "", 1)}


def test_shuffled_joins_give_the_same(documents, monkeypatch):
    want = result(documents, 3)
    join = lines.spread_join
    monkeypatch.setattr(lines, "spread_join", lambda *a: join(*a, share=8, small=0))
    monkeypatch.setattr(lines, "SMALL_DROPS", 0)
    assert result(documents, 3) == want


def test_no_python_in_the_plan(documents):
    plan = lines.dedup(documents.selectExpr("*", "1 AS n_removed", "2 AS key"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_passages(documents, docs_of):
    """Lines of 50 words or more go from all but the first document, on whatever sites."""
    long, short = (" ".join(f"w{i}" for i in range(n)) for n in (50, 49))
    docs = docs_of(
        (1, f"{short}\n{long}\na", "", "s"), (2, f"{short}\n \t{long} \nb", "", "s"), (None, long, "", "t"),
        (3, f"x {long}\nc\nx {long}", "", "s"), (3, None, "", "s"),
    )
    got = {(r["doc_id"], r["text"], r["n_removed"]) for r in lines.without_passages(docs).collect()}
    assert got == {
        (1, f"{short}\n{long}\na", 0), (2, f"{short}\nb", 1), (None, "", 1), (3, f"x {long}\nc\nx {long}", 0), (3, None, 0)
    }
    left, seen = lines.without_passages(documents).collect(), {}
    for r in left:
        for line in (r["text"] or "").split("\n"):
            if len(line.split()) >= 50:
                assert seen.setdefault(line.strip(BLANK), r["doc_id"]) == r["doc_id"]
    assert sum(r["n_removed"] for r in left) > 0


def test_names_in_use(documents):
    given = documents.selectExpr("*", "'mine' AS _drop", "4 AS _doc", "5 AS _left", "6 AS n_removed")
    for cleaned in (lines.dedup(given, counter="gone"), lines.without_passages(given, counter="gone")):
        assert cleaned.select("_drop", "_doc", "_left", "n_removed").distinct().collect() == [("mine", 4, 5, 6)]
        assert cleaned.agg({"gone": "sum"}).first()[0] > 0
