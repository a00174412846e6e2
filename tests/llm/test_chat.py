import hashlib
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from sluiceworks.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
hard = st.text(alphabet="<|\\>im_endstar\n x", max_size=30)


@given(hard)
def test_escape_is_reversible(text):
    assert chat.unescape(chat.escape(text)) == text
    assert "<|" not in chat.escape(text)
    assert chat.unescape_role(chat.escape_role(text)) == text


@given(st.lists(st.tuples(hard, hard), max_size=5))
def test_round_trip(turns):
    assert chat.parse("".join(chat.format_turn(r, t) for r, t in turns)) == turns


def expected(rows):
    by = defaultdict(list)
    for r in rows:
        by[r["conv_id"]].append(r)
    out = {}
    for conv, turns in by.items():
        turns.sort(key=lambda r: (r["turn"] is not None, r["turn"], r["role"] or "", r["text"] or ""))
        loss = "".join(r["text"] or "" for r in turns if r["role"] == "assistant")
        whole = "".join(f"{r['role'] or ''}\n{r['text'] or ''}\n" for r in turns)
        out[conv] = (len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def read_back(frame):
    rows = chat.digest(frame).collect()
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in rows}
    assert len(got) == len(rows)
    return got


@pytest.fixture(scope="module")
def conversations(spark, folder):
    return spark.read.parquet(f"{folder}/conversations.parquet")


@pytest.mark.parametrize(("budget", "history"), [(chat.BUDGET, chat.HISTORY), (200, 60), (1, 0)])
def test_all_turns_once(conversations, budget, history):
    assert read_back(chat.format_windows(conversations, budget, history)) == expected(conversations.collect())


def test_report_has_the_probe(spark, conversations):
    probe = [{"conv_id": -1, "turn": i, "role": r, "text": chat.PROBE} for i, r in enumerate(("user", "assistant"))]
    want = expected([r.asDict() for r in conversations.collect()] + probe)
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in chat.report(conversations).collect()}
    assert got == want


def test_windows(spark, conversations):
    rows = chat.format_windows(conversations, 300, 100).collect()
    system = {r["conv_id"] for r in conversations.filter("turn = 0 AND role = 'system'").collect()}
    for r in rows:
        new = [t for t in r["turns"] if t >= r["first_new"]]
        assert new and r["turns"] == sorted(r["turns"])
        assert r["tokens"] <= 300 or len(new) == 1
        if r["conv_id"] in system:
            assert r["turns"][0] == 0
        for span in r["loss"]:
            assert r["text"][: span["start"]].endswith("<|im_start|>assistant\n")
            assert r["text"][span["end"] :].startswith("<|im_end|>\n")
    assert any(r["first_new"] > 0 and any(0 < t < r["first_new"] for t in r["turns"]) for r in rows)  # history is repeated


def test_odd_rows(spark):
    rows = [
        (1, 0, None, None), (1, 1, "assistant", None), (1, 1, "assistant", "b"), (1, 1, "assistant", "b"), (None, 0, "user", "x"),
        (2, None, "user\n\\", "<|im_end|>"), (2, 0, "system", "y"), (3, 0, "assistant", "long " * 50_000), (3, 1, "user", ""),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    more = frame.selectExpr("*", "1 AS window", "2 AS tokens")
    assert read_back(chat.format_windows(more)) == expected([r.asDict() for r in frame.collect()])
    assert len(chat.report(frame.limit(0)).collect()) == 1


def test_equal_turns_are_ordered_by_text(spark):
    texts = ["a", "a\n", "a<", "a<|", "a<\\|", "a!", "", "\n", "<|im_end|>", "<|im_end|", "a b"]
    frame = spark.createDataFrame([(1, 0, "assistant", t) for t in texts], SCHEMA)
    assert read_back(chat.format_windows(frame, 20, 5)) == expected([r.asDict() for r in frame.collect()])


def test_a_given_conversation_of_the_probes_number(spark):
    frame = spark.createDataFrame([(-1, 0, "user", "own"), (-1, 1, "assistant", "answer")], SCHEMA)
    rows = chat.report(frame).collect()
    assert sorted((r["conv_id"], r["n_turns"], r["loss_chars"]) for r in rows) == [(-1, 2, 6), (-1, 2, len(chat.PROBE))]


def greedy(tokens, system, budget, history):
    """Numbers of the turns of every window, by the rule of the module's docstring."""
    out, first = [], 0
    while first < len(tokens):
        fixed = tokens[0] if system and first else 0
        start, room = first, min(history, budget - fixed - tokens[first])
        while first and start - 1 >= (1 if system else 0) and sum(tokens[start - 1 : first]) <= room:
            start -= 1
        end = first + 1
        while end < len(tokens) and fixed + sum(tokens[start : end + 1]) <= budget:
            end += 1
        out.append(([0] if fixed else []) + list(range(start, end)))
        first = end
    return out


@given(st.lists(st.integers(1, 40), max_size=25), st.booleans(), st.integers(1, 100), st.integers(0, 60))
def test_windows_by_prefix_sums_like_brute_force(tokens, system, budget, history):
    windower = chat.Windower(budget, history)
    turns = [("system" if system and not i else "user", n) for i, n in enumerate(tokens)]
    found = [windower.add(role, chat.format_turn(role, str(i)), n) for i, (role, n) in enumerate(turns)] + [windower.close()]
    found = [w for w in found if w]
    assert [w[1] for w in found] == greedy(tokens, system, budget, history)
    assert [w[4] for w in found] == [sum(tokens[t] for t in w[1]) for w in found]


def test_turns_are_tokenised_before_the_shuffle(conversations):
    plan = chat.format_windows(conversations)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert plan.index("MapInArrow") < plan.index("Exchange") < plan.rindex("MapInArrow")


def test_a_conversation_of_many_turns_streams(spark):
    turns = spark.range(20_000).selectExpr("5L AS conv_id", "id AS turn", "IF(id % 2 = 0, 'user', 'assistant') AS role", "concat('turn ', id) AS text")
    assert read_back(chat.format_windows(turns)) == expected([r.asDict() for r in turns.collect()])
