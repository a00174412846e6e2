import re
import sys
from dataclasses import replace

import pytest
from helpers import LAPS, RACES, RUN_TS, TINY, raw_rows, reasons
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sluiceworks.contract import Contract
from sluiceworks.operators.gate import gate, reason_counts
from sluiceworks.operators.keyed import LIMITS
from sluiceworks.operators.references import Parent


def races(spark, *ids):
    return Parent(spark.createDataFrame([(i, 2000) for i in ids], "race_id int, year int"), ("race_id",))


@pytest.fixture(params=[LIMITS, TINY], ids=["broadcast", "spread"])
def limits(request):
    return request.param


def laps(spark, rows, limits, parents=(1, 2)):
    return gate(raw_rows(spark, LAPS, rows), LAPS, {"races": races(spark, *parents)}, limits)


def test_every_reason_in_order(spark, limits):
    rows = [
        ("1", "1", "\\N", "1:30", "200.5"),  # clean: NULL position means not classified
        ("x", "2", None, None, None),  # bad
        ("\\N", "3", None, None, None),  # missing
        ("1", "0", "q", None, "-1"),  # bad value and two broken rules
        ("9", "5", None, None, None),  # orphan
        ("9", "-5", None, None, "-2"),  # rules before orphan
    ]
    got = dict((r[1], r[-1]) for r in reasons(laps(spark, rows, limits), "raceId", "lap"))
    assert got == {
        "1": "", "2": "bad_race_id", "3": "missing_race_id",
        "0": "bad_pos,invalid_lap_ge_1,invalid_speed_ok", "5": "orphan_race_id",
        "-5": "invalid_lap_ge_1,invalid_speed_ok,orphan_race_id",
    }


def test_casts_quarantine_instead_of_truncating(spark):
    c = Contract("t", "k INT NOT NULL, d DATE, n BIGINT, x DOUBLE", ("k",))
    rows = [("1", "2020-02-30", "12.7", "nope"), ("2", "2020-1-5", "99999999999999999999", "1e3")]
    got = reasons(gate(raw_rows(spark, c, rows), c), "k")
    assert got == [("1", "bad_d,bad_n,bad_x"), ("2", "bad_n")]


def test_empty_text_is_not_missing_but_bad(spark):
    c = Contract("t", "k INT NOT NULL, s STRING NOT NULL", ("k",))
    got = reasons(gate(raw_rows(spark, c, [("1", ""), ("", "a")]), c), "k")
    assert got == [("", "bad_k"), ("1", "")]


def test_copies(spark, limits):
    rows = [
        ("1", "1", "5", "a", "1"), ("1", "1", "5", "a", "1"), ("1", "1", "5", "a", "1.0"),  # alike
        ("1", "2", "5", "a", "1"), ("1", "2", "6", "a", "1"), ("1", "2", "5", "a", "1"),  # conflict
        ("2", "1", None, None, None),
    ]
    staged = laps(spark, rows, limits)
    got = reasons(staged, "raceId", "lap")
    assert got == [
        ("1", "1", ""), ("1", "1", "exact_duplicate"), ("1", "1", "exact_duplicate"),
        ("1", "2", "key_conflict"), ("1", "2", "key_conflict"), ("1", "2", "key_conflict"),
        ("2", "1", ""),
    ]
    assert staged.trusted.count() == 2 and staged.rejected.count() == 5


def test_cleanest_copy_is_kept(spark, limits):
    # Equal typed values, different text: the copy whose position did not parse must not survive.
    rows = [("1", "1", "x", None, None), ("1", "1", "\\N", None, None), ("1", "1", "y", None, None)]
    got = reasons(laps(spark, rows, limits), "pos")
    assert got == [("x", "bad_pos,exact_duplicate"), ("y", "bad_pos,exact_duplicate"), (None, "")]


def test_failing_rows_take_part_in_duplicates(spark, limits):
    rows = [("9", "1", "1", None, None), ("9", "1", "2", None, None)]
    assert {r[-1] for r in reasons(laps(spark, rows, limits), "lap")} == {"orphan_race_id,key_conflict"}


def test_null_keys_form_one_group(spark, limits):
    rows = [("\\N", "1", "1", None, None), ("\\N", "1", "2", None, None)]
    assert {r[-1] for r in reasons(laps(spark, rows, limits), "lap")} == {"missing_race_id,key_conflict"}


def test_zeros_and_nan_are_values(spark, limits):
    rows = [("1", "1", None, None, "0.0"), ("1", "1", None, None, "-0.0"), ("1", "2", None, None, "NaN"),
            ("1", "2", None, None, "NaN")]
    got = [r[-1] for r in reasons(laps(spark, rows, limits), "lap")]
    assert sorted(got) == ["", "", "exact_duplicate", "exact_duplicate"]


def test_quarantined_parent_takes_its_children(spark):
    parents = gate(raw_rows(spark, RACES, [("1", "2000"), ("2", "soon")]), RACES)
    rows = [("1", "1", None, None, None), ("2", "1", None, None, None)]
    staged = gate(raw_rows(spark, LAPS, rows), LAPS, {"races": parents.as_parent()})
    assert reasons(staged, "raceId") == [("1", ""), ("2", "orphan_race_id")]


def test_outputs(spark):
    rows = [("1", "1", "\\N", "1:30", "200.5"), ("x", "2", "3", None, None)]
    staged = laps(spark, rows, LIMITS)
    assert staged.trusted.schema.simpleString() == (
        "struct<race_id:int,lap:int,pos:int,time:string,speed:double>"
    )
    q = staged.quarantine(RUN_TS)
    assert q.columns == ["raceId", "lap", "pos", "time", "speed", "_source_file", "_ingested_at",
                         "_reasons", "_quarantined_at"]
    assert q.first().raceId == "x"
    assert [tuple(r) for r in reason_counts(staged.rejected).collect()] == [("bad_race_id", 1)]


def test_extra_columns_are_left_out(spark):
    raw = raw_rows(spark, RACES, [("1", "2000")]).withColumn("more", F.lit("x"))
    staged = gate(raw, RACES)
    assert "more" not in staged.trusted.columns + staged.rejected.columns


def test_row_id_is_needed(spark):
    with pytest.raises(ValueError, match="_row_id"):
        gate(raw_rows(spark, RACES, [("1", "2")]).drop("_row_id"), RACES)


def test_a_hot_key_is_spread(spark):
    """One key on a third of the rows, one orphan value on half: same result, no oversized task."""
    rows = [("1", "7", str(i), None, None) for i in range(300)]
    rows += [("9", str(i), None, None, None) for i in range(450)]
    rows += [("2", str(i + 1), None, None, None) for i in range(150)]
    one, other = (laps(spark, rows, x) for x in (LIMITS, TINY))
    assert reasons(one, "raceId", "lap", "pos") == reasons(other, "raceId", "lap", "pos")
    counts = {r.reason: r.rows for r in reason_counts(other.rejected).collect()}
    assert counts == {"key_conflict": 300, "orphan_race_id": 450, "invalid_lap_ge_1": 1}


TEXT = st.sampled_from(["1", "2", "x", "\\N", "", "-1", "0"])


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(TEXT, TEXT, TEXT, TEXT, TEXT), min_size=1, max_size=25))
def test_nothing_is_lost_or_invented(spark, rows):
    for limits in (LIMITS, TINY):
        staged = laps(spark, rows, limits)
        total = staged.rows.count()
        clean, rejected = staged.trusted, staged.rejected
        assert total == len(rows) == clean.count() + rejected.count()
        assert clean.count() == clean.select("race_id", "lap").distinct().count()
        assert rejected.where("_reasons = ''").count() == 0
        marked = [tuple(None if v == "\\N" else v for v in r) for r in rows]
        names = ["raceId", "lap", "pos", "time", "speed"]
        back = staged.rows.select(*[F.col(f"_raw_{n}") for n in names]).collect()
        assert sorted(map(repr, marked)) == sorted(repr(tuple(r)) for r in back)
        left = [tuple(r)[:5] for r in rejected.select(*names).collect()]
        assert all(marked.count(r) >= left.count(r) for r in left)


def test_hashed_verdicts_are_the_exact_ones(spark, limits):
    """Copies that agree, differ, or differ in NULLs only: the same whether told by hashes or value by value."""
    from sluiceworks.operators.duplicates import exact_verdicts, key_verdicts, repeated_keys, suspect_rows

    rows = [
        ("1", "1", "5", "a", "1"), ("1", "1", "5", "a", "1.0"), ("1", "2", "5", "a", "1"), ("1", "2", None, "5", "1"),
        ("1", "3", None, "x", None), ("1", "3", None, "x", None), ("\\N", "3", None, "x", None), (None, "3", None, "x", None),
        ("1", "4", None, "a", "0.0"), ("1", "4", None, "a", "-0.0"), ("1", "5", "5", None, "2"), ("1", "5", None, None, "2"),
    ]
    raw = raw_rows(spark, LAPS, rows)
    suspects = suspect_rows(raw, LAPS, repeated_keys(raw, LAPS, limits))
    columns = ["race_id", "lap", "_copies", "_alike"]
    told, exact = (sorted(map(str, f.select(*columns).collect())) for f in (key_verdicts(suspects, LAPS, limits), exact_verdicts(suspects, LAPS)))
    assert told == exact and len(told) == 6


def test_large_references_and_keys_take_one_scan(spark, folder, tmp_path):
    """With limits forced low: keys and all referring values in one scan, suspects in one, the output in one."""
    from dataclasses import replace

    from sluiceworks.plans import commerce
    from sluiceworks.plans.flow import build

    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    contracts = {n: commerce.CONTRACTS[n] for n in names}
    raw = {n: commerce.raw_table(spark, folder, n, keep_native=True) for n in names}
    done = build(spark, {n: raw[n] for n in names[:-1]}, {n: contracts[n] for n in names[:-1]})
    parents = {n: done[n].as_parent() for n in ("orders", "part", "supplier")}
    line, low = contracts["lineitem"], replace(TINY, task_rows=5_000_000)
    rows = raw["lineitem"].count()
    sc = spark._jsc.sc()

    def known_jobs():
        sc.listenerBus().waitUntilEmpty()
        jobs = sc.statusStore().jobsList(None)
        return {jobs.apply(i).jobId(): jobs.apply(i) for i in range(jobs.size())}

    def read(jobs):
        ids = {j.stageIds().apply(k) for j in jobs for k in range(j.stageIds().size())}
        return sum(sc.statusStore().lastStageAttempt(i).inputRecords() for i in ids)

    # Stages of older jobs may be forgotten by now.
    before = known_jobs()
    gate(raw["lineitem"], line, parents, low).rows.write.format("noop").mode("overwrite").save()
    # Checkpoints and parents are read as well; they are smaller than one more scan.
    others = sum(done[n].rows for n in ("orders", "part", "supplier"))
    assert read(j for i, j in known_jobs().items() if i not in before) <= 3 * rows + 4 * others


def test_values_kept_beside_their_texts_change_nothing(spark, folder):
    from sluiceworks.operators import audit
    from sluiceworks.plans import commerce

    for name in ("lineitem", "events", "part"):
        c = commerce.CONTRACTS[name]
        alone = Contract(c.dataset, c.ddl, c.key, c.rules)
        staged = [gate(commerce.raw_table(spark, folder, name, keep_native=k), alone) for k in (False, True)]
        prints = [
            audit.union_all([audit.fingerprint(s.trusted, "trusted"), audit.fingerprint(s.rejected, "quarantine")]) for s in staged
        ]
        audit.require(audit.reproducible(*prints), "identical", name)


def _one_way():
    """Limits under which nothing is broadcast and no key is heavy."""
    from dataclasses import replace

    return replace(TINY, task_rows=5_000_000)


def test_rows_travel_once(spark):
    """Repeated keys and a parent that are too many to be broadcast move the rows once, and the parent's keys."""
    rows = [("1", str(i // 2), str(i % 3), None, None) for i in range(60)] + [("9", "1", None, None, None)]
    plan = laps(spark, rows, _one_way()).rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY") == 1 and plan.count("ENSURE_REQUIREMENTS") <= 1
    alone = Contract(LAPS.dataset, LAPS.ddl, LAPS.key, LAPS.rules)
    plan = gate(raw_rows(spark, LAPS, rows), alone, limits=_one_way()).rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY") == 1 and "ENSURE_REQUIREMENTS" not in plan


def test_large_parents_are_not_broadcast(spark, monkeypatch):
    """A parent's keys are many rows of few bytes by Spark's estimate, by which it must not go."""
    module, reports = sys.modules[Parent.__module__], []
    settle = module.settle
    monkeypatch.setattr(module, "settle", lambda frame, *args: reports.append(frame) or settle(frame, *args))
    rows = raw_rows(spark, LAPS, [("1", str(i // 2), str(i % 3), None, None) for i in range(60)] + [("9", "1", None, None, None)])
    parent = {"races": Parent(spark.range(1, 3).select(F.col("id").cast("int").alias("race_id")), ("race_id",))}
    together, counted = (gate(rows, LAPS, parent, x) for x in (_one_way(), TINY))
    assert len(reports) == 1
    for frame in (together.rows, reports[0]):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin [race_id" in plan and "BroadcastHashJoin [race_id" not in plan
    got, want = (sorted(r._reasons for r in s.rows.collect()) for s in (together, counted))
    assert got == want and sum("orphan_race_id" in r for r in got) == 1


def test_rows_that_travel_get_the_same_reasons(spark):
    """NULL keys, copies that are alike, conflicts, orphans and malformed lines: as with everything broadcast."""
    rows = [
        ("1", "1", "5", "a", "1"), ("1", "1", "5", "a", "1.0"), ("1", "1", "x", None, "1"), ("1", "2", "x", None, None), ("1", "2", None, None, None),
        ("\\N", "3", "1", None, None), (None, "3", "1", None, None), ("9", "4", None, None, "-0.0"), ("9", "4", None, None, "0.0"), ("2", "1", None, None, "NaN"),
        (None, None, None, None, None), (None, None, None, None, None), ("2", "x", None, None, None), ("2", "0", None, None, "-1"),
    ]
    raw = raw_rows(spark, LAPS, rows)
    lines = raw.withColumn("_malformed", F.when(F.col("_row_id").isin(3, 11), "a line"))
    alone = Contract(LAPS.dataset, LAPS.ddl, LAPS.key, LAPS.rules)
    for r in (raw, lines):
        for contract in (LAPS, alone):
            one, other = (gate(r, contract, {"races": races(spark, 1, 2)}, x) for x in (LIMITS, _one_way()))
            assert other.rows.columns == one.rows.columns and other.rows.dtypes == one.rows.dtypes
            got, want = (sorted(map(repr, s.rows.collect())) for s in (other, one))
            assert got == want


def _plan(staged):
    return staged.rows._jdf.queryExecution().executedPlan().toString()


def test_rows_are_sorted_as_they_travelled(spark):
    """Values are typed after the sort: what is sorted is what came out of the shuffle."""
    rows = [("1", str(i // 2), str(i % 3), None, None) for i in range(60)]
    alone = Contract(LAPS.dataset, LAPS.ddl, LAPS.key, LAPS.rules)
    for contract in (LAPS, alone):
        plan = _plan(laps(spark, rows, _one_way()) if contract is LAPS else gate(raw_rows(spark, alone, rows), alone, limits=_one_way()))
        assert re.search(r"Sort \[[^\n]*\n[^\n]*Exchange hashpartitioning[^\n]*REPARTITION_BY", plan)


def test_parts_follow_the_rows(spark, monkeypatch):
    """However few partitions the session has and whatever the shuffle's files weigh, a task sorts a bounded number of rows."""
    module = sys.modules[gate.__module__]
    assert [module._parts(spark.range(1), n) for n in (0, 1_500_000, 36_000_000, 360_000_000)] == [8, 10, 200, 300]
    monkeypatch.setattr(module, "PART_ROWS", 3)
    rows = [("1", str(i // 2), str(i % 3), None, None) for i in range(60)]
    alone = Contract(LAPS.dataset, LAPS.ddl, LAPS.key, LAPS.rules)
    assert re.search(r"Exchange hashpartitioning\([^\n]*, 20\), REPARTITION_BY_NUM", _plan(gate(raw_rows(spark, alone, rows), alone, limits=_one_way())))


def test_verdicts_too_large_to_be_broadcast_are_found_in_place(spark):
    """Repeated keys few enough to be broadcast, but not with a row to keep each: the rows move once, without a join."""
    rows = [("1", str(i // 2), "5", None, None) for i in range(60)]
    alone = Contract(LAPS.dataset, LAPS.ddl, LAPS.key, LAPS.rules)
    raw = raw_rows(spark, alone, rows)
    staged = gate(raw, alone, limits=replace(LIMITS, broadcast_bytes=2_000))
    plan = _plan(staged)
    assert plan.count("REPARTITION_BY") == 1 and "Join" not in plan
    got, want = (sorted(map(repr, s.rows.collect())) for s in (staged, gate(raw, alone)))
    assert got == want


def test_the_split_is_written_unsorted(spark, tmp_path):
    """A session that does not say how many files may be open gets both of the split; one that allows more keeps that."""
    from sluiceworks.plans.flow import store
    from sluiceworks.session import OPEN_FILES

    was = spark.conf.get(OPEN_FILES)
    try:
        for given, left in (("0", "4"), ("9", "9")):
            spark.conf.set(OPEN_FILES, given)
            stored = store(laps(spark, [("1", "1", None, None, None), ("x", "2", None, None, None)], LIMITS), str(tmp_path))
            assert spark.conf.get(OPEN_FILES) == left
            assert (stored.trusted.count(), stored.rejected.count()) == (1, 1)
    finally:
        spark.conf.set(OPEN_FILES, was)
