import random

import pytest
from helpers import LAPS, RACES, TINY, raw_rows

from sluiceworks.operators.keyed import LIMITS
from sluiceworks.plans.flow import build
from sluiceworks.session import workspace
from sluiceworks.sources.raw import ROW_ID
from sluiceworks.streaming.incremental import IncrementalFlow

CONTRACTS = {"laps": LAPS, "races": RACES}


def raw(spark, name, rows):
    nothing = [(None,) * len(CONTRACTS[name].columns)]
    return raw_rows(spark, CONTRACTS[name], rows or nothing).drop(ROW_ID).limit(len(rows))


def tables(gates):
    out = {}
    for name, g in gates.items():
        originals = [c.source for c in CONTRACTS[name].columns]
        out[name] = (
            sorted(map(str, g.trusted.collect())),
            sorted(map(str, g.rejected.select(*originals, "_reasons").collect())),
        )
    return out


def one_build(spark, rows, limits):
    return tables(build(spark, {n: raw_rows(spark, CONTRACTS[n], r) for n, r in rows.items()}, CONTRACTS, limits=limits))


@pytest.mark.parametrize("limits", [LIMITS, TINY], ids=["broadcast", "spread"])
def test_three_landings_are_one_build(spark, limits):
    draw = random.Random(7)
    races = [(str(draw.randint(1, 6)), str(draw.choice([2000, 2000, 2001]))) for _ in range(9)] + [("x", "1"), (None, "2000")]
    laps = [
        (str(draw.randint(1, 7)), str(draw.randint(0, 4)), draw.choice(["5", "5", "6", "q"]), "a", draw.choice(["1", "1.0", "-1"]))
        for _ in range(60)
    ] + [(None, "1", "5", "a", "1"), (None, "1", "5", "a", "1"), ("1", "\\N", "5", "a", "1")]
    draw.shuffle(laps)
    flow = IncrementalFlow(spark, CONTRACTS, workspace(spark, "inc"), limits)
    for part in range(3):
        flow.land({"races": raw(spark, "races", races[part::3]), "laps": raw(spark, "laps", laps[part::3])})
    # Of equal copies the first one is kept, so the one build gets them in the order of landing.
    landed = {n: [r for part in range(3) for r in rows[part::3]] for n, rows in (("races", races), ("laps", laps))}
    assert tables(flow.gates) == one_build(spark, landed, limits)


def test_a_late_copy_takes_back_a_trusted_row(spark):
    flow = IncrementalFlow(spark, CONTRACTS, workspace(spark, "inc"))
    flow.land({"races": raw(spark, "races", [("1", "2000")]), "laps": raw(spark, "laps", [("1", "1", "5", "a", "1"), ("1", "2", "5", "a", "1")])})
    assert flow.gates["laps"].trusted.count() == 2
    flow.land({"laps": raw(spark, "laps", [("1", "1", "6", "a", "1")])})
    assert [r.lap for r in flow.gates["laps"].trusted.collect()] == [2]
    assert [r["_reasons"] for r in flow.gates["laps"].rejected.collect()] == ["key_conflict"] * 2
    # A parent that falls takes its children along, without any of them landing.
    flow.land({"races": raw(spark, "races", [("1", "2001")])})
    assert flow.gates["laps"].trusted.count() == 0
    assert {r["_reasons"] for r in flow.gates["laps"].rejected.collect()} == {"orphan_race_id,key_conflict", "orphan_race_id"}
    # A parent that comes late frees them.
    flow.land({"laps": raw(spark, "laps", [("3", "1", "5", "a", "1")])})
    assert flow.gates["laps"].trusted.count() == 0
    flow.land({"races": raw(spark, "races", [("3", "2001")])})
    assert [r.race_id for r in flow.gates["laps"].trusted.collect()] == [3]


def test_batches_count_once_and_dead_epochs_not_at_all(spark, monkeypatch):
    flow = IncrementalFlow(spark, {"races": RACES}, workspace(spark, "inc"))
    g = flow.gates["races"]
    assert g.trusted.count() == 0 and g.rejected.count() == 0
    g.apply(raw(spark, "races", [("1", "2000")]), 0)
    g.apply(raw(spark, "races", [("1", "2000")]), 0)
    assert g.trusted.count() == 1 and g.rejected.count() == 0
    with monkeypatch.context() as m:
        m.setattr("sluiceworks.streaming.incremental.gate", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            g.apply(raw(spark, "races", [("2", "2000")]), 1)
    assert g.trusted.count() == 1
    g.apply(raw(spark, "races", [("2", "2000")]), 1)
    assert g.trusted.count() == 2
    g.apply(raw(spark, "races", []), 2)
    assert g.trusted.count() == 2


def test_a_stream_that_is_started_again(spark):
    landing = workspace(spark, "landing")
    flow = IncrementalFlow(spark, {"races": RACES}, workspace(spark, "inc"))
    for rows in ([("1", "2000"), ("2", "2000")], [("2", "2000"), ("3", "x")], []):
        if rows:
            raw(spark, "races", rows).write.mode("append").parquet(landing)
        schema = spark.read.parquet(landing).schema
        flow.stream({"races": spark.readStream.schema(schema).parquet(landing)})
    assert sorted(r.race_id for r in flow.gates["races"].trusted.collect()) == [1, 2]
    assert sorted(r["_reasons"] for r in flow.gates["races"].rejected.collect()) == ["bad_year", "exact_duplicate"]


def test_ids_measured_to_be_many_are_not_broadcast(spark):
    """The files of row ids are small, their rows are not: Spark must not go by the files."""
    flow = IncrementalFlow(spark, {"races": RACES}, workspace(spark, "inc"), TINY)
    for year in ("2000", "2001"):
        flow.land({"races": raw(spark, "races", [("1", year), ("2", "2000")])})
    rows = flow.gates["races"].current()
    assert rows.count() == 4
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
