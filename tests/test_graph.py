import uuid

import pytest
from helpers import LAPS, RACES, raw_rows

from sluiceworks.operators.expectations import Expectation, ExpectationFailedError
from sluiceworks.plans.graph import Graph
from sluiceworks.session import workspace
from sluiceworks.sources import store

RAW = {
    "races": [("1", "2000"), ("2", "2001"), ("2", "2002")],
    "laps": [("1", "1", "5", "a", "1"), ("1", "2", "5", "a", "1"), ("2", "1", "5", "a", "1")],
}


@pytest.fixture
def schema(spark):
    name = "s" + uuid.uuid4().hex
    store.create_schema(spark, name, workspace(spark, name))
    yield name
    store.drop_schema(spark, name)


def graph(counter):
    contracts = {"laps": LAPS, "races": RACES}
    g = Graph(contracts, lambda spark, n: raw_rows(spark, contracts[n], RAW[n]))

    @g.dataset("per_race", ("laps",), "Laps per race.", [Expectation("some", "n > 0", "fail")])
    def per_race(laps):
        counter.append("per_race")
        return laps.groupBy("race_id").count().withColumnRenamed("count", "n")

    @g.dataset("named", ("per_race", "races"))
    def named(per_race, races):
        counter.append("named")
        return per_race.join(races, "race_id")

    @g.dataset("twice", ("per_race",))
    def twice(per_race):
        counter.append("twice")
        return per_race.selectExpr("race_id", "2 * n AS n")

    return g


def test_each_once_and_by_name(spark, schema):
    made = []
    out = graph(made).run(spark, schema)
    assert sorted(made) == ["named", "per_race", "twice"]
    assert [tuple(r) for r in out["named"].collect()] == [(1, 2, 2000)]
    names = {r.table_name for r in store.tables_in(spark, schema).collect()}
    assert names == set(graph([]).tables()) == {
        "raw_laps", "raw_races", "laps", "races", "quarantine_laps", "quarantine_races", "per_race", "named", "twice",
    }
    rejected = store.read_table(spark, f"{schema}.quarantine_laps").select("_original.raceId", "_reasons").collect()
    assert [tuple(r) for r in rejected] == [("2", "orphan_race_id")]
    rates = {(r.dataset, r.expectation): (r.passed, r.failed) for r in store.write_metrics(spark, schema).collect()}
    assert rates == {("laps", "quality_gate"): (2, 1), ("races", "quality_gate"): (1, 2), ("per_race", "some"): (1, 0)}


def test_only_what_is_wanted(spark, schema):
    made = []
    assert set(graph(made).run(spark, schema, ["twice"])) == {"races", "laps", "per_race", "twice"}
    assert made == ["per_race", "twice"]


def test_a_failing_run_leaves_the_tables_of_the_last(spark, schema):
    g = graph([])
    g.run(spark, schema)

    g.datasets.pop("per_race")
    g.dataset("per_race", ("laps",), expectations=[Expectation("many", "n > 99", "fail")])(
        lambda laps: laps.groupBy("race_id").count().withColumnRenamed("count", "n")
    )
    with pytest.raises(ExpectationFailedError):
        g.run(spark, schema)
    assert [tuple(r) for r in store.read_table(spark, f"{schema}.per_race").collect()] == [(1, 2)]
    assert store.read_table(spark, f"{schema}.named").count() == 1


def test_unsound_declarations():
    g = graph([])
    with pytest.raises(ValueError, match="twice"):
        g.dataset("laps")(lambda: None)
    with pytest.raises(ValueError, match="no dataset"):
        g.waves(["nothing"])
