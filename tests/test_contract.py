import pytest

from sluiceworks.contract import Contract, Reference, build_order, conform
from sluiceworks.plans import commerce, racing


def test_conform_names():
    assert [conform(n) for n in ("raceId", "q1", "fp1_date", "positionText")] == [
        "race_id", "q1", "fp1_date", "position_text",
    ]
    assert conform("raceID") == "race_i_d"


def test_ddl_carries_required_and_comments(spark):
    c = Contract("t", "aId INT NOT NULL COMMENT 'the a', b STRING", ("a_id",))
    assert [(x.name, x.required, x.comment, x.is_text) for x in c.columns] == [
        ("a_id", True, "the a", False), ("b", False, None, True),
    ]
    assert c.trusted_schema["a_id"].metadata == {"comment": "the a"}
    assert {f.dataType.simpleString() for f in c.raw_schema} == {"string"}


def test_problems_are_named(spark):
    bad = Contract("t", "a INT, b INT NOT NULL", ("a", "c"), references=(Reference("z", "p", "k"),))
    text = "; ".join(bad.problems())
    assert "a is not required" in text and "c is not declared" in text and "z is not declared" in text
    with pytest.raises(ValueError, match="unknown parent p"):
        build_order({"t": Contract("t", "a INT NOT NULL", ("a",), references=(Reference("a", "p", "k"),))})


def test_cycles_are_refused(spark):
    a = Contract("a", "x INT NOT NULL", ("x",), references=(Reference("x", "b", "x"),))
    b = Contract("b", "x INT NOT NULL", ("x",), references=(Reference("x", "a", "x"),))
    with pytest.raises(ValueError, match="cycle"):
        build_order({"a": a, "b": b})


def test_build_orders(spark):
    waves = build_order(commerce.CONTRACTS)
    place = {n: i for i, wave in enumerate(waves) for n in wave}
    assert place["region"] < place["nation"] < place["customer"] < place["orders"] < place["lineitem"]
    waves = build_order(racing.CONTRACTS)
    assert waves[0] == ["circuits", "constructors", "drivers", "seasons", "status"]
    assert waves[1] == ["races"] and len(waves[2]) == 8


def test_racing_totals(spark):
    c = racing.CONTRACTS.values()
    columns = [x for k in c for x in k.columns]
    kinds = [x.type.simpleString() for x in columns]
    assert len(columns) == 121
    assert [kinds.count(k) for k in ("int", "string", "double", "date", "bigint")] == [62, 40, 8, 7, 4]
    assert sum(x.required for x in columns) == 67
    assert sum(len(k.references) for k in c) == 23 and sum(len(k.rules) for k in c) == 21
