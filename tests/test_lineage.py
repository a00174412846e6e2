"""Traces of keys and ledgers of files."""

from helpers import LAPS, RACES, raw_rows
from pyspark.sql import functions as F

from sluiceworks.operators.keyed import LIMITS
from sluiceworks.operators.lineage import Trail, trace
from sluiceworks.plans.flow import build
from sluiceworks.sources.ledger import file_ledger, ledger_check

ROWS = [
    ("1", "1", "5", "a", "1"), ("1", "1", "5", "a", "1.0"), ("1", "2", "5", "a", "1"), ("1", "2", "6", "a", "1"),
    ("9", "3", None, "x", None), ("1", "4", None, "y", None), ("\\N", "4", None, "y", None),
]


def test_trace_of_given_keys(spark):
    contracts = {"laps": LAPS, "races": RACES}
    raw = {"laps": raw_rows(spark, LAPS, ROWS, "l.csv"), "races": raw_rows(spark, RACES, [("1", "2000")])}
    laps = build(spark, raw, contracts)["laps"]
    mart = laps.trusted.groupBy("race_id").agg(F.count("*").alias("laps"))
    trail = Trail(mart, {"race_id": F.col("race_id")}, ("race_id", "laps"))
    keys = spark.createDataFrame([(1, 1), (1, 2), (9, 3), (None, 4), (5, 5)], "race_id int, lap int")
    from helpers import TINY

    for limits in (LIMITS, TINY):
        found = trace(LAPS, raw["laps"], laps.trusted, laps.rejected, keys, {"per_race": trail}, limits).collect()
        got = sorted((str(r.race_id), r.lap, r.layer, r.place) for r in found)
        assert got == [
            ("1", 1, "1 raw", "l.csv"), ("1", 1, "1 raw", "l.csv"), ("1", 1, "2 quarantine", "exact_duplicate"), ("1", 1, "2 trusted", ""),
            ("1", 1, "3 mart", "per_race"), ("1", 2, "1 raw", "l.csv"), ("1", 2, "1 raw", "l.csv"),
            ("1", 2, "2 quarantine", "key_conflict"), ("1", 2, "2 quarantine", "key_conflict"), ("9", 3, "1 raw", "l.csv"),
            ("9", 3, "2 quarantine", "orphan_race_id"), ("None", 4, "1 raw", "l.csv"), ("None", 4, "2 quarantine", "missing_race_id"),
        ]
        assert {r.detail for r in found if r.layer == "3 mart"} == {"1,2"}


def test_ledger_finds_what_changed(spark):
    def rows(name, some):
        return raw_rows(spark, LAPS, some, name)

    landed = rows("a", ROWS[:3]).unionByName(rows("b", ROWS[3:5])).unionByName(rows("c", ROWS[5:] + [("raceId", "lap", "pos", "time", "speed")]))
    now = rows("a", list(reversed(ROWS[:3]))).unionByName(rows("b", [ROWS[3], ("9", "3", "x", None, None)])).unionByName(rows("d", ROWS[:1]))
    before, after = (file_ledger({"laps": f.repartition(3)}, {"laps": LAPS}) for f in (landed, now))
    got = {r.file: (r.rows, r.rows_now, r.header_leaks, r.state) for r in ledger_check(before, after).collect()}
    assert got == {
        "a": (3, 3, 0, "unchanged"), "b": (2, 2, 0, "changed"), "c": (3, None, 1, "gone"), "d": (None, 1, None, "new"),
    }
