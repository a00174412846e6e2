"""Exact sums, running sums and located differences."""

import math
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from sluiceworks.functions import exact_sum
from sluiceworks.operators.difference import bucket_totals, comparison, differing_rows
from sluiceworks.operators.running import running_sums
from sluiceworks.plans.commerce import event_value_evolution

INF, NAN = float("inf"), float("nan")


@pytest.mark.parametrize(
    "values, want",
    [
        ([0.1] * 10, 1.0), ([1e17, 0.25, -1e17], 0.25), ([1e19, 1e19, 3.0], 2e19 + 3), ([1e300, -1e300, 2.5], 2.5),
        ([INF, 1.0], INF), ([-INF, 1e19], -INF), ([INF, -INF], NAN), ([NAN, INF], NAN), ([None, None], None), ([None, 2.0], 2.0),
        ([9e17] * 40, 3.6e19), ([-0.0], 0.0),
    ],
)
def test_exact_sum(spark, values, want):
    rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    got = rows.agg(exact_sum(F.col("v"), F.lit(1)).alias("s")).first().s
    assert got == want or (want is not None and math.isnan(want) and math.isnan(got))


def test_evolution_with_values_beyond_decimals(spark):
    rows = [(1, "a", 1e19), (2, "a", 1e19), (3, "a", None), (4, "b", NAN), (5, "b", 1.0), (6, "c", INF), (7, "c", 2.0), (8, "c", 3.0), (9, "d", None)]
    events = spark.createDataFrame(rows, "event_id long, event_type string, value double").withColumn("ts", F.lit("2024-01-01").cast("timestamp_ntz"))
    got = {r.event_type: (r.events, r.avg_value, r.median_value, r.least_value) for r in event_value_evolution(events).collect()}
    assert got["a"] == (3, 1e19, 1e19, 1e19)
    assert got["b"][0] == 2 and math.isnan(got["b"][1]) and got["b"][3] == 1.0
    assert got["c"] == (3, INF, 3.0, 2.0)
    assert got["d"] == (1, None, None, None)


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_running_sums_of_a_hot_group(spark, ranges):
    draw = random.Random(3)
    rows = [(draw.choice([1, 1, 1, 2, 3, None]), i, Decimal(draw.randint(-500, 500)) / 100 if i % 9 else None) for i in range(800)]
    df = spark.createDataFrame(rows, "g int, at int, v decimal(10,2)").repartition(5)
    got = {(r.g, r.at): r.total for r in running_sums(df, ["g"], ["at"], {"total": F.col("v")}, ranges).collect()}
    want, sums = {}, {}
    for g, at, v in rows:
        if v is not None:
            sums[g] = sums.get(g, Decimal(0)) + v
        want[g, at] = sums.get(g)
    assert got == want


def test_running_sums_of_nothing(spark):
    df = spark.createDataFrame([], "g int, at int, v decimal(10,2)")
    assert running_sums(df, ["g"], ["at"], {"total": F.col("v")}).count() == 0


def test_no_window_holds_a_whole_hot_group(spark):
    df = spark.range(5000).select(F.lit(1).alias("g"), F.col("id").alias("at"), F.lit(1).cast("decimal(10,0)").alias("v"))
    found = running_sums(df, ["g"], ["at"], {"n": F.col("v")}, 16)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "_range" in plan
    assert found.agg(F.max("n")).first()[0] == 5000


def test_differences_are_located(spark):
    rows = [(i, f"t{i % 50}", None if i % 7 == 0 else i / 4) for i in range(2000)]
    first = spark.createDataFrame(rows, "k int, s string, v double")
    again = [r for r in rows if r[0] != 77] + [rows[5], (88, "t38", 1.5)]
    again.remove(rows[88])
    second = spark.createDataFrame(again, "k int, s string, v double").repartition(3).select("v", "s", "k")
    got = {(r.k, r.v): (r.copies, r.copies_again) for r in differing_rows(first, second, 64).collect()}
    assert got == {(77, None): (1, 0), (5, 1.25): (1, 2), (88, 22.0): (1, 0), (88, 1.5): (0, 1)}
    line = comparison(bucket_totals({"t": first}, 64), bucket_totals({"t": second.select("k", "s", "v")}, 64)).first()
    assert (line.rows, line.rows_again, line.identical) == (2000, 2000, False) and 1 <= line.buckets_apart <= 4
    same = comparison(bucket_totals({"t": first}), bucket_totals({"t": first.repartition(7)})).first()
    assert same.identical and differing_rows(first, first).count() == 0


def test_a_null_that_moves_is_seen(spark):
    a, b = (spark.createDataFrame([r], "x int, y int") for r in ((1, None), (None, 1)))
    assert differing_rows(a, b).count() == 2
