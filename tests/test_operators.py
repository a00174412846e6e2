import random
import statistics
import sys

import pytest
from pyspark.sql import functions as F

from sluiceworks.operators import audit
from sluiceworks.operators.gate import gate
from sluiceworks.operators.joins import join_audit, lookup
from sluiceworks.operators.keyed import Limits
from sluiceworks.operators.medians import exact_median, value_counts
from sluiceworks.operators.ranking import history_of_leaders, series_minimum, top
from sluiceworks.plans import commerce


@pytest.mark.parametrize("task_values", [1_000_000, 7])
def test_median_is_exact_for_hot_groups(spark, task_values):
    rnd = random.Random(1)
    groups = {
        "hot": [rnd.randint(-500, 10**9) for _ in range(400)],
        "odd": [3, 1, 2],
        "even": [1, 2, 3, 10],
        "same": [5] * 50,
        "two": [-1, -1, -1, 9, 9, 9],
        "steep": [2**i for i in range(50)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("hot", None), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v bigint")
    counts = value_counts(df, ["g"], "v")
    got = {r.g: r.median for r in exact_median(counts, ["g"], "v", task_values, buckets=4).collect()}
    assert got == {g: float(statistics.median(vs)) for g, vs in groups.items()}


@pytest.mark.parametrize("limits", [Limits(), Limits(broadcast_rows=1, task_rows=3)])
def test_lookup_keeps_every_row(spark, limits):
    fact = spark.createDataFrame([(i, 1 if i % 3 else i % 5) for i in range(100)], "id int, k int")
    dim = spark.createDataFrame([(k, f"n{k}") for k in range(4)], "k int, name string")
    got = sorted((r.id, r.k, r.name) for r in lookup(fact, dim, "k", ["id"], limits=limits).collect())
    want = sorted((i, k, f"n{k}") for i in range(100) for k in [1 if i % 3 else i % 5] if k < 4)
    assert got == want
    assert lookup(fact, dim, "k", ["id"], "left", limits).count() == 100


def test_join_audit_finds_lost_and_added(spark):
    fact = spark.createDataFrame([(1,), (1,), (2,), (3,), (None,)], "k int")
    dim = spark.createDataFrame([(1,), (2,), (2,)], "k int")
    row = join_audit(fact, dim, "k", "k", "x").first()
    assert tuple(row)[1:] == (5, 4, 2, 1, False)
    assert fact.join(dim, "k").count() == 4


def test_top_breaks_ties(spark):
    m = spark.createDataFrame([("a", 1, 5), ("b", 1, 5), ("c", 1, 9), ("a", 2, 0)], "k string, y int, v int")
    assert [r.k for r in top(m, 2, "v", "k", "y").collect()] == ["c", "a"]
    rows = history_of_leaders(m, "k", F.sum("v"), 2).collect()
    assert sorted((r.k, r.y) for r in rows) == [("a", 1), ("a", 2), ("c", 1)]
    assert tuple(series_minimum(m, "k", "v").first()) == ("a", 0)


def test_accounting_and_predictions(spark):
    raw, good, bad = (spark.range(n) for n in (5, 3, 2))
    lines = audit.row_accounting({"t": (raw, good, bad), "u": (raw, good, good), "e": (raw.limit(0),) * 3})
    got = {r.dataset: (r.bronze, r.silver, r.quarantine, r.closes) for r in lines.collect()}
    assert got == {"t": (5, 3, 2, True), "u": (5, 3, 3, False), "e": (0, 0, 0, True)}
    predicted = spark.createDataFrame([("t", 2), ("u", 2)], "dataset string, predicted bigint")
    flags = {r.dataset: r.as_predicted for r in audit.with_prediction(lines, predicted).collect()}
    assert flags == {"t": True, "u": False, "e": False}
    with pytest.raises(AssertionError, match="2 of 3"):
        audit.require(lines, "closes", "accounting")


def test_reconcile_with_tolerance(spark):
    actual = audit.totals(spark.range(4), {"n": F.count("*"), "s": F.sum("id"), "none": F.sum(F.lit(None).cast("int"))})
    expected = audit.expectations_frame(spark, [("n", 4, 0), ("s", 6.4, 0.5), ("none", 0, 0), ("gone", 1, 0)])
    got = {r.check_name: r.ok for r in audit.reconcile(actual, expected).collect()}
    assert got == {"n": True, "s": True, "none": False, "gone": False}


def test_mart_audit_on_an_empty_mart_is_false(spark):
    empty = spark.range(0)
    expected = spark.createDataFrame([("m", 0, 0)], "mart string, rows_expected bigint, key_sum_expected bigint")
    row = audit.mart_audit({"m": (empty, "id")}, expected).first()
    assert row.ok is False and row.rows == 0


def test_header_leaks_and_completeness(spark):
    raw = spark.createDataFrame([("a",), ("1",), (None,)], "a string")
    counts = audit.observed_counts({"t": raw})
    manifest = spark.createDataFrame([("t", 3), ("gone", 1)], "dataset string, expected_rows bigint")
    got = {r.dataset: (r.actual_rows, r.rows_ok, r.header_ok) for r in audit.completeness(counts, manifest).collect()}
    assert got == {"t": (3, True, False), "gone": (0, False, True)}


def test_expectations_drop_and_count(spark):
    kept, seen = audit.expect_all_or_drop(spark.range(10), {"small": "id < 7", "even": "id % 2 = 0"})
    assert [r.id for r in kept.collect()] == [0, 2, 4, 6]
    assert seen.get == {"rows": 10, "small": 7, "even": 5}


def test_fingerprints_ignore_order(spark):
    df = spark.range(100)
    a, b = audit.fingerprint(df, "t"), audit.fingerprint(df.orderBy(F.desc("id")), "t")
    assert audit.reproducible(a, b).first().identical
    assert not audit.reproducible(a, audit.fingerprint(spark.range(1, 101), "t")).first().identical


def test_median_with_infinities_and_nan(spark):
    """Non-finite values take part by rank, also where groups are narrowed."""
    from sluiceworks.operators.medians import exact_median

    inf, nan = float("inf"), float("nan")
    rows = [("a", float(v), 1) for v in range(101)] + [("a", inf, 3), ("a", nan, 2), ("a", -inf, 1)]
    rows += [("b", float(v) * 1e300, 1) for v in range(-50, 51)] + [("c", v, 1) for v in (nan, inf, 1.0)]
    counts = spark.createDataFrame(rows, "g string, v double, copies bigint")
    for task_values in (10, 2_000_000):
        got = {r.g: r["median"] for r in exact_median(counts, ["g"], "v", task_values, 8).collect()}
        assert got == {"a": 52.0, "b": 0.0, "c": inf}


def test_keys_that_hardly_repeat_travel_uncounted(spark, monkeypatch):
    """Unique keys are dealt out as they are, few and heavy ones counted before; the figures are the same."""
    import sys
    from dataclasses import replace

    from sluiceworks.operators.gate import dealt_out
    from sluiceworks.operators.keyed import LIMITS

    values = [0.0, -0.0, float("nan"), float("nan"), None, None, *map(float, range(1, 40))]
    keys = spark.createDataFrame([(v, i % 2) for v in values for i in range(2)], "a double, b int")
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY" not in plan(audit.key_uniqueness(keys, ["a", "b"], "k"))
    want = audit.key_uniqueness(keys, ["a", "b"], "k").collect()
    assert [tuple(r) for r in want] == [("k", 90, 84, False)]
    monkeypatch.setattr(sys.modules[dealt_out.__module__], "PART_ROWS", 10)
    many = audit.key_uniqueness(keys, ["a", "b"], "k")
    # Nothing is counted below the shuffle of the keys.
    assert "REPARTITION_BY_NUM" in plan(many) and "HashAggregate" not in plan(many).split("REPARTITION_BY_NUM")[1]
    assert many.collect() == want
    heavy = audit.key_uniqueness(keys, ["a", "b"], "k", replace(LIMITS, task_rows=1))
    assert "REPARTITION_BY" not in plan(heavy) and heavy.collect() == want


def test_rows_are_told_by_file_names_only_within_one_folder(spark, tmp_path):
    from sluiceworks.sources import read_parquet

    rows = spark.range(40).selectExpr("id", "id % 2 AS side").repartition(2)
    rows.write.parquet(f"{tmp_path}/plain")
    rows.write.partitionBy("side").parquet(f"{tmp_path}/split")
    for folder, whole in (("plain", False), ("split", True)):
        ids = [r[0] for r in read_parquet(spark, f"{tmp_path}/{folder}").select("_row_id").collect()]
        assert len(set(ids)) == 40
        assert {"/" in i.file for i in ids} == {whole}
    by_path = spark.read.parquet(f"{tmp_path}/plain").orderBy("_metadata.file_path", "_metadata.row_index").select("id")
    by_name = read_parquet(spark, f"{tmp_path}/plain").orderBy("_row_id").select("id")
    assert by_name.collect() == by_path.collect()


def _small_parts(monkeypatch, rows):
    module = sys.modules[gate.__module__]
    monkeypatch.setattr(module, "PART_ROWS", rows)
    monkeypatch.setattr(module, "MOST_PART_ROWS", rows)


def _dealt(df):
    return df._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM")


def test_lookup_deals_a_large_fact_out_in_parts(spark, monkeypatch):
    fact = spark.range(1000).select("id", F.when(F.col("id") % 10 > 0, F.col("id") % 300).alias("k"))
    dim = spark.range(200).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    want = sorted((i, 2 * (i % 300)) for i in range(1000) if i % 10 and i % 300 < 200)
    for rows, task_rows, parts in ((10, 5_000_000, 1), (5000, 5_000_000, 0), (10, 50, 0)):
        _small_parts(monkeypatch, rows)
        limits = Limits(broadcast_rows=0, task_rows=task_rows)
        got = lookup(fact, dim, "k", ["id"], limits=limits)
        assert _dealt(got) == parts
        assert sorted((r.id, r.twice) for r in got.collect()) == want
        assert lookup(fact, dim, "k", ["id"], "left", limits).count() == 1000


def test_join_audit_deals_many_keys_out_uncounted(spark, monkeypatch):
    fact = spark.range(500).select(F.when(F.col("id") % 5 > 0, F.col("id") % 100).alias("k"))
    dim = spark.range(90).select((F.col("id") % 60).alias("k"))
    rows = [i % 100 for i in range(500) if i % 5]
    lost = 100 + sum(k >= 60 for k in rows)
    added = sum(k < 30 for k in rows)
    for small, parts in ((10, 2), (450, 0)):
        _small_parts(monkeypatch, small)
        audited = join_audit(fact, dim, "k", "k", "x")
        assert _dealt(audited) == parts
        assert tuple(audited.first())[1:] == (500, 500 - lost + added, lost, added, False)


def test_marts_of_many_groups_are_the_same(spark, monkeypatch):
    day = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") * 37 % 900).cast("int"))
    price = F.col("id") / 8
    orders = spark.range(400).select(
        F.col("id").alias("order_key"), F.when(F.col("id") % 11 > 0, F.col("id") % 90).alias("cust_key"),
        F.when(F.col("id") % 7 > 0, F.lit("1-URGENT")).alias("order_priority"), F.col("id").alias("total_price"),
        day.alias("order_date"),
    )
    who = spark.range(80).select(F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"), F.lit("s").alias("c_mktsegment"))
    lines = spark.range(400).select(
        (F.col("id") % 90).alias("l_partkey"), F.when(F.col("id") % 3 > 0, F.lit("R")).alias("l_returnflag"),
        price.alias("l_extendedprice"), price.alias("l_quantity"), F.when(F.col("id") % 13 > 0, day).alias("l_shipdate"),
    )
    parts = spark.range(80).select(F.col("id").alias("p_partkey"), (F.col("id") % 4).cast("string").alias("p_brand"))
    for mart, facts, others in (
        (commerce.customer_year_summary, orders, who), (commerce.brand_year_summary, lines, parts),
    ):
        _small_parts(monkeypatch, 1000)
        want = mart(facts, others)
        _small_parts(monkeypatch, 20)
        got = mart(facts, others)
        assert (_dealt(want), _dealt(got)) == (0, 1)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_marts_merge_dimensions_measured_to_be_many(spark):
    """More customers and parts than may be broadcast, whatever Spark makes of the size of their files."""
    day = F.date_add(F.lit("2000-01-01").cast("date"), (F.col("id") * 37 % 900).cast("int"))
    key = F.when(F.col("id") % 11 > 0, F.col("id") % 90)
    orders = spark.range(400).select(
        F.col("id").alias("order_key"), key.alias("cust_key"), F.when(F.col("id") % 7 > 0, F.lit("1-URGENT")).alias("order_priority"),
        F.col("id").alias("total_price"), day.alias("order_date"),
    )
    lines = spark.range(400).select(
        key.alias("l_partkey"), F.lit("R").alias("l_returnflag"), F.col("id").alias("l_extendedprice"), F.col("id").alias("l_quantity"),
        day.alias("l_shipdate"),
    )

    def customers(n):
        nation, segment = (F.col("id") % 3).cast("int"), (F.col("id") % 5).cast("string")
        return spark.range(10, n).select(
            F.col("id").alias("c_custkey"), F.lit("n").alias("c_name"), segment.alias("c_mktsegment"), nation.alias("c_nationkey")
        )

    def parts(n):
        return spark.range(10, n).select(F.col("id").alias("p_partkey"), (F.col("id") % 4).cast("string").alias("p_brand"))

    nations = spark.createDataFrame([(i, f"nation {i}") for i in range(3)], "n_nationkey int, n_name string")
    for mart, facts, dimension, key, rest in (
        (commerce.customer_year_summary, orders, customers, "cust_key", ()),
        (commerce.segment_year_summary, orders, customers, "cust_key", ()),
        (commerce.nation_history, orders, customers, "cust_key", (nations,)),
        (commerce.brand_year_summary, lines, parts, "l_partkey", ()),
    ):
        few, many = mart(facts, dimension(200), *rest), mart(facts, dimension(Limits().broadcast_rows + 20), *rest)
        assert f"BroadcastHashJoin [{key}" in _plan(few)
        assert f"SortMergeJoin [{key}" in _plan(many) and f"BroadcastHashJoin [{key}" not in _plan(many)
        assert sorted(map(str, many.collect())) == sorted(map(str, few.collect())) != []


@pytest.mark.parametrize("part_rows, task_rows", [(10, 5_000_000), (10, 50), (10, 400)])
def test_lookup_merges_what_is_not_measured_to_be_small(spark, monkeypatch, part_rows, task_rows):
    fact = spark.range(1000).select("id", (F.col("id") % 3).alias("k"))
    dim = spark.range(2).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))
    _small_parts(monkeypatch, part_rows)
    got = lookup(fact, dim, "k", ["id"], limits=Limits(broadcast_rows=0, task_rows=task_rows))
    assert "SortMergeJoin [" in _plan(got)
    assert sorted((r.id, r.twice) for r in got.collect()) == [(i, 2 * (i % 3)) for i in range(1000) if i % 3 < 2]
