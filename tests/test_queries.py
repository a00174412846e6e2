"""Every registered query against its SQL counterpart on DuckDB, and the plans of a few."""

import pytest
from compare import connect, difference
from pyspark.sql import functions as F

from __spark_entry__ import entry, oracle_sql, queries
from sluiceworks.plans.oracles import ORACLES
from sluiceworks.plans.queries import QUERIES
from sluiceworks.operators.duplicates import repeated_keys
from sluiceworks.operators.gate import gate
from sluiceworks.plans import commerce


@pytest.fixture(scope="module")
def duck(folder):
    return connect(folder)


def test_each_query_has_sql():
    assert set(QUERIES) == set(ORACLES) and set(QUERIES) <= set(queries())
    assert set(ORACLES) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_same_as_sql(spark, folder, duck, name):
    assert difference(QUERIES[name](spark, folder), duck, ORACLES[name]) is None


def test_entry(spark):
    assert entry(spark).limit(1).count() == 1


def test_build_is_the_same_when_everything_is_spread(spark, folder):
    """Limits decide how, never what: the chain down to order lines, built both ways."""
    from helpers import TINY

    from sluiceworks.operators import audit
    from sluiceworks.operators.keyed import LIMITS
    from sluiceworks.plans.flow import build

    names = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem"]
    contracts = {n: commerce.CONTRACTS[n] for n in names}
    raw = {n: commerce.raw_table(spark, folder, n) for n in names}

    def prints(limits):
        built = build(spark, raw, contracts, limits=limits)
        parts = [audit.fingerprint(built[n].trusted, n) for n in names]
        parts += [audit.fingerprint(built[n].rejected, f"{n} quarantine") for n in names]
        return audit.union_all(parts)

    audit.require(audit.reproducible(prints(LIMITS), prints(TINY)), "identical", "both ways")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_range_filter_is_pushed_down(spark, folder):
    plan = plan_of(queries()["range_filter"](spark, folder))
    assert "PushedFilters: [" in plan and "EqualTo(l_returnflag,R)" in plan
    assert "l_extendedprice" not in plan


def test_clean_gate_shuffles_nothing(spark, folder):
    """Unique keys and small parents: one scan, broadcast joins, no exchange of the rows."""
    nation = gate(commerce.raw_table(spark, folder, "nation"), commerce.CONTRACTS["nation"],
                  {"region": gate(commerce.raw_table(spark, folder, "region"), commerce.CONTRACTS["region"]).as_parent()})
    staged = gate(commerce.raw_table(spark, folder, "customer"), commerce.CONTRACTS["customer"],
                  {"nation": nation.as_parent()})
    plan = plan_of(staged.rows)
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_key_scan_reads_only_keys(spark, folder):
    from sluiceworks.operators.checks import typed

    raw, c = commerce.raw_table(spark, folder, "lineitem"), commerce.CONTRACTS["lineitem"]
    plan = plan_of(typed(raw, c).groupBy(*c.key).agg(F.count("*")))
    assert "l_orderkey" in plan and "l_extendedprice" not in plan and "l_shipdate" not in plan
    assert repeated_keys(raw, c).rows > 0
