"""The queries of the commerce tables, each ``(spark, folder) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from sluiceworks.functions import full_name, money, seconds
from sluiceworks.operators import audit, describe
from sluiceworks.operators.checks import typed
from sluiceworks.operators.duplicates import key_verdicts, repeated_keys, suspect_rows
from sluiceworks.operators.difference import bucket_totals, comparison, differing_rows
from sluiceworks.operators.expectations import Expectation, ExpectationFailedError
from sluiceworks.operators.gate import REASONS, Staged, dealt_out, gate, reason_counts
from sluiceworks.operators.joins import join_audit
from sluiceworks.operators.lineage import Trail, trace
from sluiceworks.operators.ranking import history_of_leaders, series_minimum, top
from sluiceworks.operators.running import running_sums
from sluiceworks.plans import commerce, serving
from sluiceworks.plans.flow import Stored, build, land
from sluiceworks.plans.warehouse import warehouse
from sluiceworks.session import workspace
from sluiceworks.sources import (
    at_rest,
    create_schema,
    drop_schema,
    landed_files,
    manifest_frame,
    overwrite,
    presence,
    read_csv,
    read_table,
    tables_in,
)
from sluiceworks.sources.files import Files
from sluiceworks.sources.ledger import file_ledger, ledger_check
from sluiceworks.sources.raw import INGESTED_AT, MALFORMED, ROW_ID, SOURCE_FILE
from sluiceworks.sources.store import dataset_folder, publish, write_metrics
from sluiceworks.sources.versions import OvertakenError, Version
from sluiceworks.streaming.incremental import IncrementalFlow

C = commerce.CONTRACTS
STAR = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def _ancestors(names: tuple[str, ...]) -> set[str]:
    wanted = set(names)
    for n in names:
        wanted |= _ancestors(tuple(r.parent for r in C[n].references))
    return wanted


def stored(spark: SparkSession, folder: str, *names: str) -> dict[str, Stored]:
    """Builds and stores the named datasets and everything they refer to."""
    wanted = _ancestors(names)

    def scan(name: str) -> tuple[str, DataFrame]:
        return name, commerce.raw_table(spark, folder, name, keep_native=True)

    with ThreadPool(8) as pool:
        raw = dict(pool.map(inheritable_thread_target(spark)(scan), sorted(wanted), chunksize=1))
    return build(spark, raw, {n: C[n] for n in C if n in wanted})


def staged_orders(spark: SparkSession, folder: str) -> Staged:
    parents = {"customer": stored(spark, folder, "customer")["customer"].as_parent()}
    return gate(commerce.raw_table(spark, folder, "orders"), C["orders"], parents)


# --- sources and sinks ------------------------------------------------------------------------


def raw_provenance(spark, folder):
    raw = commerce.raw_table(spark, folder, "customer")
    return raw.drop(ROW_ID, INGESTED_AT)


def csv_scan(spark, folder):
    """Raw orders written as headed CSV files and read back: literal markers survive."""
    path = workspace(spark, "orders.csv")
    commerce.dirty_orders(spark, folder).select(*C["orders"].raw_schema.names).write.option(
        "header", True
    ).option("escape", '"').csv(path)
    return read_csv(spark, path, C["orders"], commerce.RUN_TS).select(*C["orders"].raw_schema.names)


def _landed_with_faults(spark, folder) -> tuple[DataFrame, Stored]:
    """Orders landed from CSV lines of which every 97th key's has one field and every 83rd's one too many."""
    names = C["orders"].raw_schema.names
    key = F.col("orderKey").cast("bigint")
    line = F.concat_ws(",", *names)
    lines = commerce.camel_orders(spark, folder).select(
        F.when(key % 97 == 0, F.col("orderKey")).when(key % 83 == 0, F.concat(line, F.lit(",more"))).otherwise(line)
        .alias(",".join(names))
    )
    landing = workspace(spark, "landing")
    # One column whose separator occurs nowhere: the text of each line is written as it is.
    lines.write.option("header", True).option("sep", "\x01").option("escapeQuotes", False).csv(f"{landing}/orders.csv")
    alone = C["orders"]
    contracts = {"orders": type(alone)(alone.dataset, alone.ddl, alone.key, alone.rules, (), alone.about)}
    raw = land(spark, landing, contracts, commerce.RUN_TS)
    return raw["orders"], build(spark, raw, contracts)["orders"]


def malformed_lines(spark, folder):
    """Every landed line with too few or too many fields, as quarantined: its whole text."""
    _, orders = _landed_with_faults(spark, folder)
    return orders.rejected.where(F.split(REASONS, ",")[0] == "malformed_line").select(F.col(MALFORMED).alias("line"))


def malformed_accounting(spark, folder):
    """No line is lost on the way from the files: raw = trusted + quarantine, malformed lines counted."""
    raw, orders = _landed_with_faults(spark, folder)
    counts = audit.observed_counts({"orders": raw}).select("dataset", "malformed_lines")
    return audit.row_accounting({"orders": (raw, orders.trusted, orders.rejected)}).join(counts, "dataset")


def manifest_verdict(spark, folder):
    """Rows read back against rows counted while they were written, for every dataset.

    One row of the events repeats the column names; the deliveries are expected and do not exist.
    """
    raw = {n: commerce.raw_table(spark, folder, n) for n in C if n != "orders"}
    raw["orders"] = commerce.camel_orders(spark, folder)
    header = raw["events"].limit(1).select(
        *[F.lit(c.source).alias(c.source) for c in C["events"].columns]
    )
    raw["events"] = raw["events"].select(*header.columns).unionByName(header)

    def landed(name: str) -> tuple[str, DataFrame, int]:
        seen = Observation()
        return name, at_rest(raw[name].observe(seen, F.count("*").alias("rows")), f"landed-{name}"), seen.get["rows"]

    with ThreadPool(8) as pool:
        copies = pool.map(inheritable_thread_target(spark)(landed), raw, chunksize=1)
    expected = {name: rows for name, _, rows in copies}
    expected["deliveries"] = expected["orders"]
    return audit.completeness(audit.observed_counts({n: copy for n, copy, _ in copies}), manifest_frame(spark, expected))


def landing_presence(spark, folder):
    """Files found against datasets expected, with the rows in them."""
    expected = {n: 0 for n in (*STAR, "events", "deliveries")}
    found = landed_files(spark, folder, ".parquet")
    names = [r.dataset for r in found.select("dataset").collect()]
    rows = audit.union_all(
        [commerce.table(spark, folder, n).select(F.lit(n).alias("dataset")) for n in names]
    ).groupBy("dataset").agg(F.count("*").alias("rows"))
    return presence(found, manifest_frame(spark, expected)).join(rows, "dataset", "left").fillna(0, ["rows"])


@contextmanager
def scratch_schema(spark: SparkSession) -> Iterator[str]:
    """A schema of its own below the shared folder; nothing of it stays in the catalog."""
    schema = "sluice_" + workspace(spark, "s").rsplit("-", 1)[-1]
    create_schema(spark, schema, workspace(spark, schema))
    try:
        yield schema
    finally:
        drop_schema(spark, schema)


def snapshot_overwrite(spark, folder):
    """A table is replaced twice, the second time with another schema, and read by name."""
    with scratch_schema(spark) as schema:
        customers = commerce.table(spark, folder, "customer")
        overwrite(customers, f"{schema}.customer")
        overwrite(customers.select("c_custkey", money("c_acctbal").alias("c_balance")), f"{schema}.customer")
        found = tables_in(spark, schema)
        rows = read_table(spark, f"{schema}.customer").groupBy().agg(
            F.count("*").alias("rows"), F.sum("c_balance").cast("double").alias("balance")
        )
        return at_rest(rows.select(F.lit(found.first().table_name).alias("table_name"), "rows", "balance"), "snapshot")


def atomic_overwrite(spark, folder):
    """What a table holds after each of six writes: two that replace it, two that die, two that must not be committed.

    One write dies on a row, one between its commit and the catalog; one misses an expectation, one is overtaken.
    """
    customers = commerce.table(spark, folder, "customer")
    steps = []
    with scratch_schema(spark) as schema:
        name = f"{schema}.customer"

        def state(step: str) -> None:
            rows = read_table(spark, name)
            versions = [n for n in Files(spark, dataset_folder(spark, schema, "customer")).names() if n.startswith("version-")]
            steps.append(
                at_rest(
                    rows.agg(F.count("*").alias("rows"), F.sum("c_custkey").alias("keys")).select(
                        F.lit(step).alias("step"), "rows", "keys", F.lit(len(rows.columns)).alias("columns"),
                        F.lit(len(versions)).cast("bigint").alias("versions"),
                    ),
                    "step",
                )
            )

        overwrite(customers, name)
        state("1 written")
        dying = F.when(F.col("c_custkey") % 149 == 7, F.raise_error(F.lit("lost"))).otherwise(F.col("c_custkey"))
        with suppress(PySparkException):
            overwrite(customers.withColumn("c_custkey", dying.cast("bigint")), name)
        state("2 died on a row")
        with suppress(ExpectationFailedError):
            overwrite(customers, name, [Expectation("in_credit", "c_acctbal >= 0", "fail")])
        state("3 missed an expectation")
        late = Version(spark, dataset_folder(spark, schema, "customer"))
        customers.limit(1).write.parquet(late.path)
        overwrite(customers, name, [Expectation("in_credit", "c_acctbal >= 0", "drop")])
        with suppress(OvertakenError):
            publish(spark, schema, late, {"customer": ("", customers.schema)})
        state("4 replaced, another overtaken")
        unseen = Version(spark, dataset_folder(spark, schema, "customer"))
        narrow = customers.select("c_custkey")
        narrow.write.parquet(unseen.path)
        unseen.commit({"tables": {"customer": {"folder": "", "columns": narrow.schema.jsonValue()}}, "metrics": []})
        state("5 died before the catalog")
        overwrite(read_table(spark, name).where("c_custkey % 2 = 0"), name)
        state("6 replaced by a part of itself")
    return audit.union_all(steps)


def dataset_graph(spark, folder):
    """Every named dataset of one run (raw, trusted, quarantine, five marts), listed and read back by name."""
    with scratch_schema(spark) as schema:
        warehouse(folder).run(spark, schema)
        names = [r.table_name for r in tables_in(spark, schema).collect()]
        rows = [read_table(spark, f"{schema}.{n}").select(F.lit(n).alias("table_name")) for n in names]
        counted = audit.union_all(rows).groupBy("table_name").agg(F.count("*").alias("rows"))
        listed = tables_in(spark, schema).select("table_name")
        return at_rest(listed.join(counted, "table_name", "left").fillna(0, ["rows"]), "graph")


def expectation_rates(spark, folder):
    """What the writes of all datasets counted: rows that meet each expectation and rows that miss it."""
    with scratch_schema(spark) as schema:
        warehouse(folder).run(spark, schema)
        # The raw tables expect nothing.
        return at_rest(write_metrics(spark, schema), "rates")


def incremental_gate(spark, folder):
    """Orders as decided after three landings: first without their copies, and while half of the customers are missing.

    Late copies turn trusted orders into conflicts, late customers turn orphans into trusted orders. The landings of
    the orders come as a stream.
    """
    names = ("region", "nation", "customer", "orders")
    raw = {n: commerce.raw_table(spark, folder, n) for n in names}
    early = F.pmod(F.xxhash64("c_custkey"), F.lit(2)) == 0
    customers = [raw["customer"].where(early), None, raw["customer"].where(~early)]
    flow = IncrementalFlow(spark, {n: C[n] for n in names}, workspace(spark, "incremental"))
    landing = workspace(spark, "landing")
    columns = raw["orders"].drop(ROW_ID).columns
    flow.land({n: raw[n] for n in ("region", "nation")})
    for landed in range(3):
        if customers[landed] is not None:
            flow.land({"customer": customers[landed]})
        raw["orders"].where(F.col(f"{ROW_ID}.copy") == landed).select(*columns).write.mode("append").parquet(landing)
        flow.stream({"orders": spark.readStream.schema(raw["orders"].select(*columns).schema).parquet(landing)})
    orders = flow.gates["orders"]
    text = lambda c: F.col(c).cast("string")
    trusted = orders.trusted.select(
        text("order_key").alias("orderKey"), text("cust_key").alias("custKey"), text("total_price").alias("totalPrice"),
        text("order_date").alias("orderDate"), F.col("order_priority").alias("orderPriority"), F.lit("").alias(REASONS),
    )
    return trusted.unionByName(orders.rejected.select(*trusted.columns))


def split_store(spark, folder):
    """Both outputs of one write, read back from its two partitions."""
    s = stored(spark, folder, "orders")["orders"]
    return s.table.groupBy("verdict").agg(
        F.count("*").alias("rows"),
        F.count("order_key").alias("typed_keys"),
        F.count("_original").alias("originals"),
    )


def schema_profile(spark, folder):
    """Every column of the trusted orders with its type and how many rows fill it."""
    rows = stored(spark, folder, "orders")["orders"].trusted
    counted = rows.agg(*[F.count(c).alias(c) for c in rows.columns])
    lines = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("type"),
            F.col(f.name).alias("filled"),
        )
        for i, f in enumerate(rows.schema, 1)
    ]
    return counted.select(F.inline(F.array(*lines)))


def preview_orders(spark, folder):
    return commerce.table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    ).orderBy("o_orderkey").limit(5)


# --- gate --------------------------------------------------------------------------------------


def conform_names(spark, folder):
    return typed(commerce.camel_orders(spark, folder), C["orders"]).select(*C["orders"].names)


def gate_clean_orders(spark, folder):
    return staged_orders(spark, folder).trusted


def gate_rejected_orders(spark, folder):
    return staged_orders(spark, folder).rejected.drop(INGESTED_AT)


def _line_contract():
    c = C["lineitem"]
    return type(c)(c.dataset, c.ddl, c.key, c.rules, (), c.about)


def gate_lineitem_conflicts(spark, folder):
    """Lines whose natural key is on several rows; no references are checked."""
    staged = gate(commerce.raw_table(spark, folder, "lineitem", keep_native=True), _line_contract())
    return staged.rejected.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", REASONS
    )


def duplicate_verdicts(spark, folder):
    """Per repeated key of the raw orders: number of copies and whether they agree."""
    raw = commerce.raw_table(spark, folder, "orders")
    suspects = suspect_rows(raw, C["orders"], repeated_keys(raw, C["orders"]))
    return key_verdicts(suspects, C["orders"]).select(
        "order_key", F.col("_copies").alias("copies"), F.col("_alike").alias("alike")
    )


def gate_cascade_lineitem(spark, folder):
    """Lines that lost their order to quarantine."""
    s = stored(spark, folder, "lineitem")["lineitem"]
    return s.rejected.where(F.array_contains(F.split(REASONS, ","), "orphan_l_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", REASONS
    )


def reason_breakdown(spark, folder):
    built = stored(spark, folder, *C)
    return audit.union_all(
        [reason_counts(built[n].rejected).select(F.lit(n).alias("dataset"), "reason", "rows") for n in C]
    )


def row_accounting(spark, folder):
    """Every dataset raw, trusted and quarantined, and the quarantine predicted from the source."""
    built = stored(spark, folder, *C)
    layers = {
        n: (commerce.raw_table(spark, folder, n), built[n].trusted, built[n].rejected) for n in C
    }
    return audit.with_prediction(audit.row_accounting(layers), predicted_quarantine(spark, folder))


def predicted_quarantine(spark, folder):
    """How many rows must be quarantined, worked out from the source tables without the gate."""
    key = F.col("o_orderkey")
    wrong = (key % 101 == 0) | (key % 103 == 0) | (key % 107 == 0) | (key % 109 == 0)
    copies = F.lit(1) + (key % 113 == 0).cast("int") + (key % 127 == 0).cast("int")
    dropped = F.when(wrong | (key % 127 == 0), copies).when(key % 113 == 0, 1).otherwise(0)
    orders = commerce.table(spark, folder, "orders")
    from_orders = orders.agg(F.sum(dropped).cast("bigint").alias("predicted")).select(
        F.lit("orders").alias("dataset"), "predicted"
    )
    lost = orders.where(wrong | (key % 127 == 0)).select(F.col("o_orderkey").alias("l_orderkey"))
    lines = dealt_out(commerce.table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber"), ["l_orderkey"])
    per_key = lines.groupBy("l_orderkey", "l_linenumber").agg(F.count("*").alias("n"))
    per_order = per_key.groupBy("l_orderkey").agg(
        F.sum("n").alias("all_lines"), F.sum(F.when(F.col("n") > 1, F.col("n")).otherwise(0)).alias("repeated")
    )
    from_lines = (
        per_order.join(lost.withColumn("lost", F.lit(True)), "l_orderkey", "left")
        .agg(F.sum(F.when(F.col("lost"), F.col("all_lines")).otherwise(F.col("repeated"))).alias("predicted"))
        .select(F.lit("lineitem").alias("dataset"), "predicted")
    )
    rest = spark.createDataFrame(
        [(n, 0) for n in C if n not in ("orders", "lineitem")], "dataset string, predicted bigint"
    )
    return audit.union_all([from_orders, from_lines, rest])


EXPECTATIONS = {
    "quality_gate": "_reasons = ''",
    "has_customer": "cust_key IS NOT NULL",
    "has_priority": "order_priority IS NOT NULL",
}


def expectation_metrics(spark, folder):
    rows = staged_orders(spark, folder).rows
    return audit.expectation_metrics(rows, EXPECTATIONS, "orders")


def expectation_gate(spark, folder):
    rows = staged_orders(spark, folder).rows
    kept, _ = audit.expect_all_or_drop(rows, {"quality_gate": EXPECTATIONS["quality_gate"]})
    return kept.select(*C["orders"].names, REASONS)


# --- audits ------------------------------------------------------------------------------------


def key_uniqueness(spark, folder):
    built = stored(spark, folder, "lineitem")
    lines = []
    for n in ("orders", "lineitem"):
        key = list(C[n].key)
        before = typed(commerce.raw_table(spark, folder, n), C[n])
        lines.append(audit.key_uniqueness(before, key, f"raw {n}"))
        lines.append(audit.key_uniqueness(built[n].trusted, key, f"trusted {n}"))
    return audit.union_all(lines)


def future_rows(spark, folder):
    """Orders after the snapshot date are scheduled, not wrong: they stay trusted."""
    rows = stored(spark, folder, "orders")["orders"].trusted
    return rows.where(F.col("order_date") > F.to_date(F.lit(commerce.SNAPSHOT_DATE))).select(
        "order_key", "order_date", "total_price"
    )


def scheduled_verdict(spark, folder):
    """Orders after the snapshot date, trusted, against their number worked out from the source."""
    key, day = F.col("o_orderkey"), F.to_date(F.lit(commerce.SNAPSHOT_DATE))
    wrong = (key % 101 == 0) | (key % 103 == 0) | (key % 107 == 0) | (key % 109 == 0) | (key % 127 == 0)
    later = commerce.table(spark, folder, "orders").where(F.to_date("o_orderdate") > day)
    expected = audit.totals(later, {"scheduled orders": F.count_if(~wrong)}).select(
        "check_name", F.col("actual").alias("expected"), F.lit(0.0).alias("tolerance")
    )
    return audit.reconcile(
        audit.totals(future_rows(spark, folder), {"scheduled orders": F.count("*")}), expected
    )


def lossless_join_check(spark, folder):
    b = stored(spark, folder, "orders", "lineitem")
    raw_lines = commerce.table(spark, folder, "lineitem")
    return audit.union_all(
        [
            join_audit(b["orders"].trusted, b["customer"].trusted, "cust_key", "c_custkey", "orders-customer"),
            join_audit(b["customer"].trusted, b["nation"].trusted, "c_nationkey", "n_nationkey", "customer-nation"),
            join_audit(b["lineitem"].trusted, b["part"].trusted, "l_partkey", "p_partkey", "lineitem-part"),
            join_audit(raw_lines, b["orders"].trusted, "l_orderkey", "order_key", "raw lineitem-orders"),
        ]
    )


def _layers(built: dict[str, Stored]) -> dict[str, DataFrame]:
    """Trusted rows, quarantine and all five marts of one build, by name."""
    t = {n: built[n].trusted for n in C}
    frames = {f"trusted {n}": t[n] for n in C} | {f"quarantine {n}": built[n].rejected.drop(INGESTED_AT) for n in C}
    return frames | {f"mart {n}": make(t) for n, make in _MAKE.items()}


def reproducible_build(spark, folder):
    """Two builds of the same input give the same rows: all datasets, their quarantine, all marts."""
    first, second = (at_rest(bucket_totals(_layers(stored(spark, folder, *C))), "totals") for _ in range(2))
    names = spark.createDataFrame([(f"{layer} {n}",) for layer in ("trusted", "quarantine") for n in C] + [(f"mart {n}",) for n in _MAKE], "dataset string")
    return names.join(comparison(first, second), "dataset", "left").fillna(0, ["rows", "rows_again", "buckets_apart"]).fillna(True, ["identical"])


def located_change(spark, folder):
    """A change planted in a copy of the trusted lines, found again: one row altered, one gone, one there twice."""
    lines = stored(spark, folder, "lineitem")["lineitem"].trusted
    line = lambda k: (F.col("l_orderkey") == k)
    bounds = lines.agg(F.min("l_orderkey").alias("a"), F.max("l_orderkey").alias("b")).first()
    changed = (
        lines.where(~line(bounds.a))
        .withColumn("l_tax", F.when(line(bounds.b), F.col("l_tax") + 1).otherwise(F.col("l_tax")))
        .unionByName(lines.where(line(bounds.b - 1)))
    )
    return differing_rows(lines, at_rest(changed, "changed")).select(
        "l_orderkey", "l_linenumber", "l_tax", "copies", "copies_again"
    )


def running_totals(spark, folder):
    """Per customer, order by order: the running sum of reported totals against that of the line totals.

    Both sides are kept; orders without lines add nothing to the second, lines without an order have no customer.
    """
    price = "decimal(28,10)"
    summed = commerce.table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice").cast(price)).alias("_summed")
    )
    reported = commerce.table(spark, folder, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    rows = summed.join(reported, F.col("l_orderkey") == F.col("o_orderkey"), "full").select(
        F.coalesce("o_orderkey", "l_orderkey").alias("order_key"), F.col("o_custkey").alias("cust_key"),
        F.col("o_orderdate").alias("_at"), F.col("o_totalprice").cast(price).alias("_reported"), "_summed",
    )
    totals = {name: F.coalesce(name_of, F.lit(0)).cast(price) for name, name_of in (("reported", "_reported"), ("summed", "_summed"))}
    found = running_sums(rows, ["cust_key"], ["_at", "order_key"], totals)
    apart = F.abs(F.col("reported") - F.col("summed"))
    return found.select(
        "order_key", "cust_key", F.round("reported", 2).cast("double").alias("reported"),
        F.round("summed", 2).cast("double").alias("summed"), (apart < 0.005).alias("agrees"),
    )


def reported_vs_summed(spark, folder):
    """Order totals as reported against the sum of their lines; both sides are kept."""
    summed = commerce.table(spark, folder, "lineitem").groupBy("l_orderkey").agg(
        F.sum(F.col("l_extendedprice").cast("decimal(28,10)")).cast("decimal(28,2)").alias("_summed")
    )
    reported = commerce.table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_totalprice").cast("decimal(28,2)").alias("_reported")
    )
    return summed.join(reported, F.col("l_orderkey") == F.col("o_orderkey"), "full").select(
        F.coalesce("o_orderkey", "l_orderkey").alias("order_key"),
        F.col("_reported").cast("double").alias("reported"),
        F.col("_summed").cast("double").alias("summed"),
        F.coalesce(F.col("_reported") == F.col("_summed"), F.lit(False)).alias("agrees"),
    )


# --- marts -------------------------------------------------------------------------------------


def enriched_orders(spark, folder):
    b = stored(spark, folder, "orders")
    return commerce.enriched_orders(*[b[n].trusted for n in ("orders", "customer", "nation", "region")])


def customer_year_summary(spark, folder):
    b = stored(spark, folder, "orders")
    return commerce.customer_year_summary(b["orders"].trusted, b["customer"].trusted)


def segment_year_summary(spark, folder):
    b = stored(spark, folder, "orders")
    return commerce.segment_year_summary(b["orders"].trusted, b["customer"].trusted)


def brand_year_summary(spark, folder):
    b = stored(spark, folder, "lineitem")
    return commerce.brand_year_summary(b["lineitem"].trusted, b["part"].trusted)


def event_value_evolution(spark, folder):
    events = commerce.events_with_gaps(stored(spark, folder, "events")["events"].trusted)
    return commerce.event_value_evolution(events)


def lines_by_order_year(spark, folder):
    """The two large tables joined: trusted lines with the dates of their trusted orders."""
    b = stored(spark, folder, "lineitem")
    return commerce.lines_by_order_year(b["lineitem"].trusted, b["orders"].trusted)


def nation_history(spark, folder):
    b = stored(spark, folder, "orders")
    return commerce.nation_history(b["orders"].trusted, b["customer"].trusted, b["nation"].trusted)


_NEEDS = {
    "customer_year": ("orders",),
    "segment_year": ("orders",),
    "brand_year": ("lineitem",),
    "nation_history": ("orders",),
    "event_evolution": ("events",),
}
_MAKE = {
    "customer_year": lambda t: commerce.customer_year_summary(t["orders"], t["customer"]),
    "segment_year": lambda t: commerce.segment_year_summary(t["orders"], t["customer"]),
    "brand_year": lambda t: commerce.brand_year_summary(t["lineitem"], t["part"]),
    "nation_history": lambda t: commerce.nation_history(t["orders"], t["customer"], t["nation"]),
    "event_evolution": lambda t: commerce.event_value_evolution(commerce.events_with_gaps(t["events"])),
}


def _marts(spark, folder, *names) -> dict[str, DataFrame]:
    """The named marts over one build."""
    b = stored(spark, folder, *{d for n in names for d in _NEEDS[n]})
    t = {n: b[n].trusted for n in b}
    return {n: _MAKE[n](t) for n in names}


def event_extremes(spark, folder):
    """The evolution of values among which there are NaN, both infinities and very large ones."""
    key = F.col("event_id")
    value = (
        F.when(key % 307 == 0, float("nan")).when(key % 211 == 0, float("inf")).when(key % 401 == 0, float("-inf"))
        .when(key % 101 == 0, 1e19).otherwise(F.col("value"))
    )
    return commerce.event_value_evolution(commerce.table(spark, folder, "events").withColumn("value", value))


def mart_reconciliation(spark, folder):
    """Totals of all five marts against totals counted from the trusted rows; sums of rounded figures get a margin."""
    built = stored(spark, folder, "lineitem", "events")
    t = {n: built[n].trusted for n in built}
    m = {n: make(t) for n, make in _MAKE.items()}
    urgent = F.col("order_priority") == "1-URGENT"
    exact = "decimal(28,10)"
    events = commerce.events_with_gaps(t["events"])
    counted = [
        (t["orders"], {
            "orders by customer": F.count("*"), "orders by nation": F.count("*"), "orders by segment": F.count("*"),
            "spend by customer": F.sum(F.col("total_price").cast(exact)), "spend by segment": F.sum(F.col("total_price").cast(exact)),
            "urgent by customer": F.count_if(urgent), "urgent by segment": F.count_if(urgent),
        }),
        (t["lineitem"], {
            "lines by brand": F.count("*"), "returned by brand": F.count_if(F.col("l_returnflag") == "R"),
            "revenue by brand": F.sum(F.col("l_extendedprice").cast(exact)),
        }),
        (events, {"events by day": F.count("*"), "least value by day": F.min("value")}),
    ]
    # A mart's figure is rounded to a tenth, so each of its rows may be off by a twentieth.
    margin = F.when(F.col("check_name").startswith("spend"), 0.5).when(F.col("check_name").startswith("revenue"), 20.0).otherwise(0.0)
    expected = audit.union_all([audit.totals(rows, measures) for rows, measures in counted]).select(
        "check_name", F.col("actual").alias("expected"), margin.alias("tolerance")
    )
    one = "decimal(28,1)"
    summed = [
        ("customer_year", {
            "orders by customer": F.sum("orders"), "urgent by customer": F.sum("urgent"), "spend by customer": F.sum(F.col("spend").cast(one)),
        }),
        ("segment_year", {
            "orders by segment": F.sum("orders"), "urgent by segment": F.sum("urgent"), "spend by segment": F.sum(F.col("spend").cast(one)),
        }),
        ("nation_history", {"orders by nation": F.sum("orders")}),
        ("brand_year", {
            "lines by brand": F.sum("lines"), "returned by brand": F.sum("returned"), "revenue by brand": F.sum(F.col("revenue").cast(one)),
        }),
        ("event_evolution", {"events by day": F.sum("events"), "least value by day": F.min("least_value")}),
    ]
    return audit.reconcile(audit.union_all([audit.totals(m[n], measures) for n, measures in summed]), expected)


def triangle_check(spark, folder):
    """Two marts over the same orders must agree with each other."""
    m = _marts(spark, folder, "customer_year", "segment_year")
    one = "decimal(28,1)"
    measures = {
        "orders": F.sum("orders"),
        "urgent": F.sum("urgent"),
        "spend": F.sum(F.col("spend").cast(one)),
    }
    expected = audit.totals(m["customer_year"], measures).select(
        "check_name",
        F.col("actual").alias("expected"),
        F.when(F.col("check_name") == "spend", 0.5).otherwise(0.0).alias("tolerance"),
    )
    return audit.reconcile(audit.totals(m["segment_year"], measures), expected)


def mart_audit(spark, folder):
    """Rows and one key sum of all five marts against groups and rows counted in the trusted facts."""
    b = stored(spark, folder, "lineitem", "events")
    t = {n: b[n].trusted for n in b}
    marts = {
        "customer_year": (commerce.customer_year_summary(t["orders"], t["customer"]), "orders"),
        "segment_year": (commerce.segment_year_summary(t["orders"], t["customer"]), "orders"),
        "nation_history": (commerce.nation_history(t["orders"], t["customer"], t["nation"]), "orders"),
        "brand_year": (commerce.brand_year_summary(t["lineitem"], t["part"]), "lines"),
        "event_evolution": (commerce.event_value_evolution(commerce.events_with_gaps(t["events"])), "events"),
    }
    year = F.year("order_date").alias("year")
    who = t["customer"].select(F.col("c_custkey").alias("cust_key"), "c_mktsegment", "c_nationkey")
    ordered = t["orders"].groupBy(year, "cust_key").agg(F.count("*").alias("n")).join(who, "cust_key")
    shipped = t["lineitem"].groupBy(F.year("l_shipdate").alias("year"), F.col("l_partkey").alias("p_partkey")).agg(F.count("*").alias("n"))
    facts = {
        "customer_year": (ordered, ["year", "cust_key"]),
        "segment_year": (ordered, ["year", "c_mktsegment"]),
        "nation_history": (ordered, ["c_nationkey"]),
        "brand_year": (shipped.join(t["part"].select("p_partkey", "p_brand"), "p_partkey"), ["year", "p_brand"]),
        "event_evolution": (t["events"].select(F.to_date("ts").alias("day"), "event_type", F.lit(1).alias("n")), ["day", "event_type"]),
    }
    expected = [
        frame.groupBy(*keys).agg(F.sum("n").alias("n")).agg(
            F.count("*").alias("rows_expected"), F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("key_sum_expected")
        ).select(F.lit(name).alias("mart"), "rows_expected", "key_sum_expected")
        for name, (frame, keys) in facts.items()
    ]
    return audit.mart_audit(marts, audit.union_all(expected))


# --- serving -----------------------------------------------------------------------------------


def _served(query: Callable[..., DataFrame], *marts: str, twice: bool = False):
    """A serving query over the named marts; with ``twice`` they are stored first, as it reads them twice."""

    def run(spark, folder):
        made = _marts(spark, folder, *marts)
        return query(*(at_rest(made[n], n) if twice else made[n] for n in marts))

    return run


def leaders_of_segments(spark, folder):
    """The three leading customers by number of orders, year by year, without SQL text."""
    m = at_rest(_marts(spark, folder, "customer_year")["customer_year"], "customer_year")
    return history_of_leaders(m, "cust_key", F.sum("orders"), 3).select("year", "cust_key", "orders")


def urgent_chart(spark, folder):
    m = _marts(spark, folder, "customer_year")["customer_year"]
    totals = m.groupBy("cust_key", "customer").agg(F.sum("urgent").alias("urgent"))
    return top(totals, 10, "urgent", "cust_key").select("customer", "urgent")


def named_series(spark, folder):
    names = ("BUILDING", "MACHINERY", "FURNITURE")
    m = _marts(spark, folder, "segment_year")["segment_year"]
    return m.where(F.col("segment").isin(*names)).select("year", "segment", "spend")


def lowest_day(spark, folder):
    """The day on which the median purchase value was lowest."""
    m = _marts(spark, folder, "event_evolution")["event_evolution"]
    return series_minimum(m.where(F.col("event_type") == "purchase"), "day", "median_value")


def row_trace(spark, folder):
    """Order 7 through the layers: as landed, as trusted, in its customer's year."""
    b = stored(spark, folder, "orders")
    raw = commerce.raw_table(spark, folder, "orders").where(F.col("orderKey") == "7")
    trusted = b["orders"].trusted
    one = trusted.where(F.col("order_key") == 7)
    year = F.year("order_date")
    mart = commerce.customer_year_summary(trusted, b["customer"].trusted).join(
        F.broadcast(one.select("cust_key", year.alias("year")).limit(1)), ["cust_key", "year"], "left_semi"
    )
    text = lambda c: F.col(c).cast("string")
    return audit.union_all(
        [
            raw.select(F.lit("1 raw").alias("layer"), F.col("custKey").alias("customer"),
                       F.col("totalPrice").alias("amount"), F.col("orderDate").alias("period")),
            one.select(F.lit("2 trusted").alias("layer"), text("cust_key").alias("customer"),
                       text("total_price").alias("amount"), text("order_date").alias("period")),
            mart.select(F.lit("3 mart").alias("layer"), text("cust_key").alias("customer"),
                        F.col("spend").cast("bigint").cast("string").alias("amount"), text("year").alias("period")),
        ]
    )


def key_trace(spark, folder):
    """All orders with copies through the layers: as landed, the verdict on each copy, the marts that count them."""
    b = stored(spark, folder, "orders")
    t = {n: b[n].trusted for n in ("orders", "customer", "nation")}
    raw = commerce.raw_table(spark, folder, "orders")
    copied = (F.col("o_orderkey") % 113 == 0) | (F.col("o_orderkey") % 127 == 0)
    keys = commerce.table(spark, folder, "orders").where(copied).select(F.col("o_orderkey").alias("order_key"))
    year = F.year("order_date")
    trails = {
        "customer_year": Trail(
            commerce.customer_year_summary(t["orders"], t["customer"]), {"year": year, "cust_key": F.col("cust_key")},
            ("year", "cust_key", "orders", "urgent"),
        ),
    }
    return trace(C["orders"], raw, t["orders"], b["orders"].rejected, keys, trails)


def file_ledger_check(spark, folder):
    """Orders landed as four files; afterwards one of them lost a row, and one had a price altered.

    ``remainder`` tells the files apart: each holds the keys with one remainder by four.
    """
    landing = f"{workspace(spark, 'landing')}/orders.csv"
    names = C["orders"].raw_schema.names
    rows = commerce.dirty_orders(spark, folder).select(*names)
    key = F.col("orderKey").cast("bigint")
    for part in range(4):
        some = rows.where(key % 4 == part).coalesce(1)
        some.write.mode("append").option("header", True).option("escape", '"').csv(landing)
    raw = at_rest(read_csv(spark, landing, C["orders"], commerce.RUN_TS), "raw")
    landed = at_rest(file_ledger({"orders": raw}, C), "ledger")
    greatest = raw.agg(F.max(key)).first()[0]
    greatest -= (greatest + 1) % 4  # the last key with remainder three
    altered = F.when(key == greatest - 1, F.lit("1")).otherwise(F.col("totalPrice"))
    now = raw.where(key != greatest).withColumn("totalPrice", altered)
    held = raw.select(F.col(SOURCE_FILE).alias("file"), (key % 4).alias("remainder")).distinct()
    return ledger_check(landed, file_ledger({"orders": now}, C)).join(held, "file").drop("file")


def conflict_evidence(spark, folder):
    """The copies behind two conflicts, as landed."""
    raw = commerce.raw_table(spark, folder, "orders")
    return raw.where(F.col("orderKey").isin("127", "254") & (F.col(SOURCE_FILE) == "orders.parquet")).select(
        "orderKey", "custKey", "totalPrice", "orderDate", "orderPriority"
    ).orderBy("orderKey", "orderPriority")


# --- documentation ------------------------------------------------------------------------------


def column_coverage(spark, folder):
    """All layers stored with comments and tags, twice over; what the catalog then knows of every table."""
    with scratch_schema(spark) as schema:
        graph = warehouse(folder)
        graph.run(spark, schema)
        for _ in range(2):
            graph.document(spark, schema, commerce.DESCRIBER, "Commerce tables in all layers.")
        rows = [read_table(spark, f"{schema}.{n}").select(F.lit(n).alias("table_name")) for n in graph.tables()]
        counted = audit.union_all(rows).groupBy("table_name").agg(F.count("*").alias("rows"))
        known = describe.coverage(spark, schema).join(counted, "table_name", "left").fillna(0, ["rows"])
        return at_rest(known, "coverage")


# --- functions ---------------------------------------------------------------------------------


def scalar_functions(spark, folder):
    """The expressions used in rules, marts and gates, side by side, on every event."""
    e = commerce.table(spark, folder, "events")
    value = F.col("value")
    reasons = F.array_compact(
        F.array(F.when(value < 5, "low"), F.when(F.col("event_type") == "error", "error"))
    )
    return e.select(
        "event_id",
        full_name("event_type", F.when(F.col("user_id") % 2 == 0, F.lit("even"))).alias("label"),
        seconds(F.col("event_id").cast("double")).alias("thousandth"),
        F.when(value < 5, "low").when(value.between(5, 20), "mid").otherwise("high").alias("band"),
        F.when(F.col("event_type") == "click", 1).alias("only_click"),
        F.col("event_type").isin("click", "error").alias("in_set"),
        (F.to_date("ts") >= F.expr("DATE'2024-01-15'")).alias("second_half"),
        F.col("event_type").try_cast("int").isNull().alias("not_a_number"),
        F.array_join(reasons, ",").alias("reasons"),
        F.size(reasons).alias("n_reasons"),
    )


def range_filter(spark, folder):
    """Equality, membership, range and null-tolerant predicates; all reach the Parquet scan."""
    return commerce.table(spark, folder, "lineitem").where(
        (F.col("l_returnflag") == "R")
        & F.col("l_linenumber").isin(1, 2)
        & F.col("l_discount").between(0.02, 0.05)
        & (F.col("l_tax").isNull() | (F.col("l_tax") >= 0.01))
        & F.col("l_shipdate").isNotNull()
    ).select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag")


def distinct_customers(spark, folder):
    """Distinct keys and a distinct count per group."""
    return commerce.table(spark, folder, "orders").groupBy("o_orderstatus").agg(
        F.count_distinct("o_custkey").alias("customers"),
        F.count("*").alias("orders"),
        F.max("o_orderkey").alias("last_key"),
    )


def spend_again(spark, folder):
    """A mart aggregated once more: totals per customer over all years, top 20."""
    m = _marts(spark, folder, "customer_year")["customer_year"]
    totals = m.groupBy("cust_key").agg(
        F.sum("orders").alias("orders"),
        F.sum(F.col("spend").cast("decimal(28,1)")).cast("double").alias("spend"),
        F.sum("unprioritised").alias("unprioritised"),
    )
    return top(totals, 20, "spend", "cust_key")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        raw_provenance, csv_scan, malformed_lines, malformed_accounting, manifest_verdict, landing_presence, snapshot_overwrite,
        atomic_overwrite, dataset_graph, expectation_rates, incremental_gate, split_store,
        schema_profile, preview_orders, conform_names, gate_clean_orders, gate_rejected_orders,
        gate_lineitem_conflicts, duplicate_verdicts, gate_cascade_lineitem, reason_breakdown,
        row_accounting, expectation_metrics, expectation_gate, key_uniqueness, future_rows, scheduled_verdict,
        lossless_join_check, reproducible_build, located_change, reported_vs_summed, running_totals, event_extremes, enriched_orders,
        customer_year_summary, segment_year_summary, brand_year_summary, event_value_evolution,
        nation_history, lines_by_order_year, mart_reconciliation, triangle_check, mart_audit, leaders_of_segments,
        urgent_chart, named_series, lowest_day, row_trace, key_trace, file_ledger_check, conflict_evidence, scalar_functions,
        range_filter, distinct_customers, spend_again, column_coverage,
    )
} | {
    "kpi_row": _served(serving.kpi_row, "customer_year", "nation_history", "event_evolution"),
    "top_customers_by_year": _served(serving.top_customers_by_year, "customer_year", twice=True),
    "top_brands_by_year": _served(serving.top_brands_by_year, "brand_year", twice=True),
    "evolution_series": _served(serving.evolution_series, "event_evolution"),
    "leaderboard": _served(serving.leaderboard, "customer_year"),
    "busiest_nations": _served(serving.busiest_nations, "nation_history"),
}
