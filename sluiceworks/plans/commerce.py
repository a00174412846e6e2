"""The order-processing tables: contracts, raw forms and marts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sluiceworks.contract import Contract, Reference
from sluiceworks.functions import NULL_MARKER, count_where, decimal_sum, exact_sum, money
from sluiceworks.operators.describe import Describer
from sluiceworks.operators.gate import dealt_out_if_many
from sluiceworks.operators.joins import beside, lookup
from sluiceworks.operators.medians import exact_median, group_sizes, value_counts
from sluiceworks.sources import at_rest
from sluiceworks.sources.raw import ROW_ID, as_text, read_parquet, stamped

RUN_TS = datetime(2024, 2, 1)
SNAPSHOT_DATE = "2001-01-01"
CONTRACTS = {
    c.dataset: c
    for c in (
        Contract(
            "region",
            "r_regionkey INT NOT NULL, r_name STRING NOT NULL COMMENT 'Region name.'",
            ("r_regionkey",),
            about="World regions.",
        ),
        Contract(
            "nation",
            "n_nationkey INT NOT NULL, n_name STRING NOT NULL COMMENT 'Nation name.', "
            "n_regionkey INT NOT NULL",
            ("n_nationkey",),
            references=(Reference("n_regionkey", "region", "r_regionkey"),),
            about="Nations, each in one region.",
        ),
        Contract(
            "customer",
            "c_custkey BIGINT NOT NULL, c_name STRING NOT NULL COMMENT 'Customer name.', "
            "c_nationkey INT NOT NULL, "
            "c_acctbal DOUBLE COMMENT 'Account balance; negative when in debt.', "
            "c_mktsegment STRING COMMENT 'Market segment.'",
            ("c_custkey",),
            references=(Reference("c_nationkey", "nation", "n_nationkey"),),
            about="Customers.",
        ),
        Contract(
            "supplier",
            "s_suppkey BIGINT NOT NULL, s_name STRING NOT NULL COMMENT 'Supplier name.', "
            "s_nationkey INT NOT NULL, s_acctbal DOUBLE COMMENT 'Account balance.'",
            ("s_suppkey",),
            references=(Reference("s_nationkey", "nation", "n_nationkey"),),
            about="Suppliers.",
        ),
        Contract(
            "part",
            "p_partkey BIGINT NOT NULL, p_name STRING NOT NULL COMMENT 'Part name.', "
            "p_brand STRING NOT NULL COMMENT 'Brand.', p_type STRING COMMENT 'Kind of part.', "
            "p_size INT COMMENT 'Size in units (at least 1).', "
            "p_retailprice DOUBLE COMMENT 'List price.'",
            ("p_partkey",),
            rules={"size_ge_1": "p_size IS NULL OR p_size >= 1", "price_ge_0": "p_retailprice >= 0"},
            about="Parts on sale.",
        ),
        Contract(
            "orders",
            "orderKey BIGINT NOT NULL, custKey BIGINT NOT NULL, "
            "totalPrice BIGINT NOT NULL COMMENT 'Order total in whole currency units.', "
            "orderDate DATE NOT NULL COMMENT 'Day of the order; later than the snapshot if scheduled.', "
            "orderPriority STRING COMMENT 'Priority class, 1-URGENT to 5-LOW; NULL if not given.'",
            ("order_key",),
            rules={"total_ge_0": "total_price >= 0"},
            references=(Reference("cust_key", "customer", "c_custkey"),),
            about="Orders, one row each.",
        ),
        Contract(
            "lineitem",
            "l_orderkey BIGINT NOT NULL, l_partkey BIGINT NOT NULL, l_suppkey BIGINT NOT NULL, "
            "l_linenumber INT NOT NULL COMMENT 'Line within the order (at least 1).', "
            "l_quantity DOUBLE NOT NULL COMMENT 'Quantity.', "
            "l_extendedprice DOUBLE NOT NULL COMMENT 'Price before discount and tax.', "
            "l_discount DOUBLE COMMENT 'Discount as a fraction.', "
            "l_tax DOUBLE COMMENT 'Tax as a fraction.', "
            "l_returnflag STRING COMMENT 'Return flag.', l_linestatus STRING COMMENT 'Line status.', "
            "l_shipdate DATE COMMENT 'Day of shipping.'",
            ("l_orderkey", "l_linenumber"),
            rules={
                "line_ge_1": "l_linenumber >= 1",
                "quantity_ge_0": "l_quantity >= 0",
                "discount_range": "l_discount IS NULL OR l_discount BETWEEN 0 AND 1",
                "ship_range": "l_shipdate BETWEEN DATE'1990-01-01' AND DATE'2030-12-31'",
            },
            references=(
                Reference("l_orderkey", "orders", "order_key"),
                Reference("l_partkey", "part", "p_partkey"),
                Reference("l_suppkey", "supplier", "s_suppkey"),
            ),
            about="Order lines.",
        ),
        Contract(
            "events",
            "event_id BIGINT NOT NULL, ts TIMESTAMP_NTZ NOT NULL COMMENT 'When it happened.', "
            "user_id BIGINT NOT NULL, event_type STRING NOT NULL COMMENT 'Kind of event.', "
            "value DOUBLE COMMENT 'Measured value; NULL if not recorded.', "
            "props STRING COMMENT 'Further properties as text.'",
            ("event_id",),
            references=(Reference("user_id", "customer", "c_custkey"),),
            about="Customer events.",
        ),
        Contract(
            "documents",
            "doc_id BIGINT NOT NULL, text STRING NOT NULL COMMENT 'Full text.', "
            "lang STRING NOT NULL COMMENT 'Language.', source STRING COMMENT 'Origin.', "
            "n_chars BIGINT NOT NULL COMMENT 'Length in characters.'",
            ("doc_id",),
            rules={"chars_ge_0": "n_chars >= 0"},
            about="Documents.",
        ),
        Contract(
            "labels",
            "doc_id BIGINT NOT NULL, quality INT NOT NULL COMMENT 'Quality flag, 0 or 1.', "
            "toxic INT NOT NULL COMMENT 'Toxicity flag, 0 or 1.'",
            ("doc_id",),
            rules={"flags": "quality BETWEEN 0 AND 1 AND toxic BETWEEN 0 AND 1"},
            references=(Reference("doc_id", "documents", "doc_id"),),
            about="Document labels.",
        ),
        Contract(
            "conversations",
            "conv_id BIGINT NOT NULL, turn BIGINT NOT NULL COMMENT 'Position in the conversation.', "
            "role STRING NOT NULL COMMENT 'Speaker.', text STRING COMMENT 'What was said.'",
            ("conv_id", "turn"),
            rules={"turn_ge_0": "turn >= 0"},
            about="Conversations, one row per turn.",
        ),
        Contract(
            "pages",
            "page_id BIGINT NOT NULL, url STRING NOT NULL COMMENT 'Address of the page.', "
            "html STRING COMMENT 'Page source.'",
            ("page_id",),
            about="Web pages.",
        ),
        Contract(
            "benchmark",
            "item_id BIGINT NOT NULL, text STRING NOT NULL COMMENT 'Passage.'",
            ("item_id",),
            about="Benchmark passages.",
        ),
        Contract(
            "embeddings",
            "vec_id BIGINT NOT NULL, label INT COMMENT 'Cluster label.'",
            ("vec_id",),
            about="Labels of the vectors; the vectors themselves are not under contract.",
        ),
    )
}

DESCRIBER = Describer(
    CONTRACTS,
    texts={
        "year": "Calendar year.",
        "cust_key": "Customer.",
        "customer": "Customer name.",
        "segment": "Market segment.",
        "orders": "Trusted orders.",
        "urgent": "Orders of the highest priority.",
        "urgent_or_high": "Orders of the two highest priorities.",
        "spend": "Sum of order totals.",
        "unprioritised": "Orders without a priority.",
        "smallest": "Smallest order total.",
        "n_nationkey": "Nation.",
        "nation": "Nation name.",
        "first_year": "First year with an order.",
        "last_year": "Latest year with an order.",
        "urgent_customers": "Different customers with an urgent order.",
        "brand": "Brand.",
        "lines": "Trusted order lines.",
        "returned": "Lines that were returned.",
        "revenue": "Sum of prices before discount and tax.",
        "least_quantity": "Smallest quantity of a line.",
        "day": "Day.",
        "event_type": "Kind of event.",
        "events": "Trusted events.",
        "avg_value": "Average of the recorded values.",
        "median_value": "Exact median of the recorded values.",
        "least_value": "Smallest recorded value.",
        "_source_file": "File the row came from.",
        "_ingested_at": "When the run that landed it began.",
        "_original": "The row as landed, every value as text.",
        "_reasons": "Why the row is not trusted, joined by commas.",
    },
    overrides={("customer", "c_nationkey"): "Nation the customer lives in (nation.n_nationkey)."},
    patterns=((r"_mktsegment$", "Market segment as recorded."), (r"^l_linenumber$", "Line within the order (at least 1).")),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def raw_table(spark: SparkSession, folder: str, name: str, keep_native: bool = False) -> DataFrame:
    """A stored table in raw form: the contract's columns as strings, provenance, row id."""
    if name == "orders":
        return dirty_orders(spark, folder)
    wanted = [c.source for c in CONTRACTS[name].columns]
    scan = read_parquet(spark, f"{folder}/{name}.parquet")
    rows = as_text(scan, wanted, keep_native)
    return stamped(rows, _file_name(), RUN_TS)


def _file_name() -> Column:
    """The name of the file a row was read from, by its row id."""
    return F.element_at(F.split(F.col(f"{ROW_ID}.file"), "/"), -1)


def dirty_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with known faults in fixed places: markers, bad casts, orphans, copies, conflicts.

    One scan; an order that is there several times becomes an array of copy numbers.
    """
    key = F.col("o_orderkey")
    every = lambda n: key % n == 0
    price = F.floor("o_totalprice").cast("bigint").cast("string")
    copies = F.array_compact(F.array(F.lit(0), F.when(every(113), 1), F.when(every(127), 2)))
    rows = read_parquet(spark, f"{folder}/orders.parquet").select(
        key.cast("string").alias("orderKey"),
        F.when(every(101), NULL_MARKER)
        .when(every(103), "999999999")
        .otherwise(F.col("o_custkey").cast("string"))
        .alias("custKey"),
        F.when(every(107), "n/a").when(every(109), "-1").otherwise(price).alias("totalPrice"),
        F.col("o_orderdate").cast("date").cast("string").alias("orderDate"),
        F.when(every(89), NULL_MARKER).otherwise(F.col("o_orderpriority")).alias("orderPriority"),
        F.explode(copies).alias("_copy"),
        ROW_ID,
    )
    priority = F.when(F.col("_copy") == 2, "X-CONFLICT").otherwise(F.col("orderPriority"))
    row_id = F.struct(F.col("_copy").alias("copy"), f"{ROW_ID}.file", f"{ROW_ID}.row")
    rows = rows.select(
        "orderKey", "custKey", "totalPrice", "orderDate", priority.alias("orderPriority"),
        row_id.alias(ROW_ID),
    )
    return stamped(rows, _file_name(), RUN_TS)


def camel_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as text under camelCase names, without faults."""
    rows = read_parquet(spark, f"{folder}/orders.parquet").select(
        F.col("o_orderkey").cast("string").alias("orderKey"),
        F.col("o_custkey").cast("string").alias("custKey"),
        F.floor("o_totalprice").cast("bigint").cast("string").alias("totalPrice"),
        F.col("o_orderdate").cast("date").cast("string").alias("orderDate"),
        F.col("o_orderpriority").alias("orderPriority"),
        ROW_ID,
    )
    return stamped(rows, _file_name(), RUN_TS)


# --- marts -----------------------------------------------------------------------------------
# Facts are aggregated on keys before names are joined to them: a hot key has shrunk to a few rows
# by the time anything is shuffled, and names are looked up once per result row.


def enriched_orders(orders: DataFrame, customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Trusted orders with the customer's name and place, one row per order."""
    place = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        "n_nationkey", F.col("n_name").alias("nation"), F.col("r_name").alias("region")
    )
    who = customer.join(place, customer.c_nationkey == place.n_nationkey).select(
        F.col("c_custkey").alias("cust_key"), F.col("c_name").alias("customer"),
        F.col("c_mktsegment").alias("segment"), "nation", "region",
    )
    return lookup(orders, who, "cust_key", ["order_key"]).select(
        "order_key", F.year("order_date").alias("year"), "order_date", "cust_key", "customer",
        "segment", "nation", "region", "total_price", "order_priority",
    )


def customer_year_summary(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per year and customer: orders, priority classes, spend, unprioritised, smallest."""
    urgent = F.col("order_priority") == "1-URGENT"
    high = F.col("order_priority") <= "2-HIGH"
    dated = orders.select(F.year("order_date").alias("year"), "cust_key", "order_priority", "total_price")
    per_key = dealt_out_if_many(dated, ["year", "cust_key"], ["cust_key"]).groupBy("year", "cust_key").agg(
        F.count("*").alias("orders"),
        count_where(urgent).alias("urgent"),
        count_where(high).alias("urgent_or_high"),
        decimal_sum("total_price", 1).alias("spend"),
        count_where(F.col("order_priority").isNull()).alias("unprioritised"),
        F.min("total_price").alias("smallest"),
    )
    names = customer.select(
        F.col("c_custkey").alias("cust_key"),
        F.col("c_name").alias("customer"),
        F.col("c_mktsegment").alias("segment"),
    )
    return beside(per_key, names, "cust_key").select(
        "year", "cust_key", "customer", "segment", "orders", "urgent", "urgent_or_high", "spend",
        "unprioritised", "smallest",
    )


def brand_year_summary(lineitem: DataFrame, part: DataFrame) -> DataFrame:
    """One row per ship year and brand, from sums per part."""
    shipped = lineitem.select(F.year("l_shipdate").alias("year"), "l_partkey", "l_returnflag", "l_extendedprice", "l_quantity")
    per_part = dealt_out_if_many(shipped, ["year", "l_partkey"], ["l_partkey"]).groupBy("year", "l_partkey").agg(
        F.count("*").alias("lines"),
        count_where(F.col("l_returnflag") == "R").alias("returned"),
        F.sum(F.col("l_extendedprice").cast("decimal(28,10)")).alias("revenue"),
        F.min("l_quantity").alias("least_quantity"),
    )
    brands = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_brand").alias("brand"))
    return (
        beside(per_part, brands, "l_partkey")
        .groupBy("year", "brand")
        .agg(
            F.sum("lines").alias("lines"),
            F.sum("returned").alias("returned"),
            F.round(F.sum("revenue"), 1).cast("double").alias("revenue"),
            F.min("least_quantity").alias("least_quantity"),
        )
    )


def events_with_gaps(events: DataFrame) -> DataFrame:
    """Every fiftieth value is not recorded."""
    return events.withColumn("value", F.when(F.col("event_id") % 50 != 0, F.col("value")))


def event_value_evolution(events: DataFrame) -> DataFrame:
    """Per day and type: all events, and average, exact median and minimum of the recorded values.

    Values are counted as the doubles they are. NaN is the greatest value; an average with it is NaN, one with
    infinities infinite, or NaN if both are there.
    """
    groups = ["day", "event_type"]
    rows = events.select(F.to_date("ts").alias("day"), "event_type", F.col("value").cast("double").alias("value"))
    counts = at_rest(value_counts(rows, groups, "value"), "event-values")
    recorded = F.sum(F.when(F.col("value").isNotNull(), F.col("copies")))
    basics = counts.groupBy(*groups).agg(
        F.sum("copies").alias("events"),
        F.round(exact_sum(F.col("value"), F.col("copies")) / recorded, 3).alias("avg_value"),
        F.min("value").alias("least_value"),
        *group_sizes("value"),
    )
    basics = at_rest(basics, "event-groups")
    medians = exact_median(counts, groups, "value", known=basics).select(
        *groups, F.round("median", 3).alias("median_value")
    )
    return basics.join(medians, groups, "left").select(
        *groups, "events", "avg_value", "median_value", "least_value"
    )


def lines_by_order_year(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """One row per year of ordering: lines, and how many days after the order they were shipped."""
    dated = orders.select(F.col("order_key").alias("l_orderkey"), "order_date")
    lines = lineitem.select("l_orderkey", "l_linenumber", "l_shipdate")
    days = F.datediff("l_shipdate", "order_date").cast("bigint")
    return lookup(lines, dated, "l_orderkey", ["l_linenumber"]).groupBy(F.year("order_date").alias("year")).agg(
        F.count("*").alias("lines"),
        F.sum(days).alias("days_to_ship"),
        F.min(days).alias("fewest_days"),
        F.max(days).alias("most_days"),
    )


def nation_history(orders: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Per nation that ever ordered: orders, first and last year, customers with an urgent order.

    Nations without any order are left out; those without an urgent one have 0.
    """
    dated = orders.select(F.year("order_date").alias("year"), "cust_key", "order_priority")
    per_customer = dealt_out_if_many(dated, ["cust_key"]).groupBy("cust_key").agg(
        F.count("*").alias("orders"),
        F.min("year").alias("first_year"),
        F.max("year").alias("last_year"),
        count_where(F.col("order_priority") == "1-URGENT").alias("urgent"),
    )
    at = customer.select(F.col("c_custkey").alias("cust_key"), F.col("c_nationkey").alias("n_nationkey"))
    return (
        beside(per_customer, at, "cust_key")
        .groupBy("n_nationkey")
        .agg(
            F.sum("orders").alias("orders"),
            F.min("first_year").alias("first_year"),
            F.max("last_year").alias("last_year"),
            count_where(F.col("urgent") > 0).alias("urgent_customers"),
        )
        .join(nation.select("n_nationkey", F.col("n_name").alias("nation")), "n_nationkey")
        .select("n_nationkey", "nation", "orders", "first_year", "last_year", "urgent_customers")
    )


def segment_year_summary(orders: DataFrame, customer: DataFrame) -> DataFrame:
    """One row per year and market segment, from sums per customer."""
    dated = orders.select(F.year("order_date").alias("year"), "cust_key", "order_priority", "total_price")
    per_key = dealt_out_if_many(dated, ["year", "cust_key"], ["cust_key"]).groupBy("year", "cust_key").agg(
        F.count("*").alias("orders"),
        count_where(F.col("order_priority") == "1-URGENT").alias("urgent"),
        F.sum(F.col("total_price").cast("decimal(28,10)")).alias("spend"),
        F.min("total_price").alias("smallest"),
    )
    segments = customer.select(F.col("c_custkey").alias("cust_key"), F.col("c_mktsegment").alias("segment"))
    return (
        beside(per_key, segments, "cust_key")
        .groupBy("year", "segment")
        .agg(
            F.sum("orders").alias("orders"),
            F.sum("urgent").alias("urgent"),
            F.round(F.sum("spend"), 1).cast("double").alias("spend"),
            F.min("smallest").alias("smallest"),
        )
    )
