"""Serving queries over marts: one-row figures, leaders and their history, ordered lists.

Only marts are read. Ties are broken by the key. Marts that are read twice should be at rest.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluiceworks.functions import decimal_sum
from sluiceworks.operators.ranking import history_of_leaders, top


def one_row(*figures: DataFrame) -> DataFrame:
    """One-row aggregates side by side: a tagged union and a maximum, no cross join."""
    tagged = figures[0]
    for more in figures[1:]:
        tagged = tagged.unionByName(more, allowMissingColumns=True)
    return tagged.agg(*[F.max(c).alias(c) for c in tagged.columns])


def kpi_row(customer_year: DataFrame, nation_history: DataFrame, event_evolution: DataFrame) -> DataFrame:
    """Headline figures, each mart aggregated once."""
    return one_row(
        customer_year.agg(
            F.count_distinct("year").alias("years_covered"),
            F.count_distinct("cust_key").alias("customers_ever"),
            F.sum("urgent").alias("urgent_orders"),
        ),
        nation_history.agg(F.sum("orders").alias("orders_placed")),
        event_evolution.agg(F.sum("events").alias("events_recorded")),
    )


def top_customers_by_year(customer_year: DataFrame) -> DataFrame:
    """Every year of the five customers who spent most."""
    rows = history_of_leaders(customer_year, "cust_key", decimal_sum("spend", 1), 5)
    return rows.select("year", "cust_key", "customer", "spend", "urgent").orderBy("year", "customer", "cust_key")


def top_brands_by_year(brand_year: DataFrame) -> DataFrame:
    """Every year of the five brands with most revenue."""
    rows = history_of_leaders(brand_year, "brand", decimal_sum("revenue", 1), 5)
    return rows.select("year", "brand", "revenue", "lines").orderBy("year", "brand")


def evolution_series(event_evolution: DataFrame) -> DataFrame:
    columns = ("day", "event_type", "events", "avg_value", "median_value", "least_value")
    return event_evolution.select(*columns).orderBy("day", "event_type")


def leaderboard(customer_year: DataFrame) -> DataFrame:
    """Ten names by urgent orders; customers of one name share a line on purpose."""
    by_name = customer_year.groupBy("customer").agg(
        F.sum("urgent").alias("urgent"),
        F.sum("urgent_or_high").alias("urgent_or_high"),
        decimal_sum("spend", 1).alias("spend"),
    )
    return top(by_name, 10, "urgent", "customer")


def busiest_nations(nation_history: DataFrame) -> DataFrame:
    columns = ("nation", "orders", "first_year", "last_year", "urgent_customers")
    return top(nation_history.select(*columns), 15, "orders", "nation")
