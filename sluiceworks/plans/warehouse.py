"""The commerce tables as one graph of named datasets: raw, trusted, quarantine and the five marts."""

from __future__ import annotations

from sluiceworks.operators.expectations import Expectation
from sluiceworks.plans import commerce
from sluiceworks.plans.graph import Graph


def warehouse(folder: str) -> Graph:
    """Everything below ``folder`` under contract, and the marts over it."""
    g = Graph(commerce.CONTRACTS, lambda spark, name: commerce.raw_table(spark, folder, name))

    g.dataset(
        "customer_year_summary", ("orders", "customer"), "Orders and spend per customer and year.",
        (Expectation("has_orders", "orders > 0", "fail"), Expectation("spends", "spend > 0", "warn")),
    )(commerce.customer_year_summary)
    g.dataset(
        "segment_year_summary", ("orders", "customer"), "Orders and spend per market segment and year.",
        (Expectation("has_orders", "orders > 0", "fail"),),
    )(commerce.segment_year_summary)
    g.dataset(
        "brand_year_summary", ("lineitem", "part"), "Lines and revenue per brand and year of shipping.",
        (Expectation("has_brand", "brand IS NOT NULL", "drop"),),
    )(commerce.brand_year_summary)
    g.dataset("nation_history", ("orders", "customer", "nation"), "Orders per nation over all years.")(commerce.nation_history)

    @g.dataset("event_value_evolution", ("events",), "Recorded values per day and kind of event.")
    def evolution(events):
        return commerce.event_value_evolution(commerce.events_with_gaps(events))

    return g
