"""Times the headline queries and prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1), ``BENCH_CPUS`` the cores. Every query is run in
full (a ``noop`` write), builds included, twice in a row; the faster run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

from sluiceworks.plans.queries import QUERIES  # noqa: E402
from sluiceworks.session import session  # noqa: E402

HEADLINE = (
    "csv_scan",
    "gate_clean_orders",
    "gate_lineitem_conflicts",
    "gate_cascade_lineitem",
    "enriched_orders",
    "customer_year_summary",
    "brand_year_summary",
    "event_value_evolution",
    "nation_history",
    "top_customers_by_year",
    "kpi_row",
    "reported_vs_summed",
    "range_filter",
    "distinct_customers",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = session(
        app="bench",
        master=f"local[{cpus}]",
        spark_ui_enabled="false",
        spark_ui_showConsoleProgress="false",
        spark_sql_shuffle_partitions=cpus,
        spark_driver_memory="12g",
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {name: round(min(run(name), run(name)), 3) for name in HEADLINE}
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
