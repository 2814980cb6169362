"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (folder of parquet tables), BENCH_CPUS (local threads).
Every result row is produced and thrown away, so whole plans are timed
without the cost of collecting. Each query runs four times at most: "queries" holds the
median of the warm times and "first_run" the first one, which includes class
loading and code generation.
"""

from __future__ import annotations

import json
import os
import re
import time
from statistics import median

from parity.queries import callables
from tallyhouse.session import start

HEADLINE = (
    "daily_sales",
    "daily_sales_by_channel",
    "customer_analytics",
    "product_performance",
    "logistics",
    "inventory_snapshot",
    "inventory_analysis",
    "cart_analytics",
    "customer_retention",
    "return_analysis",
    "top_return_reasons",
    "kpi_orders",
    "kpi_inventory_turnover",
    "silver_orders",
    "silver_order_items",
    "status_changes",
    "order_code",
    "stock_allocation",
    "stock_clamp",
    "discount_split",
    "discounts_in_force",
    "checkout_validation",
    "reviewable_pairs",
    "customer_tier",
    "scd2_customers",
    "constraint_check",
    "wishlist_candidates",
    "addable_products",
    "customer_code",
    "activity_daily_stream",
    "stock_in_turn",
    "due_deadlines",
)


# Beyond this time no warm run is repeated.
REPEAT_SECONDS = 300


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = start(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    run = callables()

    def seconds(name: str) -> float:
        began = time.perf_counter()
        run[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - began, 3)

    first = {name: seconds(name) for name in HEADLINE}
    began = time.perf_counter()

    def warm(name: str) -> float:
        times = [seconds(name)]
        while len(times) < 3 and time.perf_counter() - began < REPEAT_SECONDS:
            times.append(seconds(name))
        return round(median(times), 3)

    timings = {name: warm(name) for name in HEADLINE}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "first_run": first,
                "sf": float(scale.group(1)) if scale else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
