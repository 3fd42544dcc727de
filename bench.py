"""Times the headline queries; prints one JSON line.

Each query is planned and run to a ``noop`` sink, dimensions included. After one
BENCH_RUNS runs is reported. ``value`` is the sum.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from orefold.registry import all_queries  # noqa: E402
from orefold.session import build_session  # noqa: E402

HEADLINE = (
    "t09_fact_sales",
    "t01_clean_customers",
    "t02_clean_products",
    "t03_clean_sales",
    "t07_dim_customers",
    "t08_dim_products",
    "m01_flat_sales",
    "m02_sales_by_product_group",
    "m02_sales_by_customer_group",
    "w01_numbered",
    "d06_unknown_categories",
    "d07_products_sold",
    "d12_order_dates",
    "d13_late_orders",
    "d14_measures",
    "d15_measures_repaired",
    "d23_facts_without_customer",
    "gate_star_schema",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = all_queries()

    def run(name: str) -> float:
        started = time.perf_counter()
        registered[name].run(spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    for name in names:
        run(name)
    seconds = {}
    for name in names:
        taken = [run(name) for _ in range(runs)]
        seconds[name] = round(statistics.median(taken), 3)
        print(name, [round(t, 2) for t in taken], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(folder.rstrip("/")).removeprefix("sf")),
            }
        )
    )


if __name__ == "__main__":
    main()
