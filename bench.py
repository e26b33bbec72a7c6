"""Time the headline queries on ``$BENCH_SF_DIR`` and print one JSON line.

Each query runs once to warm up and then ``$BENCH_RUNS`` times, of which the
median counts. A result is written out in full to Spark's no-op sink.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillwork import session  # noqa: E402
from tillwork.registry import all_queries  # noqa: E402

HEADLINES = (
    "stg_orders", "stg_order_items", "dim_products", "dim_customers", "fact_order_items",
    "mart_weekly_revenue", "mart_top_products", "top10_products", "top3_products_per_week",
    "customer_ltv", "weekly_revenue_filled", "dedup_items", "union_sources",
    "union_tables_like", "pivot_status", "unpivot_orders", "surrogate_keys", "safe_ratios",
    "order_histogram", "customer_distance", "traffic_by_host", "check_sequential_values",
    "check_mutually_exclusive_ranges", "check_relationships_where", "check_equality",
    "check_suite", "json_items", "stream_weekly",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session.build(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false", spark__driver__memory="16g",
        spark__ui__showConsoleProgress="false",
        spark__checkpoint__dir=tempfile.mkdtemp(prefix="bench-"),
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    names = [n for n in sys.argv[1:] if n in queries] or HEADLINES
    seconds = {}
    for name in names:
        taken = []
        for _ in range(runs + 1):
            begin = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - begin)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    print(json.dumps({
        "metric": "sum of median query times", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "cpus": int(cpus),
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
