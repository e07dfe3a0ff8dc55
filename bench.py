"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and then BENCH_REPEATS times (2 by default);
its figure is the median. A run covers building the plan, the jobs that takes,
and computing every row of the result.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from marketlane import registry, scratch, session

HEADLINE = [
    "o1_silver_orders_enriched",
    "o2_customer_profiles",
    "o3_incremental_silver_merge",
    "o5_daily_sales_summary",
    "o6_customer_360",
    "o7_product_performance",
    "o9_orders_enriched_job",
    "o10_daily_sales_job",
    "o11_product_performance_job",
    "o12_top_customers",
    "o13_revenue_by_category",
    "o14_monthly_trend",
    "o15_orders_enriched_dag",
    "o16_daily_sales_dag",
    "o17_customer_metrics_dag",
    "o18_product_performance_dag",
    "o19_regional_sales_dag",
    "o20_kpi_report",
    "o22_order_rollup",
    "g1_customer_windows",
    "g2_favourites",
    "g3_global_ntile",
    "g5_rank_in_group",
    "j1_upsert_orders",
    "l3_state_as_of",
    "n1_table_checks",
    "n3_flag_distribution",
]


def timed(fn, spark, folder: str) -> float:
    start = time.perf_counter()
    fn(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    repeats = int(os.environ.get("BENCH_REPEATS", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = session.build(cores, "bench")
    seconds = {}
    for name in names:
        fn = registry.QUERIES[name]
        timed(fn, spark, folder)
        seconds[name] = round(statistics.median(timed(fn, spark, folder) for _ in range(repeats)), 3)
    scratch.clear(spark)
    spark.stop()
    scale = Path(folder).name.removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
