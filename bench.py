"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the data (default sf0.1), ``BENCH_CPUS`` the cores. Each query runs once to
warm up and is then timed; a time covers building, planning and running the query. Per-row results
go to the no-op sink, so that the result is computed completely without being collected.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from stratamart.queries import queries

HEADLINE = [
    "dim_date",
    "dedup_orders_detail",
    "fact_order_line",
    "orders_3m",
    "dim_features",
    "gold_sales_customer_3m",
    "order_gaps",
    "reconcile_features_vs_sales",
    "null_counts",
    "fk_violations",
    "describe_fact",
    "medallion_end_to_end",
]
WARM_UPS = 1
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("stratamart-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    registered = queries()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(WARM_UPS + RUNS):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[WARM_UPS:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
