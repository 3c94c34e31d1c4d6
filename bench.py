"""Headline queries on local cores; prints one JSON line.

Every query runs three times and the best time counts, so that class loading is not measured;
``first_run`` keeps the first figure. Results go to a sink that computes every column and row.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from registry.spark_queries import QUERIES  # noqa: E402

HEADLINES = [
    "sales_by_year",
    "weekday_profile",
    "item_all_month_profile",
    "series_forecast",
    "series_forecast_500",
    "bucketed_series_forecast",
    "item_forecast",
    "allocated_forecast",
    "prediction_overview",
    "strategy_comparison",
    "walk_forward_forecast",
    "walk_forward_metrics",
    "coverage_overall",
    "quality_profile",
    "contract_violations",
    "deduplicated_sales",
    "enriched_sales",
    "grouped_map_forecast",
    "grouped_map_forecast_500",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        # Inputs of a few MB: let adaptive execution keep one partition per core below its usual 1 MB.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64KB")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    best, first = {}, {}
    for name in HEADLINES:
        times = []
        for _ in range(3):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        first[name], best[name] = round(times[0], 3), round(min(times), 3)
    print(
        json.dumps(
            {
                "metric": "total of headline queries",
                "value": round(sum(best.values()), 3),
                "unit": "sec",
                "queries": best,
                "first_run": first,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
