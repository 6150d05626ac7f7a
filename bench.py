"""Headline timings: one JSON line.

`build` lands the raw tables and builds the star (facts, day dimension) and is counted once; the
other queries read it, the way repeated questions do. Rows are produced in full by a no-op sink.
"""

from __future__ import annotations

import json
import os
import time
from pathlib import Path

from pyspark.sql import SparkSession

from headway.catalog import QUERIES, warehouse

HEADLINE = [
    "flagship", "trips_clean", "merged", "featured", "lag_features", "filter_dashboard",
    "kpi_overview", "rush_compare", "box_by_condition", "correlation_matrix", "ols_trend",
    "top_reasons", "topk_other", "one_hot", "label_encode", "split_stratified", "daily_gapfill",
    "hw_grid_fit", "forecast_scenario", "smote", "train_regression",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()

    times: dict[str, float] = {}
    start = time.time()
    star = warehouse(spark, sf_dir)
    star.days
    star.weather_raw, star.events_raw
    times["build"] = round(time.time() - start, 3)
    for name in HEADLINE:
        start = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        ),
        flush=True,
    )
    spark.stop()


if __name__ == "__main__":
    main()
