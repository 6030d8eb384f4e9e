"""Time the headline queries; prints one line of JSON."""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from tidewatch import catalog

HEADLINE = [
    "g02_cluster_monthly_12m", "g04_product_monthly", "g05_overview_monthly", "m22_gold_tables", "m23_spikes", "x07_chi2_by_row", "x08_odds_ratios",
    "g20_fatality", "g25_quadrants", "g38_keyword_table", "w01_changed_latest", "m05_m06_history", "a05_a08_flatten_split", "m01_match_identifiers", "m16_nearest",
]


def main() -> None:
    sf_dir, cpus = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1"), os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    took = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):  # the first compiles code
            start = time.perf_counter()
            catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        took[name] = round(min(runs), 3)
    print(json.dumps({"metric": "headline queries, warm, total", "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "sf": sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
