"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the folder of input tables, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import re
import time

from demandloom.catalog.queries import QUERIES
from demandloom.session import local_session

# From the scan to the plan: aggregation, windows, propensity, features, metrics, allocation.
HEADLINE = (
    "weekly_volume", "store_week_sum", "category_week_mean", "top_product_store", "store_profile",
    "category_product_week_mean", "dense_calendar", "window_features", "scoring_features", "bandit_posterior",
    "bandit_draw", "category_shares", "store_features_scaled", "metric_medae", "allocate",
    "eps_neighbours", "density_components", "core_distances",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/lineitem.parquet").count()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    scale = re.search(r"sf([\d.]+)", folder)
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(scale.group(1)) if scale else None,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
