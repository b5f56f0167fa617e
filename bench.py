"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and prints one JSON line:
{"metric": "total_query_seconds", "value": N, "unit": "sec", "queries": {...}, "sf": ...}.
Each query is executed to completion with the no-op sink (every row and
column is produced, nothing is collected to the driver).  "queries" are first runs in
this order: a query that is the first to need a stage table pays for building it.
"staged" are second runs of the dashboard panels, with every stage table built.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from zonepace.plans.catalog import QUERIES  # noqa: E402
from zonepace.session import get_session  # noqa: E402

HEADLINE = [
    "clean_audit", "clean_trips", "cells_full", "iqr_fence", "describe_trips", "monthly_trend",
    "viz_mart", "hourly_trend", "zone_hour_heatmap", "kpi_row", "map_points",
    "scale_robust", "davies_bouldin", "silhouette_overall", "kmeans_labels",
    "eps_neighbors", "dbscan_labels",
]


PANELS = ["hourly_trend", "zone_hour_heatmap", "kpi_row", "map_points"]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    spark.range(1000).selectExpr("sum(id)").collect()  # start the executor threads; not timed
    times = {}
    for name in only:
        times[name] = run(spark, name, sf_dir)
        print(f"# {name}: {times[name]}s", file=sys.stderr)
    staged = {name: run(spark, name, sf_dir) for name in PANELS if name in times}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "staged": staged, "sf": float(m.group(1)) if m else sf_dir, "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
