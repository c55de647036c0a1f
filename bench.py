"""Benchmark of the headline queries; prints one JSON line.

Inputs that queries share (warehouse, staging area) are prepared before the clock starts; building
them is timed by the queries that do it. Every query runs once for warm-up, then the median of the
measured runs is taken.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skymart.plans import catalog  # noqa: E402
from skymart.session import local_session  # noqa: E402

HEADLINE = (
    "p2_parse_raw_json",
    "p3_normalize_forecast",
    "p12_nearest_entry",
    "c7_clean_standardize",
    "f1_add_features",
    "k5_classify",
    "t1_moving_average",
    "a1_detect_anomalies",
    "pr1_predict",
    "r1_run_transform",
    "l7_load",
    "v1_overview",
    "v2_analytics",
    "v3_trend",
    "v4_heatmap",
    "v5_prediction",
    "v6_anomaly",
    "g2_current",
    "g4_map",
    "g5_forecast_adm4",
    "g9_trend",
    "g11_heatmap",
    "u1_hottest_per_parent",
    "u6_alert_polygons",
    "x3_mercator_project",
    "x4_points_in_polygons",
    "x6_idw",
    "st1_ingest_stream",
)
RUNS = {"l7_load": 1, "st1_ingest_stream": 1}


def timed(run) -> float:
    start = time.perf_counter()
    run().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cores, "skymart-bench")
    catalog.warehouse(spark, sf_dir)
    catalog.staging(spark, sf_dir)
    catalog.forecasts(spark, sf_dir)
    seconds = {}
    for name in names:
        run = lambda: catalog.QUERIES[name](spark, sf_dir)
        timed(run)
        seconds[name] = round(statistics.median(timed(run) for _ in range(RUNS.get(name, 3))), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
