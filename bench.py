"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed to completion with the ``noop`` writer (the whole
plan runs, nothing is collected). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from jobtide.plans import queries as Q  # noqa: E402
from jobtide.session import get_spark  # noqa: E402

HEADLINE = [
    "ts01_demand_monthly", "ts01_demand_weekly", "ts01_demand_2w",
    "join03_demand_monthly_explode",
    "fn01_weight_parse", "api01_prepared_spans", "agg02_encoding_maps",
    "agg10_group_stats", "top02_top_groups", "agg14_monthly_counts", "agg15_weight_histograms",
    "ts04_anomaly_flags", "ts05_repair_sequential", "ts02_outliers_cubic_z2", "ts07_decompose",
    "ts08_features", "agg21_metrics_naive", "ml09_recursive_naive", "src08_incremental_ingest",
    "api02_forecast_pipeline",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:] if not a.startswith("-")]
    spark = get_spark(f"local[{cpus}]", app="jobtide-bench",
                      shuffle_partitions=max(8, 2 * int(cpus)),
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    # warm-up: JVM, parquet readers, codegen caches
    Q.QUERIES["agg09_value_counts"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name in only or HEADLINE:
        spark.catalog.clearCache()  # no query reads what an earlier one cached
        t0 = time.perf_counter()
        Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        print(f"# {name}: {times[name]}s", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_time", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
