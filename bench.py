"""Benchmark the headline queries.

Runs each query over ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` and prints one JSON line:
  {"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is executed completely with the ``noop`` sink (every row is
produced, nothing is collected to the driver), best of ``$BENCH_REPEAT`` runs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartwheel.plans.registry import queries  # noqa: E402
from cartwheel.session import build_session  # noqa: E402

HEADLINE = [
    "rpt_daily_revenue",
    "fct_order_items",
    "fct_orders",
    "int_events_sessionized",
    "fct_sessions",
    "rpt_daily_funnel",
    "rpt_user_cohort_retention",
    "revenue_at_historical_price",
    "dim_products_history",
    "order_volume_baseline",
    "declared_check_counts",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "2"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "16g"})
    q = queries()
    # Warm-up: JVM, parquet footers, codegen caches.
    q["stg_orders"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    timings = {}
    for name in names:
        best = None
        for _ in range(repeat):
            t0 = time.perf_counter()
            q[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            best = dt if best is None else min(best, dt)
        timings[name] = round(best, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_sec", "value": round(sum(timings.values()), 3),
                      "unit": "sec", "queries": timings,
                      "sf": float(m.group(1)) if m else sf_dir}))
    spark.stop()


if __name__ == "__main__":
    main()
