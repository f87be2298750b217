"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the local cores. A query's time
is the median of three runs after one warm-up run, building the DataFrame and
computing every row of it.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from courierlake.session import build_session
from parity.queries import queries

HEADLINE = (
    "silver_orders",
    "silver_events",
    "order_timeline",
    "order_refunds",
    "dim_restaurants",
    "mart_sla_breach_analysis",
    "mart_restaurant_prep_delays",
    "mart_refund_drivers",
    "mart_rider_performance",
    "mart_weekly_trends",
    "dq_report",
    "late_event_merge",
)
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "courierlake-bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="courierlake-bench-"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    registered, seconds = queries(), {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            started = time.perf_counter()
            registered[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )


if __name__ == "__main__":
    main()
