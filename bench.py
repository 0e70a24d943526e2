"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_RUNS (default 3).
Each figure is the median of the runs of one query into a no-op sink, plan building included.
Merges and loads run anew every time. Reports read warehouse tables that are built before;
building them is reported as ``build_sec`` too and is part of ``value``.
"""

from __future__ import annotations

import json
import os
import platform
import statistics
import tempfile
import time

import pyspark

from staywarehouse import session
from staywarehouse.checks.loaded import loaded
from staywarehouse.checks.queries import registered

HEADLINE = (
    "cl01_clean_events", "io03_staging_append", "dd01_calendar",
    "sc01_merge_users", "sc02_merge_hosts", "sc03_merge_properties",
    "sc04_users_would_update", "sc04_properties_would_update",
    "hi01_user_history", "hi02_point_in_time",
    "fl01_load_bookings", "fl02_load_payments", "fl03_booking_rejects",
    "fl04_bookings_would_insert", "um01_user_metrics", "hm01_host_metrics",
    "dq_warehouse_audit", "dq14_declared_audit", "lg03_etl_summary",
    "rp01_daily_revenue", "rp02_top10_properties", "rp03_cancellation_rate",
    "ag02_distinct_bookings_by_place", "sl04_exact_sample",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (session.builder("bench").master(f"local[{cpus}]")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "8g")
             .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="staywarehouse-"))
             .config("spark.sql.shuffle.partitions", cpus).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    start = time.perf_counter()
    warehouse = loaded(spark, folder)
    for table in warehouse.tables.values():
        table.schema  # noqa: B018 - builds the table
    build = time.perf_counter() - start
    queries, took = registered(), {}
    for name in HEADLINE:
        times = []
        for _ in range(runs):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        took[name] = round(statistics.median(times), 3)
    print(json.dumps({
        "metric": "headline_total", "value": round(build + sum(took.values()), 3), "unit": "sec",
        "queries": took, "sf": os.path.basename(folder).removeprefix("sf"),
        "build_sec": round(build, 3), "runs": runs, "cpus": int(cpus),
        "spark": pyspark.__version__, "machine": platform.machine()}))
    spark.stop()


if __name__ == "__main__":
    main()
