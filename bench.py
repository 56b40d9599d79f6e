"""Bench: run the headline queries at ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) on ``local[$BENCH_CPUS]`` and print one JSON line.

Each query is timed to full materialisation with a ``noop`` write (every
row produced, nothing collected to the driver) three times, in a fixed order;
the median counts. ``calibration`` times a fixed job of Spark's own at the
start and at the end, to tell the machine's share of a difference. The
JVM is warmed first by running the flagship query on the smallest driver
tables (a different data set), so class loading and JIT compilation are not
billed to whichever query happens to run first.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "dedupe_latest",
    "readings_with_tariff",
    "readings_with_weather",
    "cost_fact",
    "daily_cost",
    "scd2_history",
    "coverage",
    "table_profile",
    "usage_rolling7",
    "usage_anomalies",
    "fault_tree",
    "star_usage",
    "tariff_what_if",
    "temp_elasticity",
]


#: Times each query runs.
RUNS = 3


def calibrate(spark) -> float:
    t0 = time.perf_counter()
    spark.range(20_000_000).selectExpr("sum(hash(id) % 1000)", "count(distinct id % 100000)").collect()
    return round(time.perf_counter() - t0, 3)


def main() -> None:
    from gridlake.plans import bench_plans
    from gridlake.plans.queries import QUERIES
    from gridlake.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus, shuffle_partitions=max(cpus, 8), app="gridlake-bench")
    warm = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    if os.path.isdir(warm):
        QUERIES["daily_cost"](spark, warm).write.format("noop").mode("overwrite").save()
    else:
        spark.range(1000).selectExpr("sum(id)").collect()

    calibration = [calibrate(spark)]
    times: dict[str, float] = {}
    extra = {
        "lineitem_daily_cost": bench_plans.lineitem_daily_cost,
        "lineitem_dedupe": bench_plans.lineitem_dedupe,
    }
    for name in HEADLINE + list(extra):
        q = QUERIES.get(name) or extra[name]
        runs = []
        for _ in range(RUNS):
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(
        json.dumps(
            {"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times, "sf": sf,
             "calibration": [*calibration, calibrate(spark)]}
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
