"""Benchmark: the whole batch run plus the headline queries, one JSON line on stdout.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_RUNS (warm runs per query, default 3), BENCH_ALL=1 to time every registered query.
Each query runs to completion through the ``noop`` sink (nothing is collected
to the driver); the reported time per query is the median of the warm runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "a7_revenue_fact", "j4_flights_view", "j5_bookings_view", "j6_maintenance_view", "j3_role_playing_dimension",
    "a8_kpis", "a10_booking_status_counts", "a11_flight_status_share", "a13_revenue_by_airport",
    "a14_price_by_departure", "a15_price_by_weekday", "a16_price_describe", "a18_delay_summary",
    "a19_price_histogram", "a3_outlier_report", "a4_median_imputation", "a5_mode_imputation",
    "a2_final_report", "d1_dedupe_ignoring_id", "d6_union_projections", "n4_standardize_formats",
    "n11_delay_whole_minutes", "m5_surrogate_keys", "j2_composite_key_lookup", "f1_bad_rows",
    "v9c_declared_constraints",
]


def main() -> None:
    from runway.plans import job, registry, tpch
    from runway.session import build_session, shared_path

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(f"local[{cpus}]", app="runway-bench", shuffle_partitions=int(cpus) * 2,
                          conf={"spark.ui.showConsoleProgress": "false", "spark.driver.memory": "16g"})

    def timed(fn) -> float:
        t0 = time.perf_counter()
        fn()
        return time.perf_counter() - t0

    # The whole run: clean five sources, load the warehouse, evaluate the checks.
    job_times, last = [], {}

    def run_job():
        last["result"] = job.run(spark, tpch.sources(spark, sf_dir), shared_path(spark, "bench-job"))
        last["result"].checks.collect()

    for _ in range(2):  # the first run warms the JVM
        job_times.append(timed(run_job))
    queries = {"etl_job": job_times[-1]}
    # The view and report queries read the warehouse of the timed run.
    registry._RUNS[(spark.sparkContext.applicationId, sf_dir)] = last["result"]
    names = list(registry.QUERIES) if os.environ.get("BENCH_ALL") else HEADLINE
    for name in names:
        fn = registry.QUERIES[name]
        samples = []
        for _ in range(runs + 1):
            samples.append(timed(lambda: fn(spark, sf_dir).write.format("noop").mode("overwrite").save()))
        queries[name] = round(statistics.median(samples[1:]), 3)
    total = round(sum(queries.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_seconds_etl_and_headline_queries", "value": total, "unit": "sec",
                      "queries": {k: round(v, 3) for k, v in queries.items()}, "sf": sf,
                      "cpus": int(cpus), "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
