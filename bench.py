"""Benchmark: run the headline catalogue queries at one scale factor.

Each query is fully materialised through the ``noop`` sink (every row and
column computed, nothing collected), ``BENCH_RUNS`` times (default 2) in one
JVM; ``queries`` / ``value`` report the faster run of each query (steady
state, JIT warm), ``first_run`` the first one. Prints ONE JSON line:
{"metric": ..., "value": total_sec, "unit": "sec", "queries": {...}, "sf": ...}

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_QUERIES (comma list, default: HEADLINE), BENCH_RUNS (default 2)
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from finlake.plans.catalogue import queries  # noqa: E402

HEADLINE = [
    "silver_transactions",
    "dedup_latest",
    "count_duplicates",
    "normalize_usd",
    "normalize_rate_table",
    "quality_report",
    "rfm_segments",
    "rfm_scores_distributed",
    "reconcile_compare",
    "reconcile_summary",
    "merge_rows",
    "merge_counts",
    "upsert_parquet",
    "upsert_parquet_files",
    "parse_events",
    "stream_upsert",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("finlake-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * cpus)))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    qs = queries()
    # Warm-up (JIT, file listing caches) - not timed.
    for warm in ("raw_transactions", "silver_transactions"):
        qs[warm](spark, sf_dir).write.format("noop").mode("overwrite").save()
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    first: dict[str, float] = {}
    times: dict[str, float] = {}
    for name in names:
        best = None
        for i in range(runs):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            secs = round(time.perf_counter() - t0, 3)
            if i == 0:
                first[name] = secs
            best = secs if best is None else min(best, secs)
        times[name] = best
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(
        json.dumps(
            {
                "metric": "catalogue_headline_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": float(m.group(1)) if m else sf_dir,
                "cpus": cpus,
                "runs": runs,
                "first_run_total": round(sum(first.values()), 3),
                "first_run": first,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
