"""Time the headline queries and print one JSON line.

BENCH_SF_DIR picks the data folder, BENCH_CPUS the cores, BENCH_QUERIES (comma separated)
a subset, BENCH_RUNS how often each query runs (the best time counts).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))
HEADLINE = [
    "scan_csv", "load_csv", "full_clean", "run_full_report", "null_report", "iqr_bounds", "outlier_report", "describe",
    "column_profile", "correlation", "duplicate_count", "histogram", "box_stats_by", "ecdf", "stream_clean",
]


def written_csv(spark, sf_dir: str) -> str:
    """The rows that ``load_csv`` reads, written before its time is taken."""
    from registry.common import dirty
    from winnow.session import scratch_path
    from winnow.sources import sinks

    path = scratch_path(spark, "bench") + ".csv"
    sinks.write_csv(dirty(spark, sf_dir), path)
    return path


def main() -> None:
    from registry import all_queries
    from winnow.sources.readers import read_csv

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("winnow-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    csv = written_csv(spark, SF_DIR)
    queries["load_csv"] = lambda spark, sf_dir: read_csv(spark, csv)     # reading alone; scan_csv writes the file as well
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    spark.read.parquet(f"{SF_DIR}/events.parquet").groupBy("event_type").count().collect()    # start the workers

    times = {}
    for name in names:
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    scale = re.search(r"sf([0-9.]+)", SF_DIR)
    print(json.dumps({
        "metric": "headline queries, total wall time", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
