"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the local
cores. Every query runs once to warm up and then BENCH_RUNS times; the median counts.
All rows are computed and thrown away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from vanescope import workload  # noqa: E402

HEADLINE = (
    "summary_user_day",
    "summary_supplier_30_days",
    "anomalies_type_day",
    "anomalies_user_week",
    "anomalies_supplier_quarter",
    "keep_one_per_key",
    "find_duplicates",
    "impute_group_mean",
    "clean",
    "anomalies_of_clean",
    "anomalies_with_context",
    "ingest_report",
    "json_hours",
    "gold_anomalies",
)


def seconds(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("vanescope-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINE:
        query = workload.QUERIES[name]
        seconds(query, spark, sf_dir)
        measured = [seconds(query, spark, sf_dir) for _ in range(runs)]
        times[name] = round(statistics.median(measured), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of the median times of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
