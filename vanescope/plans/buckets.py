"""Readings stored by sensor and window, so that Gold moves none of them.

The table is bucketed by sensor and window and sorted within buckets. A window's rows lie in one
bucket, so its statistics are aggregated where they are read, and its rows meet these statistics
in the same task: neither the aggregate nor the join shuffles readings. Writing shuffles them once.

Buckets go by sensor *and* window: a sensor with a third of all rows is spread by its windows. A single window
stays in one bucket, so the table suits series in which no window outweighs a bucket; ``heaviest_window``
tells. Other series are better left to ``detect_anomalies``, which spreads heavy windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanescope.functions.columns import WINDOW_START, add_window_end, add_window_start, all_present
from vanescope.operators.anomalies import baseline_columns, baselines, flagged
from vanescope.operators.summary import summarize_windows
from vanescope.spec import SeriesSpec


def write_buckets(
    df: DataFrame, name: str, path: str, spec: SeriesSpec, period: str = "1 day", buckets: int = 200
) -> DataFrame:
    """Store readings as table ``name`` of the session's catalog, with their files in ``path``.

    Rows without event time are in no window and are left out.
    """
    by = [*spec.keys, WINDOW_START]
    rows = add_window_start(df, spec.ts, period)
    # As many tasks as buckets, each of which writes one: a file per bucket.
    rows = rows.repartition(buckets, *by).sortWithinPartitions(*by, spec.ts)
    writer = rows.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(buckets, *by).sortBy(*by).saveAsTable(name)
    return df.sparkSession.table(name)


def bucketed_summary(spark: SparkSession, name: str, spec: SeriesSpec, period: str = "1 day") -> DataFrame:
    """What ``summarize`` gives, of a table of ``write_buckets`` with the same period."""
    return add_window_end(summarize_windows(spark.table(name), spec), period)


def bucketed_anomalies(
    spark: SparkSession, name: str, spec: SeriesSpec, period: str = "1 day", k: float = 2.0
) -> DataFrame:
    """What ``detect_anomalies`` gives, of a table of ``write_buckets`` with the same period."""
    rows = spark.table(name)
    by = [*spec.keys, WINDOW_START]
    found = baselines(summarize_windows(rows, spec), spec, k).select(*by, *baseline_columns(spec))
    # Both lie in the buckets in the order in which they are merged.
    joined = rows.filter(all_present(spec.keys)).join(found.hint("merge"), by)
    return flagged(joined, [c for c in rows.columns if c != WINDOW_START], spec, period)


def heaviest_window(spark: SparkSession, name: str, spec: SeriesSpec) -> float:
    """Rows of the largest window, as part of all rows."""
    sizes = spark.table(name).groupBy(*spec.keys, WINDOW_START).agg(F.count("*").alias("n"))
    return sizes.agg(F.max("n") / F.sum("n")).first()[0] or 0.0
