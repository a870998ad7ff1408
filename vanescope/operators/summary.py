"""Summary statistics per sensor and tumbling window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanescope.functions.columns import WINDOW_START, add_window_end, add_window_start
from vanescope.spec import SeriesSpec


def summarize(df: DataFrame, spec: SeriesSpec, period: str = "1 day") -> DataFrame:
    """min, max, mean, sample standard deviation and row count per sensor and window.

    ``reading_count`` counts rows, also those without a value.
    """
    rows = add_window_start(df.select(*spec.keys, spec.ts, spec.target), spec.ts, period)
    return add_window_end(summarize_windows(rows, spec), period)


def summarize_windows(rows: DataFrame, spec: SeriesSpec) -> DataFrame:
    """The same of rows that have their ``window_start``, without the end of the windows."""
    value, label = spec.target, spec.label
    groups = rows.groupBy(*spec.keys, WINDOW_START).agg(
        F.min(value).alias(f"min_{label}"),
        F.max(value).alias(f"max_{label}"),
        F.avg(value).alias(f"avg_{label}"),
        F.stddev_samp(value).alias(f"stddev_{label}"),
        F.count("*").alias("reading_count"),
    )
    return groups.select(
        *spec.keys,
        *[f"{s}_{label}" for s in ("min", "max", "avg", "stddev")],
        "reading_count",
        WINDOW_START,
    )
