"""Running statistics: each batch of readings is aggregated once and kept as states.

Below the path there is one partition per batch. Adding a batch again replaces its partition, so a
run that failed half way is simply repeated. Reading merges the batches. The price of reading
grows with their number; ``compact`` writes them as one into a new path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vanescope.operators.states import merge_states, summary_of_states, window_states
from vanescope.spec import SeriesSpec

BATCH = "batch"


def add_batch(df: DataFrame, path: str, batch: str, spec: SeriesSpec, period: str = "1 day") -> None:
    """Keep the states of new readings; only ``df`` is read. Readings must not be in two batches."""
    window_states(df, spec, period).write.mode("overwrite").parquet(f"{path}/{BATCH}={batch}")


def running_states(spark: SparkSession, path: str, spec: SeriesSpec) -> DataFrame:
    """The states of all batches, merged."""
    return merge_states([spark.read.parquet(path).drop(BATCH)], spec.keys)


def running_summary(spark: SparkSession, path: str, spec: SeriesSpec, period: str = "1 day") -> DataFrame:
    """The summary of all readings of all batches."""
    return summary_of_states(running_states(spark, path, spec), spec, period)


def compact(spark: SparkSession, path: str, into: str, batch: str, spec: SeriesSpec) -> None:
    """Write all batches as one below ``into``, where further ones are added from then on."""
    running_states(spark, path, spec).write.mode("overwrite").parquet(f"{into}/{BATCH}={batch}")
