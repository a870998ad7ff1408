"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from vanescope.shared import scratch_path


def stored(df: DataFrame, name: str, with_path: bool = False) -> DataFrame | tuple[DataFrame, str]:
    """Write a table and read it back: what follows neither repeats the work nor, when an
    executor is lost, depends on its files. ``with_path`` also gives the place, for ``dropped``."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    return (table, path) if with_path else table


def dropped(spark: SparkSession, path: str) -> None:
    """Delete a table that ``stored`` has written and that no DataFrame needs any more."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
