"""Hourly context: flatten per-source values and line them up with readings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanescope.functions.columns import hour_of, preferred_source, source_columns
from vanescope.operators.cleaning import keep_one_per_key
from vanescope.operators.grouped import attach_group_values


def flatten_hourly(df: DataFrame, params: Sequence[str], time: str = "time") -> DataFrame:
    """One row per hour with one column per parameter and source."""
    return df.select(
        F.col(time).cast("timestamp").alias(time),
        *[column for p in params for column in source_columns(df, p)],
    )


def collapse_sources(
    df: DataFrame, params: Sequence[str], preferred: str = "sg", time: str = "time"
) -> DataFrame:
    """One row per hour with one value per parameter: the preferred source, else another."""
    return df.select(
        F.col(time).cast("timestamp").alias(time),
        *[preferred_source(df, p, preferred) for p in params],
    )


def attach_hourly(
    rows: DataFrame, context: DataFrame, ts: str, time: str = "time"
) -> DataFrame:
    """Add to each row the context of its hour; rows of hours without context get NULLs.

    Context times are cut to the hour. Of several rows in one hour the earliest counts, and of
    several with one time the smallest; to combine them otherwise, aggregate before.

    ``rows`` is read twice, once to count the rows per hour, so pass a stored table.
    """
    values = [c for c in context.columns if c != time]
    rows = rows.withColumn("__hour", hour_of(rows, ts))
    of = hour_of(context.withColumn(time, F.col(time).cast(rows.schema[ts].dataType)), time)
    context = context.withColumn("__hour", of.cast(rows.schema["__hour"].dataType))
    counts = rows.groupBy("__hour").agg(F.count("*").alias("__hour_rows"))
    hours = keep_one_per_key(context, ["__hour"], [time]).drop(time).join(counts, "__hour")
    return attach_group_values(
        rows, hours, ["__hour"], values, size="__hour_rows", spread=[ts]
    ).drop("__hour")
