"""Hourly context from its JSON form to a flat table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from vanescope.operators.context import flatten_hourly
from vanescope.sources.hourly import document_schema, hours_of, read_documents, read_hours

# The parameters of the weather documents.
PARAMS = ("waveHeight", "airTemperature")


def hourly_table(
    spark: SparkSession,
    path: str,
    params: Sequence[str] = PARAMS,
    hour: T.StructType | None = None,
    documents: bool = True,
    one_per_file: bool = True,
) -> DataFrame:
    """One row per hour, from whole documents or from lines of hours. A table has no order; a
    writer sorts within files.

    Without ``hour``, the schema of one hour, Spark infers it in an extra scan.
    """
    if documents:
        hours = hours_of(
            read_documents(spark, path, document_schema(hour) if hour else None, one_per_file)
        )
    else:
        hours = read_hours(spark, path, hour)
    return flatten_hourly(hours, params)
