"""Serving tables in a relational database, through Spark's JDBC source."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


# Settings used where the environment does not say otherwise.
_DEFAULTS = {"POSTGRES_HOST": "localhost", "POSTGRES_PORT": "5432", "POSTGRES_USER": "postgres"}


def postgres_options(env: Mapping[str, str] | None = None) -> dict[str, str]:
    """Connection options from the POSTGRES_* environment variables."""
    env = {**_DEFAULTS, **(os.environ if env is None else env)}
    return {
        "url": "jdbc:postgresql://{POSTGRES_HOST}:{POSTGRES_PORT}/{POSTGRES_DB}".format(**env),
        "user": env["POSTGRES_USER"],
        "password": env.get("POSTGRES_PASSWORD", ""),
        "driver": "org.postgresql.Driver",
    }


def read_table(
    spark: SparkSession,
    table: str,
    connection: Mapping[str, str],
    split_on: tuple[str, str, str, int] | None = None,
) -> DataFrame:
    """A serving table; filters on it are evaluated by the database.

    ``split_on`` is (column, lower bound, upper bound, partitions) and reads the
    table over several connections.
    """
    reader = spark.read.format("jdbc").options(**connection).option("dbtable", table)
    if split_on:
        column, lower, upper, partitions = split_on
        reader = reader.options(
            partitionColumn=column,
            lowerBound=lower,
            upperBound=upper,
            numPartitions=partitions,
        )
    return reader.load()


def read_query(spark: SparkSession, sql: str, connection: Mapping[str, str]) -> DataFrame:
    """Result of a query that the database runs."""
    return spark.read.format("jdbc").options(**connection).option("query", sql).load()
