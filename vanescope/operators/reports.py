"""Small questions asked of stored tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vanescope.functions.columns import is_orderable


def for_sensor(df: DataFrame, key: str, value: Any) -> DataFrame:
    """Rows of one sensor."""
    return df.filter(F.col(key) == F.lit(value))


def count_per_key(df: DataFrame, keys: Sequence[str], name: str = "count") -> DataFrame:
    """Rows per key, largest first."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).orderBy(F.desc(name), *keys)


def first_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first n rows in the given order."""
    return df.orderBy(*order).limit(n)


def some_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """Any n rows, to look at."""
    return df.limit(n)


def in_order(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """All rows sorted by the given columns.

    Ties are sorted by the other columns and the partition a row comes from, so
    that rows with equal keys need not end up in one partition.
    """
    ties = [c for c in df.columns if c not in order and is_orderable(df.schema[c].dataType)]
    return df.orderBy(*order, *ties, F.spark_partition_id())


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table with its number of rows."""
    counts = [
        df.agg(F.count("*").alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def ingest_report(
    rows: DataFrame,
    file: str = "source_file",
    corrupt: str = "_corrupt_record",
    files: DataFrame | None = None,
) -> DataFrame:
    """Rows and malformed rows per file, and in total on the row without file name.

    ``rows`` must be stored rows: a CSV scan parses only the columns a query asks
    for and would miss most malformed ones. ``files`` optionally lists all files
    in a column of the same name, so that files without rows are reported too.
    """
    per_file = rows.groupBy(file).agg(
        F.count("*").alias("row_count"), F.count(corrupt).alias("corrupt_count")
    )
    if files is not None:
        per_file = per_file.unionByName(
            files.select(
                file,
                F.lit(0).cast("long").alias("row_count"),
                F.lit(0).cast("long").alias("corrupt_count"),
            )
        )
    # Rolled up from the lines per file, so that only those are expanded.
    return per_file.rollup(file).agg(
        F.sum("row_count").alias("row_count"),
        F.sum("corrupt_count").alias("corrupt_count"),
        (F.grouping(file) == 1).alias("is_total"),
    )
