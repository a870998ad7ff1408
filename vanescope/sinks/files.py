"""Parquet and JSON tables, and the byte-for-byte landing of raw files."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from datetime import date
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vanescope.sources.readings import path_of_row

READING_DATE = "reading_date"


def write_parquet(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    date_of: str | None = None,
    sort_by: Sequence[str] = (),
    counts: Mapping[str, str] | None = None,
    lookup_by: Mapping[str, int] | None = None,
) -> dict[str, Any]:
    """Write a Parquet table.

    ``date_of`` names a time column by whose day, in ``reading_date``, the table is
    partitioned. A rebalance gathers each day in few files and splits large days.
    ``sort_by`` orders the rows within each file, which gives tight value ranges
    to skip by, without a global sort. ``counts`` are SQL aggregates over the rows, taken while they are written
    and returned under their names. They are taken in the tasks that write, after any shuffle: Spark
    takes over one result of each, however often it ran. ``lookup_by`` names columns of which single values will be looked
    up, with the distinct values that a file may have: each row group gets a Bloom filter of them, by which
    a scan for one value passes over the groups without it, whatever the order of the rows.
    """
    df = _arranged(df, date_of, sort_by)
    seen = Observation()
    if counts:
        df = df.observe(seen, *[F.expr(c).alias(name) for name, c in counts.items()])
    writer = df.write.mode(mode)
    for column, distinct in (lookup_by or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", True)
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", distinct)
    (writer.partitionBy(READING_DATE) if date_of else writer).parquet(path)
    # A table that is known to be empty before it is written has no tasks and no counts.
    return {name: 0 for name in counts} | seen.get if counts else {}


def _arranged(df: DataFrame, date_of: str | None, sort_by: Sequence[str]) -> DataFrame:
    if date_of:
        df = df.withColumn(READING_DATE, F.to_date(date_of)).hint("rebalance", READING_DATE)
    if sort_by:
        df = df.sortWithinPartitions(*([READING_DATE] if date_of else []), *sort_by)
    return df


def replace_dates(
    df: DataFrame,
    path: str,
    dates: Iterable[date],
    date_of: str | None = None,
    sort_by: Sequence[str] = (),
) -> DataFrame:
    """Replace the partitions of ``dates`` by ``df``, which has rows of these dates only; other dates stay.

    The date is that of the time column ``date_of`` or, without one, the column ``reading_date`` of ``df``.
    ``df`` may read the table itself: what it reads is replaced when all of it has been written. A date
    without rows is removed. Gives the whole table.
    """
    spark = df.sparkSession
    if date_of:
        df = _arranged(df, date_of, sort_by)
    # Seen on the way to the files, in the tasks that write them, which count once each.
    seen = Observation()
    watched = df.observe(seen, F.collect_set(READING_DATE).alias("dates"))
    writer = watched.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(READING_DATE).parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    for day in sorted(set(dates) - set(seen.get.get("dates") or [])):
        files.delete(spark._jvm.org.apache.hadoop.fs.Path(place, f"{READING_DATE}={day}"), True)
    return spark.read.schema(df.schema).parquet(path)


def write_json_lines(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write one JSON object per line."""
    df.write.mode(mode).json(path)


def land_raw_files(
    spark: SparkSession,
    source: str,
    target: str,
    pattern: str = "*.csv",
    mode: str = "overwrite",
) -> None:
    """Keep the source files as they came, whatever their size.

    ``target/lines`` has one row per line: path, first byte of the split it was read in, number
    within the split, and the bytes of the line without its line feed. ``target/files`` has one row
    per file that has a byte: path, time and length. ``landed_files`` tells which end with a line feed.
    """
    lines = spark.read.option("lineSep", "\n").option("pathGlobFilter", pattern).text(source)
    (
        lines.select(
            path_of_row().alias("path"),
            F.col("_metadata.file_block_start").alias("split_start"),
            F.monotonically_increasing_id().alias("line_in_split"),
            F.col("value").cast("binary").alias("line"),
        )
        .write.mode(mode)
        .parquet(f"{target}/lines")
    )
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(source)
    files.select("path", "modificationTime", "length").write.mode(mode).parquet(f"{target}/files")


def land_archives(spark: SparkSession, source: str, target: str, mode: str = "overwrite") -> None:
    """Keep zip archives as they came: ``target/archives`` has one row per file, with its bytes."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(source)
    files.write.mode(mode).parquet(f"{target}/archives")


def landed_files(spark: SparkSession, target: str) -> DataFrame:
    """The files landed in ``target``, with ``ends_with_line_feed``.

    Lines joined by line feeds, in order of split and number, and one more if the file says so, are the file.
    """
    # Without the last line feed a file is one byte shorter than its lines and their ends.
    landed = (
        spark.read.parquet(f"{target}/lines")
        .groupBy("path")
        .agg(F.sum(F.octet_length("line") + 1).alias("__bytes"))
        .withColumnRenamed("path", "__path")
    )
    files = spark.read.parquet(f"{target}/files")
    return files.join(landed, F.col("path") == F.col("__path"), "left").select(
        *files.columns,
        F.coalesce(F.col("__bytes") == F.col("length"), F.lit(False)).alias("ends_with_line_feed"),
    )
