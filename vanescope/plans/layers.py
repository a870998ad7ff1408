"""Bronze, Silver and Gold: each stage reads stored tables and stores its result."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanescope.operators.anomalies import detect_anomalies
from vanescope.operators.cleaning import clean
from vanescope.operators.reports import ingest_report, row_counts
from vanescope.operators.summary import summarize
from vanescope.sinks.database import write_table
from vanescope.sinks.files import land_archives, land_raw_files, write_parquet
from vanescope.sources.archives import archived_files, read_archived_readings
from vanescope.sources.readings import (
    CORRUPT,
    SOURCE_FILE,
    READING_FIELDS,
    list_csv_files,
    read_readings,
    read_readings_by_name,
    stamp,
)
from vanescope.spec import TURBINE, SeriesSpec

# Names of the serving tables.
SERVING_TABLES = {
    "silver": "Processed_data",
    "summary": "gold_summary_statistics",
    "anomalies": "gold_anomalies",
}


#: Per table, the counts taken while it was written.
Counts = dict[str, dict[str, int]]


@dataclass(frozen=True)
class Layers:
    """Where the tables of one run live, below one base path."""

    base: str

    @property
    def raw_files(self) -> str:
        return f"{self.base}/bronze/raw"

    @property
    def bronze(self) -> str:
        return f"{self.base}/bronze/readings"

    @property
    def report(self) -> str:
        return f"{self.base}/bronze/report"

    @property
    def counts(self) -> str:
        return f"{self.base}/run_counts"

    @property
    def silver(self) -> str:
        return f"{self.base}/silver"

    @property
    def summary(self) -> str:
        return f"{self.base}/gold/summary_statistics"

    @property
    def anomalies(self) -> str:
        return f"{self.base}/gold/anomalies"


@dataclass(frozen=True)
class RunConfig:
    """One run from a CSV directory to the Gold tables.

    archived  the directory holds zip archives of CSV files
    by_name   columns bind by the names in each file's header, not by position
    by_date   partition Silver and Gold by date. It costs a shuffle per table and a file per day, and
              pays where a day fills files of its own, from about 100 MB on
    """

    source: str
    base: str
    schema: T.StructType = field(default_factory=lambda: READING_FIELDS)
    spec: SeriesSpec = TURBINE
    period: str = "1 day"
    k: float = 2.0
    flag: str | None = None
    by_date: bool = False
    mode: str = "overwrite"
    check_header: bool = False
    archived: bool = False
    by_name: bool = False
    keep_raw_files: bool = True
    database: Mapping[str, str] | None = None
    connections: int = 8
    run_time: datetime = field(default_factory=lambda: datetime.now(timezone.utc))


# Counted while a layer is written.
_ROWS = {"row_count": "count(*)"}
_ROWS_OF_BRONZE = {**_ROWS, "corrupt_count": f"count({CORRUPT})"}


def bronze(spark: SparkSession, config: RunConfig, counts: Counts | None = None) -> DataFrame:
    """Land the raw files and store all parsed rows with file, time and malformed lines.

    Like the other layers, it puts the counts taken on the way into ``counts``, if given.
    """
    layers = Layers(config.base)
    if config.archived:
        rows = read_archived_readings(spark, config.source, config.schema)
    elif config.by_name:
        rows = read_readings_by_name(spark, config.source, config.schema)
    else:
        rows = read_readings(spark, config.source, config.schema, check_header=config.check_header)
    rows = stamp(rows, config.run_time)
    jobs = [lambda: write_parquet(rows, layers.bronze, config.mode, counts=_ROWS_OF_BRONZE)]
    if config.keep_raw_files:
        land = land_archives if config.archived else land_raw_files
        jobs.append(lambda: land(spark, config.source, layers.raw_files, mode=config.mode))
    _note(counts, "bronze", _side_by_side(*jobs)[0])
    return spark.read.schema(rows.schema).parquet(layers.bronze)


def _side_by_side(*jobs: Callable[[], Any]) -> list[Any]:
    """Results of jobs that do not depend on each other; the executors that one leaves idle work on the next."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [running.result() for running in [pool.submit(job) for job in jobs]]


def _note(counts: Counts | None, table: str, found: dict[str, int]) -> None:
    if counts is not None:
        counts[table] = found


def bronze_report(spark: SparkSession, config: RunConfig) -> DataFrame:
    """Rows and malformed rows per source file and in total."""
    return ingest_report(
        spark.read.parquet(Layers(config.base).bronze),
        files=(archived_files if config.archived else list_csv_files)(spark, config.source),
    )


def silver(spark: SparkSession, config: RunConfig, counts: Counts | None = None) -> DataFrame:
    """Store the cleaned readings."""
    layers, spec = Layers(config.base), config.spec
    rows = spark.read.parquet(layers.bronze).drop(CORRUPT, SOURCE_FILE)
    found = write_parquet(
        clean(rows, spec, config.flag),
        layers.silver,
        config.mode,
        date_of=spec.ts if config.by_date else None,
        sort_by=spec.reading_keys,
        counts=_ROWS,
    )
    _note(counts, "silver", found)
    return spark.read.parquet(layers.silver)


def gold(
    spark: SparkSession, config: RunConfig, counts: Counts | None = None
) -> tuple[DataFrame, DataFrame]:
    """Store summary statistics and anomalies; the anomalies use the stored summary."""
    layers, spec = Layers(config.base), config.spec
    readings = spark.read.parquet(layers.silver).drop("reading_date")
    found = write_parquet(
        summarize(readings, spec, config.period),
        layers.summary,
        config.mode,
        date_of="window_start" if config.by_date else None,
        sort_by=[*spec.keys, "window_start"],
        counts=_ROWS,
    )
    _note(counts, "summary", found)
    summary = spark.read.parquet(layers.summary).drop("reading_date")
    found = write_parquet(
        detect_anomalies(readings, spec, config.period, config.k, summary),
        layers.anomalies,
        config.mode,
        date_of=spec.ts if config.by_date else None,
        sort_by=spec.reading_keys,
        counts=_ROWS,
    )
    _note(counts, "anomalies", found)
    return summary, spark.read.parquet(layers.anomalies).drop("reading_date")


def stored_tables(spark: SparkSession, config: RunConfig) -> dict[str, DataFrame]:
    layers = Layers(config.base)
    return {
        name: spark.read.parquet(getattr(layers, name))
        for name in ("bronze", "silver", "summary", "anomalies")
    }


def run_counts(spark: SparkSession, config: RunConfig) -> DataFrame:
    """Rows, and malformed rows of Bronze, of each table as the last run wrote them."""
    return spark.read.parquet(Layers(config.base).counts)


def layer_counts(spark: SparkSession, config: RunConfig) -> DataFrame:
    """Rows per stored layer."""
    return row_counts(stored_tables(spark, config))


def register_serving_views(spark: SparkSession, config: RunConfig) -> None:
    """Make the serving tables available to Spark SQL under their own names."""
    tables = stored_tables(spark, config)
    for layer, name in SERVING_TABLES.items():
        tables[layer].createOrReplaceTempView(name)


def publish(spark: SparkSession, config: RunConfig) -> None:
    """Copy the stored Silver and Gold tables to the database."""
    if config.database is None:
        raise ValueError("no database configured")
    tables = stored_tables(spark, config)
    for layer, name in SERVING_TABLES.items():
        # Quoted, as the names mix upper and lower case.
        write_table(
            tables[layer].drop("reading_date"), f'"{name}"', config.database, config.connections
        )


def run(spark: SparkSession, config: RunConfig) -> tuple[DataFrame, DataFrame]:
    """CSV directory to Bronze, Silver and Gold, and to the database if configured.

    The rows and malformed rows of each file are stored beside Bronze, those of each layer in ``run_counts``.
    """
    counts: Counts = {}
    bronze(spark, config, counts)

    def later_layers() -> tuple[DataFrame, DataFrame]:
        silver(spark, config, counts)
        return gold(spark, config, counts)

    (summary, anomalies), _ = _side_by_side(
        later_layers,
        lambda: write_parquet(bronze_report(spark, config), Layers(config.base).report, config.mode),
    )
    lines = [
        F.struct(
            F.lit(table).alias("table_name"),
            F.lit(found["row_count"]).cast("long").alias("row_count"),
            F.lit(found.get("corrupt_count")).cast("long").alias("corrupt_count"),
        )
        for table, found in counts.items()
    ]
    noted = spark.range(0, 1, 1, 1).select(F.inline(F.array(*lines)))
    write_parquet(noted, Layers(config.base).counts, config.mode)
    if config.database is not None:
        publish(spark, config)
    return summary, anomalies
