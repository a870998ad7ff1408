"""Layers that follow their source: each run reads what is new and rewrites what that changes.

The result is always that of a full run over the files that are there, whether files were added,
changed or taken away since:

1. The manifest tells which version of each file is in Bronze. Files that are new or differ in time or
   length are read, nothing else. Bronze keeps all versions, by run and date.
2. Dates of rows that came or went are cleaned anew, from the current rows of Bronze of these dates. Sums
   and gaps per sensor and day give the means over the whole history without reading it; where the
   mean of a sensor has changed, dates on which it has gaps follow.
3. Windows that meet a rewritten date are summarised anew, and readings in them compared with
   the new statistics, so that a late row reopens its window.
4. The manifest is written last. A run that fails before is repeated as a whole: rows it left in Bronze belong
   to no version that counts, and every other table is replaced date by date.

Dates are held by the driver, of which there are no more than days in the data.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field
from datetime import date, datetime, time, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vanescope.functions.columns import WINDOW_START, all_present
from vanescope.operators.anomalies import detect_anomalies
from vanescope.operators.cleaning import impute_group_mean, steady, to_decimal, valid_readings
from vanescope.operators.summary import summarize
from vanescope.plans.layers import Layers, RunConfig
from vanescope.shared import scratch_path
from vanescope.sinks.files import READING_DATE, replace_dates, write_parquet
from vanescope.sources.readings import CORRUPT, SOURCE_FILE, list_versions, read_readings, stamp

_EPOCH, _DAY, _TICK = datetime(1970, 1, 1), timedelta(days=1), timedelta(microseconds=1)
_RUN = "ingest_run"
_MANIFEST = f"{SOURCE_FILE} string, modified timestamp, length long, {_RUN} string, is_present boolean"


@dataclass(frozen=True)
class Changes:
    """What a run has rewritten."""

    run: str | None = None
    readings: list[date] = field(default_factory=list)
    windows: list[date] = field(default_factory=list)
    anomalies: list[date] = field(default_factory=list)


def _dates(df: DataFrame) -> list[date]:
    """The days in a table: one line per day."""
    return sorted(r[0] for r in df.select(READING_DATE).distinct().collect() if r[0] is not None)


def _on(df: DataFrame, dates: Iterable[date]) -> DataFrame:
    return df.filter(F.col(READING_DATE).isin(list(dates)))


def _read(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame | None:
    """A table, or None if nothing has been written yet."""
    try:
        return (spark.read.schema(schema) if schema else spark.read).parquet(path)
    except AnalysisException as error:
        if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def _lines(spark: SparkSession, base: str) -> DataFrame:
    """All lines of the manifest, those of older versions too."""
    kept = _read(spark, f"{base}/manifest", _MANIFEST)
    return spark.createDataFrame([], _MANIFEST) if kept is None else kept


def _next_run(spark: SparkSession, base: str) -> str:
    """Runs are numbered; the rest tells apart one that failed and the one that repeats it."""
    last = _lines(spark, base).agg(F.max(_RUN)).first()[0]
    return f"{int(last.split('-')[0]) + 1 if last else 1:09d}-{uuid.uuid4().hex[:8]}"


def manifest(spark: SparkSession, base: str) -> DataFrame:
    """The versions of files that Bronze's current rows come from."""
    kept = _lines(spark, base)
    newest = kept.groupBy(SOURCE_FILE).agg(F.max_by(F.struct("modified", "length", _RUN, "is_present"), _RUN).alias("v"))
    return newest.select(SOURCE_FILE, "v.*").filter("is_present").drop("is_present")


def changed_files(spark: SparkSession, config: RunConfig, run: str) -> DataFrame:
    """New lines of the manifest, with the run the last version came from in ``replaces``."""
    now = list_versions(spark, config.source).withColumn("is_present", F.lit(True))
    last = manifest(spark, config.base).select(
        F.col(SOURCE_FILE).alias("__file"), F.col("modified").alias("__modified"), F.col("length").alias("__length"), F.col(_RUN).alias("replaces")
    )
    both = now.join(last, F.col(SOURCE_FILE) == F.col("__file"), "full")
    same = F.col("modified").eqNullSafe(F.col("__modified")) & F.col("length").eqNullSafe(F.col("__length"))
    return both.filter(~same).select(
        F.coalesce(SOURCE_FILE, "__file").alias(SOURCE_FILE),
        "modified",
        "length",
        F.lit(run).alias(_RUN),
        F.coalesce("is_present", F.lit(False)).alias("is_present"),
        "replaces",
    )


def _append_bronze(spark: SparkSession, config: RunConfig, changes: DataFrame, run: str) -> None:
    """Rows of the files that are new."""
    added = changes.filter("is_present")
    # Older files are left out when files are listed; of the others those that are known are dropped.
    since = added.select(F.date_format(F.min("modified") - F.expr("INTERVAL 2 SECONDS"), "yyyy-MM-dd'T'HH:mm:ss")).first()[0]
    if since is None:
        return
    rows = read_readings(spark, config.source, config.schema, check_header=config.check_header, modified_after=since)
    rows = rows.join(added.select(SOURCE_FILE), SOURCE_FILE, "left_semi").select(*rows.columns)
    rows = stamp(rows, config.run_time).withColumns({_RUN: F.lit(run), READING_DATE: F.to_date(config.spec.ts)})
    rows.hint("rebalance", READING_DATE).write.mode("append").partitionBy(_RUN, READING_DATE).parquet(Layers(config.base).bronze)


def _days_of_sensors(rows: DataFrame, config: RunConfig) -> DataFrame:
    """Sums, values, rows and gaps per sensor and day, from which means of any days follow."""
    spec = config.spec
    return rows.groupBy(READING_DATE, *spec.keys).agg(
        *[F.sum(F.col(m).cast("double")).alias(f"sum_{m}") for m in spec.measures],
        *[F.count(m).alias(f"values_{m}") for m in spec.measures],
        F.count("*").alias("reading_count"),
        F.count_if(~all_present(spec.measures)).alias("incomplete_count"),
    )


def _means_of_days(days: DataFrame, config: RunConfig) -> DataFrame:
    """What ``group_means`` gives for the readings behind the days, means to their steady decimals."""
    spec = config.spec
    sums = days.groupBy(*spec.keys).agg(
        *[(F.sum(f"sum_{m}") / F.nullif(F.sum(f"values_{m}"), F.lit(0))).alias(f"mean_{m}") for m in spec.measures],
        F.sum("reading_count").alias("reading_count"),
        F.sum("incomplete_count").alias("incomplete_count"),
    )
    return sums.withColumns({f"mean_{m}": steady(f"mean_{m}") for m in spec.measures})


def _dates_with_other_means(days: DataFrame, means: DataFrame, before: DataFrame | None, config: RunConfig) -> list[date]:
    """Days on which a sensor has gaps that are to be filled with another mean than before."""
    spec = config.spec
    gaps = days.filter("incomplete_count > 0")
    if before is None:
        return _dates(gaps)
    last = before.select(*[F.col(c).alias(f"__{c}") for c in (*spec.keys, *[f"mean_{m}" for m in spec.measures])])
    alike = F.lit(True)
    for c in (*spec.keys, *[f"mean_{m}" for m in spec.measures]):
        alike = alike & F.col(c).eqNullSafe(F.col(f"__{c}"))
    moved = means.join(last, alike, "left_anti").select(*spec.keys)
    return _dates(gaps.join(moved, list(spec.keys), "left_semi"))


def length_of(spark: SparkSession, period: str) -> timedelta:
    """How long windows of a period are."""
    window = spark.range(1).selectExpr(f"window(TIMESTAMP '1970-01-01 00:00:00', '{period}') AS w").select("w.*").first()
    return window["end"] - window["start"]


def window_dates(dates: Iterable[date], length: timedelta) -> list[date]:
    """Days on which the windows start that meet any of the days. Windows are aligned to the epoch."""
    found: set[date] = set()
    for day in dates:
        since = datetime.combine(day, time()) - _EPOCH
        found.update(_days(_EPOCH + since // length * length, _EPOCH + (since + _DAY - _TICK) // length * length))
    return sorted(found)


def covered_dates(starts: Iterable[date], length: timedelta) -> list[date]:
    """Days that windows which start on any of the days can reach."""
    found: set[date] = set()
    for day in starts:
        last = datetime.combine(day, time()) - _EPOCH + _DAY - _TICK
        found.update(_days(datetime.combine(day, time()), _EPOCH + (last // length + 1) * length - _TICK))
    return sorted(found)


def _days(first: datetime, last: datetime) -> list[date]:
    return [first.date() + timedelta(days=n) for n in range((last.date() - first.date()).days + 1)]


def update(spark: SparkSession, config: RunConfig) -> Changes:
    """Bring all layers below ``config.base`` up to the files in ``config.source``."""
    layers, spec, base = Layers(config.base), config.spec, config.base
    run = _next_run(spark, base)
    pending = scratch_path(spark, "changed-files")
    write_parquet(changed_files(spark, config, run), pending)
    changes = spark.read.parquet(pending)
    if changes.isEmpty():
        return Changes()

    _append_bronze(spark, config, changes, run)
    bronze = _read(spark, layers.bronze)
    if bronze is None:
        # No file has a row yet.
        write_parquet(changes.drop("replaces"), f"{base}/manifest", mode="append")
        return Changes(run)
    gone = changes.filter("replaces IS NOT NULL").select(SOURCE_FILE, F.col("replaces").alias(_RUN))
    came_or_went = bronze.filter(F.col(_RUN) == run).select(READING_DATE)
    came_or_went = came_or_went.union(bronze.join(gone, [SOURCE_FILE, _RUN], "left_semi").select(READING_DATE))
    touched = _dates(came_or_went)

    current = manifest(spark, base).select(SOURCE_FILE, _RUN).join(changes.select(SOURCE_FILE), SOURCE_FILE, "left_anti")
    current = current.unionByName(changes.filter("is_present").select(SOURCE_FILE, _RUN))

    def valid_on(dates: list[date]) -> DataFrame:
        rows = _on(bronze, dates).join(current, [SOURCE_FILE, _RUN], "left_semi")
        return valid_readings(rows.drop(CORRUPT, SOURCE_FILE, _RUN, READING_DATE), spec)

    with_day = valid_on(touched).withColumn(READING_DATE, F.to_date(spec.ts))
    days = replace_dates(_days_of_sensors(with_day, config), f"{base}/silver_days", touched)
    means_path = f"{base}/silver_means"
    means = _means_of_days(days, config)
    rewritten = sorted({*touched, *_dates_with_other_means(days, means, _read(spark, means_path), config)})

    filled = impute_group_mean(valid_on(rewritten), spec.keys, spec.measures, config.flag, spread=[spec.ts], means=means)
    silver = replace_dates(
        to_decimal(filled, spec.measures, spec.decimal), layers.silver, rewritten, date_of=spec.ts, sort_by=spec.reading_keys
    )

    length = length_of(spark, config.period)
    starts = window_dates(rewritten, length)
    reached = covered_dates(starts, length)
    summaries = summarize(_on(silver, reached).drop(READING_DATE), spec, config.period)
    summary = replace_dates(
        summaries.filter(F.to_date(WINDOW_START).isin(starts)),
        layers.summary, starts, date_of=WINDOW_START, sort_by=[*spec.keys, WINDOW_START],
    )
    baselines = _on(summary, window_dates(reached, length)).drop(READING_DATE)
    found = detect_anomalies(_on(silver, reached).drop(READING_DATE), spec, config.period, config.k, baselines)
    replace_dates(found, layers.anomalies, reached, date_of=spec.ts, sort_by=spec.reading_keys)

    # Until here a repeated run finds the same changes.
    write_parquet(means, means_path)
    write_parquet(changes.drop("replaces"), f"{base}/manifest", mode="append")
    return Changes(run, rewritten, starts, reached)
