"""Readings from CSV directories."""

from __future__ import annotations

import csv
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt_record"
SOURCE_FILE = "source_file"
INGESTED_AT = "ingestion_timestamp"

# Time format and columns of the turbine readings.
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
READING_FIELDS = T.StructType(
    [
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("turbine_id", T.IntegerType()),
        T.StructField("wind_speed", T.DoubleType()),
        T.StructField("wind_direction", T.DoubleType()),
        T.StructField("power_output", T.DoubleType()),
    ]
)


def path_of_row() -> Column:
    """Path of the file a row is read from, as a listing of files has it: without escapes."""
    path = F.col("_metadata.file_path")
    # Most paths have no escapes, and decoding each row's path would be much of the work of a scan.
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def list_csv_files(spark: SparkSession, directory: str) -> DataFrame:
    """Paths of the CSV files of a directory, in a column ``source_file``.

    Raises FileNotFoundError when the directory is missing or has no CSV file.
    """
    return list_versions(spark, directory).select(SOURCE_FILE)


def list_versions(spark: SparkSession, directory: str) -> DataFrame:
    """The CSV files of a directory with ``modified`` and ``length``; they are not read."""
    try:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.csv")
            .load(directory)
            .select(F.col("path").alias(SOURCE_FILE), F.col("modificationTime").alias("modified"), "length")
        )
        empty = files.isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no such directory: {directory}") from error
    if empty:
        raise FileNotFoundError(f"no CSV files in {directory}")
    return files


def read_readings(
    spark: SparkSession,
    directory: str,
    schema: T.StructType = READING_FIELDS,
    timestamp_format: str = TIMESTAMP_FORMAT,
    check_header: bool = False,
    modified_after: str | None = None,
) -> DataFrame:
    """All CSV files of a directory in one scan, or those modified after a time of the session's zone.

    Malformed rows are kept: what could be parsed stays, the rest is NULL and the
    line itself goes to ``_corrupt_record``. ``source_file`` holds the path of the
    file. Columns bind by position; with ``check_header`` a file whose header
    names differ from the schema fails the scan. Store the rows before counting
    malformed ones (see ``ingest_report``).
    """
    list_csv_files(spark, directory)
    reader = spark.read if modified_after is None else spark.read.option("modifiedAfter", modified_after)
    return (
        reader.schema(T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())]))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .option("timestampFormat", timestamp_format)
        .option("timestampNTZFormat", timestamp_format)
        .option("enforceSchema", not check_header)
        .option("pathGlobFilter", "*.csv")
        .csv(directory)
        .withColumn(SOURCE_FILE, path_of_row())
    )


#: More different headers than this in one directory are taken for a mistake.
MOST_LAYOUTS = 64


def read_readings_by_name(
    spark: SparkSession,
    directory: str,
    schema: T.StructType = READING_FIELDS,
    timestamp_format: str = TIMESTAMP_FORMAT,
) -> DataFrame:
    """What ``read_readings`` gives, of files whose headers may differ: columns bind by the names there.

    Names are compared without case and outer blanks. A column that a file lacks is NULL in its rows, one that
    the schema does not know is left out; a line is malformed by the header of its own file. The header is
    the first line that is not blank. Headers are found in a scan of their own, which parses nothing,
    and all files, whatever their headers, are parsed in one.
    """
    list_csv_files(spark, directory)
    text = spark.read.option("pathGlobFilter", "*.csv").text(directory)
    # Numbers of lines ascend within a split, and are the same each time.
    lines = text.select(
        path_of_row().alias(SOURCE_FILE),
        (F.col("_metadata.file_block_start") == 0).alias("__first_split"),
        F.monotonically_increasing_id().alias("__number"),
        F.col("value").alias("__line"),
    ).filter("trim(__line) <> ''")
    headers = lines.filter("__first_split").groupBy(SOURCE_FILE).agg(
        F.min("__number").alias("__header_number"), F.min_by("__line", "__number").alias("__header")
    )
    layouts = [r[0] for r in headers.select("__header").distinct().limit(MOST_LAYOUTS + 1).collect()]
    if len(layouts) > MOST_LAYOUTS:
        raise ValueError(f"more than {MOST_LAYOUTS} different headers in {directory}")
    known = {f.name.strip().lower(): f for f in schema}
    rows = lines.join(headers, SOURCE_FILE).filter("NOT __first_split OR __number > __header_number")
    parsed, held = {}, {f.name: [] for f in schema}
    for k, header in enumerate(sorted(layouts)):
        names = [name.strip().lower() for name in next(csv.reader([header]))]
        if len(set(names)) < len(names):
            raise ValueError(f"a name repeats in the header {header!r}")
        fields = [(known[n].name, known[n].dataType.simpleString()) if n in known else (f"__other_{i}", "string") for i, n in enumerate(names)]
        parsed[f"__row_{k}"] = F.when(F.col("__header") == header, parse_line(F.col("__line"), fields, timestamp_format))
        for name, _ in fields:
            if name in held:
                held[name].append(F.col(f"__row_{k}.`{name}`"))
    rows = rows.withColumns(parsed)
    # Of each row one layout has values, the others are NULL.
    of_any = {f.name: F.coalesce(*held[f.name], F.lit(None).cast(f.dataType)).alias(f.name) for f in schema}
    corrupt = F.coalesce(*[F.col(f"{row}.{CORRUPT}") for row in parsed], F.lit(None).cast("string"))
    return rows.select(*of_any.values(), corrupt.alias(CORRUPT), SOURCE_FILE)


def parse_line(line: Column, fields: Sequence[tuple[str, str]], timestamp_format: str) -> Column:
    """A CSV line as a struct of ``fields`` (name, type) and the line itself where it is malformed."""
    options = {
        "mode": "PERMISSIVE",
        "columnNameOfCorruptRecord": CORRUPT,
        "timestampFormat": timestamp_format,
        "timestampNTZFormat": timestamp_format,
    }
    ddl = ", ".join(f"`{name}` {kind}" for name, kind in fields)
    return F.from_csv(line, f"{ddl}, `{CORRUPT}` string", options)


def stamp(df: DataFrame, at: datetime) -> DataFrame:
    """Add the time of the run, the same for every row, output and retry."""
    return df.withColumn(INGESTED_AT, F.lit(at).cast("timestamp"))
