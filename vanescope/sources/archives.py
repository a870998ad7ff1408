"""Readings from zip archives of CSV files, unpacked by the executors.

An archive is read by one task, which unpacks one member at a time, a piece after the other, and hands
on its lines in batches; Spark parses them as it parses lines of files. Nothing is unpacked to disk.
Archives come as whole values, so each is limited to 2 GB, packed; its members are not.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanescope.sources.readings import READING_FIELDS, SOURCE_FILE, TIMESTAMP_FORMAT, parse_line

#: Lines that a task holds at a time.
LINES_AT_ONCE = 20_000

_LINES = f"{SOURCE_FILE} string, line_number long, line string"


def list_archives(spark: SparkSession, directory: str) -> DataFrame:
    """The zip files of a directory. Raises FileNotFoundError when it is missing or has none."""
    try:
        archives = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(directory)
        empty = archives.select("path").isEmpty()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        raise FileNotFoundError(f"no such directory: {directory}") from error
    if empty:
        raise FileNotFoundError(f"no zip files in {directory}")
    return archives


def archived_lines(spark: SparkSession, directory: str, suffix: str = ".csv") -> DataFrame:
    """Lines of the members whose names end with ``suffix``, in folders of any depth: ``source_file``
    (path of the archive, ``!/``, name of the member), ``line_number`` from 0, and ``line``.

    As with files, members whose own name starts with a dot or an underscore are passed over, and
    lines may end with a line feed, a carriage return or both.
    """
    at_once = LINES_AT_ONCE

    def unpack(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Imported here, so that executors need nothing of this package.
        import io
        import zipfile
        from itertools import count, islice

        def batch(name: str, first: int, lines: list[str]) -> pa.RecordBatch:
            numbers = pa.array(range(first, first + len(lines)), pa.int64())
            return pa.record_batch(
                [pa.array([name] * len(lines), pa.string()), numbers, pa.array(lines, pa.string())],
                names=["source_file", "line_number", "line"],
            )

        for rows in batches:
            for path, content in zip(rows.column(0), rows.column(1)):
                with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as archive:
                    for member in archive.infolist():
                        own = member.filename.rpartition("/")[2]
                        if not own.endswith(suffix) or own[0] in "._":
                            continue
                        with archive.open(member) as packed:
                            text = io.TextIOWrapper(packed, encoding="utf-8", errors="replace", newline=None)
                            for first in count(0, at_once):
                                lines = [line.removesuffix("\n") for line in islice(text, at_once)]
                                if lines:
                                    yield batch(f"{path.as_py()}!/{member.filename}", first, lines)
                                if len(lines) < at_once:
                                    break

    return list_archives(spark, directory).select("path", "content").mapInArrow(unpack, _LINES)


def read_archived_readings(
    spark: SparkSession,
    directory: str,
    schema: T.StructType = READING_FIELDS,
    timestamp_format: str = TIMESTAMP_FORMAT,
) -> DataFrame:
    """What ``read_readings`` gives for the unpacked members: malformed rows are kept with their line.

    Store the rows before using them twice: each use unpacks the archives.
    """
    lines = archived_lines(spark, directory).filter("line_number > 0 AND trim(line) <> ''")
    parsed = parse_line(F.col("line"), [(f.name, f.dataType.simpleString()) for f in schema], timestamp_format)
    return lines.select(parsed.alias("__row"), SOURCE_FILE).select("__row.*", SOURCE_FILE)


def archived_files(spark: SparkSession, directory: str) -> DataFrame:
    """The members that are read, in a column ``source_file``: those that have a line."""
    return archived_lines(spark, directory).filter("line_number = 0").select(SOURCE_FILE)
