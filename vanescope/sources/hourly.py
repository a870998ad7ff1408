"""Hourly context: documents ``{hours: [...], meta: {...}}`` and their hours as NDJSON."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def hour_schema(sources: Mapping[str, Sequence[str]], time: str = "time") -> T.StructType:
    """Schema of one hour, given the sources of each parameter."""
    return T.StructType(
        [T.StructField(time, T.StringType())]
        + [
            T.StructField(p, T.StructType([T.StructField(s, T.DoubleType()) for s in names]))
            for p, names in sources.items()
        ]
    )


META_SCHEMA = T.StructType(
    [
        T.StructField("cost", T.LongType()),
        T.StructField("dailyQuota", T.LongType()),
        T.StructField("end", T.StringType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lng", T.DoubleType()),
        T.StructField("params", T.ArrayType(T.StringType())),
        T.StructField("requestCount", T.LongType()),
        T.StructField("start", T.StringType()),
    ]
)


def document_schema(hour: T.StructType) -> T.StructType:
    return T.StructType(
        [T.StructField("hours", T.ArrayType(hour)), T.StructField("meta", META_SCHEMA)]
    )


def read_documents(
    spark: SparkSession,
    path: str,
    schema: T.StructType | None = None,
    one_per_file: bool = True,
) -> DataFrame:
    """One row per JSON document, with the documents one per file or one per line.

    Without a schema Spark infers one in an extra scan.
    """
    reader = spark.read.option("multiLine", one_per_file)
    return (reader.schema(schema) if schema else reader).json(path)


def hours_of(documents: DataFrame) -> DataFrame:
    """One row per element of the ``hours`` array."""
    return documents.select(F.inline("hours"))


def metadata_of(documents: DataFrame) -> DataFrame:
    """The request metadata, one row per document."""
    return documents.select("meta.*")


def read_hours(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Hours from newline-delimited JSON, the form that splits within a file."""
    return (spark.read.schema(schema) if schema else spark.read).json(path)


def parse_json(
    lines: DataFrame, column: str, schema: T.StructType, keep: Sequence[str] = ()
) -> DataFrame:
    """The fields of a column of JSON strings, after the columns to keep.

    Strings that are no JSON give NULLs.
    """
    return lines.select(*keep, F.from_json(column, schema).alias("__parsed")).select(
        *keep, "__parsed.*"
    )


def long_hours(lines: DataFrame, column: str, documents: bool = False, time: str = "time") -> DataFrame:
    """``time``, ``parameter``, ``source`` and ``value``: one row per value, whatever parameters and sources there are.

    ``column`` holds JSON: hours, or with ``documents`` documents whose ``hours`` is an array of them. Neither
    a schema nor a scan to find one is needed, and hours may differ in what they have. Fields that are no
    objects, values that are no numbers and strings that are no JSON give no rows.
    """
    spark = lines.sparkSession
    hours = lines.select(F.try_parse_json(column).alias("__hour"))
    if documents:
        hours = hours.select(F.try_variant_get("__hour", "$.hours", "variant").alias("__all"))
        hours = hours.lateralJoin(spark.tvf.variant_explode(F.col("__all").outer())).select(F.col("value").alias("__hour"))
    hours = hours.select(F.try_variant_get("__hour", f"$.{time}", "timestamp").alias(time), "__hour")
    parameters = hours.lateralJoin(spark.tvf.variant_explode(F.col("__hour").outer())).select(
        time, F.col("key").alias("parameter"), F.col("value").alias("__sources")
    )
    values = parameters.filter(F.expr("schema_of_variant(__sources) LIKE 'OBJECT<%'")).lateralJoin(
        spark.tvf.variant_explode(F.col("__sources").outer())
    )
    number = F.try_variant_get("value", "$", "double")
    is_number = F.expr("schema_of_variant(value) RLIKE '^(BIGINT|DOUBLE|FLOAT|DECIMAL)'")
    return values.filter(is_number).select(time, "parameter", F.col("key").alias("source"), number.alias("value"))


def infer_schema(lines: DataFrame, column: str) -> T.StructType:
    """Schema of a column of JSON strings, merged over all rows by Spark.

    As with JSON files, fractions are doubles. Only the schema reaches the driver.
    """
    merged = lines.agg(
        F.schema_of_variant_agg(F.try_parse_json(column)).alias("schema")
    ).first()["schema"]
    return _with_doubles(T.DataType.fromDDL(merged.replace("OBJECT<", "STRUCT<")))


def _with_doubles(dtype: T.DataType) -> T.DataType:
    if isinstance(dtype, T.StructType):
        return T.StructType([T.StructField(f.name, _with_doubles(f.dataType)) for f in dtype])
    if isinstance(dtype, T.ArrayType):
        return T.ArrayType(_with_doubles(dtype.elementType))
    if isinstance(dtype, (T.DecimalType, T.FloatType)):
        return T.DoubleType()
    return T.StringType() if isinstance(dtype, T.NullType) else dtype
