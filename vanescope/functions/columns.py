"""Column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW_START = "window_start"
WINDOW_END = "window_end"


def within(column: str, low: float, high: float) -> Column:
    """The value where it lies in [low, high], else NULL (NaN counts as outside)."""
    value = F.col(column)
    return F.when(value.between(low, high), value)


def all_present(columns: Iterable[str]) -> Column:
    """True where none of the columns is NULL.

    Written as plain IS NOT NULL terms, which reach the Parquet scan;
    ``dropna`` compiles to an expression that does not.
    """
    condition = F.lit(True)
    for name in columns:
        condition = condition & F.col(name).isNotNull()
    return condition


def add_window_start(df: DataFrame, ts: str, period: str) -> DataFrame:
    """Add the start of the tumbling window of each row.

    Windows are aligned to the UTC epoch. Rows without event time belong to no
    window and are left out.
    """
    return df.selectExpr("*", f"window(`{ts}`, '{period}') AS __window").selectExpr(
        *[f"`{c}`" for c in df.columns], f"__window.start AS {WINDOW_START}"
    )


def add_window_end(df: DataFrame, period: str) -> DataFrame:
    """Add the end of the window that starts at ``window_start``.

    Taken from the start, so that groups and shuffles carry one time stamp, not two.
    """
    return df.selectExpr("*", f"window({WINDOW_START}, '{period}').end AS {WINDOW_END}")


def hour_of(df: DataFrame, ts: str) -> Column:
    """Event time cut to the hour, in the type of the event time column."""
    return F.date_trunc("hour", F.col(ts)).cast(df.schema[ts].dataType)


def snake_case(name: str) -> str:
    return name.strip().lower().replace(" ", "_").replace("-", "_")


def with_snake_case_names(df: DataFrame) -> DataFrame:
    """Rename all columns to lower snake case in one projection."""
    names = [snake_case(name) for name in df.columns]
    _reject_repeats(names)
    return df.toDF(*names)


def source_columns(df: DataFrame, param: str) -> list[Column]:
    """One column per field of the struct ``param``, named ``<param>_<field>``.

    A colon, as in ``model:variant``, becomes an underscore.
    """
    dtype = df.schema[param].dataType
    if not isinstance(dtype, T.StructType):
        raise TypeError(f"{param} is {dtype.simpleString()}, not a struct")
    names = [f"{param}_{field.replace(':', '_')}" for field in dtype.fieldNames()]
    _reject_repeats(names)
    return [
        F.col(f"`{param}`.`{field}`").alias(name)
        for field, name in zip(dtype.fieldNames(), names)
    ]


def preferred_source(df: DataFrame, param: str, preferred: str = "sg") -> Column:
    """The preferred source of ``param``, else the first other one, by name, with a value."""
    fields = df.schema[param].dataType.fieldNames()
    order = [f for f in fields if f == preferred] + sorted(f for f in fields if f != preferred)
    return F.coalesce(*[F.col(f"`{param}`.`{f}`") for f in order]).alias(param)


def is_orderable(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return all(is_orderable(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.ArrayType):
        return is_orderable(dtype.elementType)
    return not isinstance(dtype, (T.MapType, T.VariantType))


def _reject_repeats(names: list[str]) -> None:
    repeated = sorted({n for n in names if names.count(n) > 1})
    if repeated:
        raise ValueError(f"column names collide after renaming: {repeated}")
