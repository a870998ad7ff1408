"""Statistics per sensor and window as states that can be merged.

A state is one row per sensor and window: rows, values, mean, sum of squared deviations from that
mean (m2), smallest and largest value, and for decimals the exact total. States of different rows
of one window, or of windows that make up a larger one, merge into the state of all of them:

    n = sum of n_i      mean = sum of n_i * mean_i / n      m2 = sum of m2_i + sum of n_i * (mean_i - mean)^2

This is Chan's formula for any number of parts. Squares of values are never summed, so large values
with a small spread lose nothing. So new readings are aggregated alone and merged with what is known;
old readings are not read again.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vanescope.functions.columns import WINDOW_START, add_window_end, add_window_start
from vanescope.spec import SeriesSpec

ROWS, VALUES, MEAN, M2, LOW, HIGH, TOTAL = (
    "state_rows", "state_values", "state_mean", "state_m2", "state_min", "state_max", "state_total",
)


def window_states(df: DataFrame, spec: SeriesSpec, period: str = "1 day") -> DataFrame:
    """The state of every sensor and window in ``df``; rows without event time belong to none."""
    value = F.col(spec.target)
    number = value.cast("double")
    rows = add_window_start(df.select(*spec.keys, spec.ts, spec.target), spec.ts, period)
    total = [F.sum(value).alias(TOTAL)] if _is_decimal(df, spec.target) else []
    return rows.groupBy(*spec.keys, WINDOW_START).agg(
        F.count("*").alias(ROWS),
        F.count(value).alias(VALUES),
        F.avg(number).alias(MEAN),
        (F.var_pop(number) * F.count(value)).alias(M2),
        F.min(value).alias(LOW),
        F.max(value).alias(HIGH),
        *total,
    )


def merge_states(states: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """One state per sensor and window from several tables of states. NULL is a key like any other."""
    return _merged(reduce(DataFrame.unionByName, states), keys)


def roll_up_states(states: DataFrame, keys: Sequence[str], period: str) -> DataFrame:
    """States of larger windows. Each window of ``states`` must lie in one of them, as days lie in weeks."""
    larger = states.selectExpr("*", f"window({WINDOW_START}, '{period}').start AS __larger")
    return _merged(larger.drop(WINDOW_START).withColumnRenamed("__larger", WINDOW_START), keys)


def _merged(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    # The window function and the aggregate group by the same columns: one shuffle for both.
    group = Window.partitionBy(*keys, WINDOW_START)
    n, mean = F.col(VALUES), F.col(MEAN)
    of_all = F.sum(n * mean).over(group) / F.sum(F.when(n > 0, n)).over(group)
    apart = states.withColumn("__mean", of_all)
    # The mean of all, corrected by what the first rounding left.
    rest = F.sum(n * (mean - F.col("__mean"))).over(group) / F.sum(F.when(n > 0, n)).over(group)
    alone = F.count("*").over(group) == 1
    apart = apart.withColumn("__mean", F.when(alone, mean).otherwise(F.col("__mean") + F.nanvl(rest, F.lit(0.0))))
    total = [F.sum(TOTAL).cast(states.schema[TOTAL].dataType).alias(TOTAL)] if TOTAL in states.columns else []
    return apart.groupBy(*keys, WINDOW_START).agg(
        F.sum(ROWS).alias(ROWS),
        F.sum(VALUES).alias(VALUES),
        F.max("__mean").alias(MEAN),
        F.sum(F.col(M2) + n * (mean - F.col("__mean")) * (mean - F.col("__mean"))).alias(M2),
        F.min(LOW).alias(LOW),
        F.max(HIGH).alias(HIGH),
        *total,
    )


def summary_of_states(states: DataFrame, spec: SeriesSpec, period: str = "1 day") -> DataFrame:
    """The summary that ``summarize`` gives for the readings behind the states."""
    label = spec.label
    if TOTAL in states.columns:
        # As the mean of decimals is defined: the exact total over the number, four more decimals.
        low = states.schema[LOW].dataType
        mean = (F.col(TOTAL) / F.col(VALUES).cast("decimal(20,0)")).cast(
            T.DecimalType(min(38, low.precision + 4), min(38, low.scale + 4))
        )
    else:
        mean = F.col(MEAN)
    found = states.select(
        *spec.keys,
        F.col(LOW).alias(f"min_{label}"),
        F.col(HIGH).alias(f"max_{label}"),
        F.when(F.col(VALUES) > 0, mean).alias(f"avg_{label}"),
        F.when(F.col(VALUES) > 1, F.sqrt(F.col(M2) / (F.col(VALUES) - 1))).alias(f"stddev_{label}"),
        F.col(ROWS).alias("reading_count"),
        WINDOW_START,
    )
    return add_window_end(found, period)


def _is_decimal(df: DataFrame, column: str) -> bool:
    return isinstance(df.schema[column].dataType, T.DecimalType)
