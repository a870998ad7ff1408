"""Cleaning: key checks, de-duplication, range checks, imputation, fixed precision."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from vanescope.functions.columns import all_present, is_orderable, within
from vanescope.operators.grouped import attach_group_values
from vanescope.spec import SeriesSpec

#: Decimals of a mean that fills a gap.
MEAN_DECIMALS = 10


def drop_missing_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Drop rows in which any key is NULL; nothing can recover them."""
    return df.filter(all_present(keys))


def keep_one_per_key(
    df: DataFrame, keys: Sequence[str], tie_break: Sequence[str] = ()
) -> DataFrame:
    """Keep the smallest row of each key, by ``tie_break`` and then by all other columns.

    A missing value counts as larger than any other, so a reading is preferred to a gap.

    A minimum over whole rows: it is the same row on every run, and each map task
    passes on one row per key at most, however many copies it has seen.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [*tie_break, *[c for c in rest if c not in tie_break]]
    unordered = [c for c in order if not is_orderable(df.schema[c].dataType)]
    if unordered:
        raise TypeError(f"cannot choose between duplicates by {unordered}: no order")
    if not order:
        return df.distinct()
    ranked = [x for c in order for x in (F.col(c).isNull().alias(f"__no_{c}"), F.col(c))]
    kept = df.groupBy(*keys).agg(F.min(F.struct(*ranked)).alias("__kept"))
    return kept.select(
        *[F.col(c) if c in keys else F.col(f"__kept.{c}").alias(c) for c in df.columns]
    )


def find_duplicates(
    df: DataFrame, keys: Sequence[str], spread: Sequence[str] | None = None
) -> DataFrame:
    """All rows of keys that occur more than once. NULL is a key value like any other."""
    repeated = df.groupBy(*keys).agg(F.count("*").alias("__copies")).filter("__copies > 1")
    others = [c for c in df.columns if c not in keys] if spread is None else spread
    marked = attach_group_values(
        df,
        repeated,
        keys,
        ["__copies"],
        size="__copies",
        spread=[c for c in others if is_orderable(df.schema[c].dataType)],
        null_safe=True,
    )
    return marked.filter(F.col("__copies").isNotNull()).drop("__copies")


def null_out(df: DataFrame, bounds: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Replace values outside their inclusive range by NULL."""
    return df.withColumns({c: within(c, low, high) for c, (low, high) in bounds.items()})


def group_means(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Mean of each measure, number of rows, and of rows that lack a measure, per group."""
    return df.groupBy(*keys).agg(
        *[F.avg(m).alias(f"mean_{m}") for m in measures],
        F.count("*").alias("reading_count"),
        F.count_if(~all_present(measures)).alias("incomplete_count"),
    )


def impute_group_mean(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    flag: str | None = None,
    spread: Sequence[str] = (),
    means: DataFrame | None = None,
) -> DataFrame:
    """Fill missing measures with the mean of their group over its whole history.

    ``means``, when given, is what ``group_means`` gives for that history, of which ``df`` may then
    be a part.

    Means are rounded to ten decimals before they fill a gap: the order in which doubles are
    added shows in their last digits only, so every run fills the same value. A group without any value stays NULL. ``flag`` names an optional boolean
    column that is true where at least one measure was filled.
    """
    # Groups without gaps need no means.
    if means is None:
        means = group_means(df, keys, measures)
    means = means.filter("incomplete_count > 0").select(
        *keys,
        *[steady(f"mean_{m}").alias(f"__mean_{m}") for m in measures],
        F.col("reading_count").alias("__group_rows"),
    )
    joined = attach_group_values(
        df,
        means,
        keys,
        [f"__mean_{m}" for m in measures],
        size="__group_rows",
        spread=spread,
    )
    filled = {m: F.coalesce(m, f"__mean_{m}").alias(m) for m in measures}
    flags = [_was_filled(measures).alias(flag)] if flag else []
    return joined.select(
        *keys,
        *[filled.get(c, F.col(c)) for c in df.columns if c not in keys],
        *flags,
    )


def steady(mean: str) -> Column:
    """A mean to the decimals that do not depend on the order in which doubles were added."""
    # Means too large for that many decimals are left as they are.
    rounded = F.col(mean).try_cast(DecimalType(18 + MEAN_DECIMALS, MEAN_DECIMALS))
    return F.coalesce(rounded.cast("double"), F.col(mean))


def _was_filled(measures: Sequence[str]) -> Column:
    filled = F.lit(False)
    for m in measures:
        filled = filled | (F.col(m).isNull() & F.col(f"__mean_{m}").isNotNull())
    return filled


def to_decimal(df: DataFrame, measures: Sequence[str], decimal: tuple[int, int]) -> DataFrame:
    """Cast measures to a fixed-precision decimal, rounding half up, once."""
    return df.withColumns({m: F.col(m).cast(DecimalType(*decimal)) for m in measures})


def valid_readings(df: DataFrame, spec: SeriesSpec) -> DataFrame:
    """One row per key, values out of range as gaps: what is left to do is to fill them."""
    rows = drop_missing_keys(df, spec.reading_keys)
    rows = keep_one_per_key(rows, spec.reading_keys, spec.tie_break)
    return null_out(rows, spec.bounds)


def clean(df: DataFrame, spec: SeriesSpec, flag: str | None = None) -> DataFrame:
    """Whole cleaning chain: keys, duplicates, ranges, imputation, decimals.

    The means and the rows they fill both come from the de-duplicated rows, and
    both read the one shuffle that removed the duplicates.
    """
    rows = valid_readings(df, spec)
    rows = impute_group_mean(rows, spec.keys, spec.measures, flag, spread=[spec.ts])
    return to_decimal(rows, spec.measures, spec.decimal)
