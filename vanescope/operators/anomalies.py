"""Readings far from the mean of their own sensor and window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from vanescope.functions.columns import (
    WINDOW_START,
    add_window_end,
    add_window_start,
    all_present,
)
from vanescope.operators.grouped import attach_group_values
from vanescope.operators.summary import summarize
from vanescope.spec import SeriesSpec


def detect_anomalies(
    df: DataFrame,
    spec: SeriesSpec,
    period: str = "1 day",
    k: float = 2.0,
    summary: DataFrame | None = None,
) -> DataFrame:
    """Readings below mean - k·stddev or above mean + k·stddev of their sensor and window.

    A reading belongs to its own baseline. With a single reading the deviation is
    NULL and nothing is flagged. ``summary``, when given, is the stored result of
    ``summarize`` over the same readings and period, which saves computing it again.
    """
    if summary is None:
        summary = summarize(df, spec, period)
    # A reading without sensor has no baseline and can never be flagged.
    rows = add_window_start(df.filter(all_present(spec.keys)), spec.ts, period)
    rows = attach_group_values(
        rows,
        baselines(summary, spec, k),
        [*spec.keys, WINDOW_START],
        baseline_columns(spec),
        size="reading_count",
        spread=[spec.ts],
    )
    return flagged(rows, df.columns, spec, period)


def baseline_columns(spec: SeriesSpec) -> list[str]:
    """Mean, deviation, lower and upper bound."""
    return [f"mean_{spec.label}", f"stddev_{spec.label}", f"lower_bound_{spec.unit}", f"upper_bound_{spec.unit}"]


def baselines(summary: DataFrame, spec: SeriesSpec, k: float) -> DataFrame:
    """Baselines and ``reading_count`` of the windows that have anomalies."""
    label = spec.label
    mean, stddev, lower, upper = baseline_columns(spec)
    # Only groups whose smallest or largest reading is out of bounds have anomalies.
    # They are few, so mostly they can be broadcast where all groups could not.
    return summary.selectExpr(
        *[f"`{c}`" for c in spec.keys],
        WINDOW_START,
        f"`avg_{label}` AS `{mean}`",
        f"`{stddev}`",
        f"`avg_{label}` - {float(k)}D * `{stddev}` AS `{lower}`",
        f"`avg_{label}` + {float(k)}D * `{stddev}` AS `{upper}`",
        f"`min_{label}` AS __min",
        f"`max_{label}` AS __max",
        "reading_count",
    ).filter(f"__min < `{lower}` OR __max > `{upper}`")


def flagged(rows: DataFrame, columns: Sequence[str], spec: SeriesSpec, period: str) -> DataFrame:
    """Those of ``rows``, which have baselines and ``window_start`` beside their ``columns``, that are out of bounds."""
    mean, stddev, lower, upper = baseline_columns(spec)
    found = rows.selectExpr(
        *[f"`{c}`" for c in spec.keys],
        *[f"`{c}`" for c in columns if c not in spec.keys],
        f"`{mean}`",
        f"`{stddev}`",
        f"`{lower}`",
        f"`{upper}`",
        f"`{spec.target}` < `{lower}` OR `{spec.target}` > `{upper}` AS is_anomaly",
        WINDOW_START,
    ).filter("is_anomaly")
    return add_window_end(found, period)
