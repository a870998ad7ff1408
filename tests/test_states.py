import math
import random
import statistics
from dataclasses import replace
from datetime import datetime, timedelta

import pytest
from plan import final_plan
from pyspark.sql import functions as F

from vanescope.operators.states import merge_states, roll_up_states, summary_of_states, window_states
from vanescope.operators.summary import summarize
from vanescope.plans import running
from vanescope.spec import SeriesSpec

SPEC = SeriesSpec(keys=("site", "sensor"), ts="at", measures=("value",), target="value")
SCHEMA = "site string, sensor int, at timestamp, value double"


def readings(seed, n, level=0.0, spread=1.0):
    pick = random.Random(seed)
    return [
        (pick.choice(["a", "b", None]), pick.choice([1, 2, None]), datetime(2024, 1, 1) + timedelta(minutes=pick.randrange(60 * 24 * 21)),
         pick.choice([None, *[level + pick.gauss(0, spread)] * 5]))
        for _ in range(n)
    ]


def by_key(df):
    return {(r.site, r.sensor, r.window_start): r for r in df.collect()}


def same(got, want, tolerance=1e-9):
    got, want = by_key(got), by_key(want)
    assert set(got) == set(want)
    for key, w in want.items():
        for name, value in w.asDict().items():
            other = got[key][name]
            if isinstance(value, float) and isinstance(other, float):
                assert math.isclose(other, value, rel_tol=tolerance, abs_tol=1e-12) or (math.isnan(value) and math.isnan(other)), (key, name)
            else:
                assert other == value, (key, name)


@pytest.mark.parametrize("parts", [1, 2, 7])
def test_merged_parts_equal_the_whole(spark, parts):
    rows = readings(1, 3000)
    whole = summarize(spark.createDataFrame(rows, SCHEMA), SPEC, "1 day")
    states = [window_states(spark.createDataFrame(rows[i::parts], SCHEMA), SPEC, "1 day") for i in range(parts)]
    same(summary_of_states(merge_states(states, SPEC.keys), SPEC, "1 day"), whole)


def test_large_level_and_small_spread_lose_no_digits(spark):
    rows = readings(2, 2000, level=1e9, spread=1e-3)
    states = [window_states(spark.createDataFrame(rows[i::5], SCHEMA), SPEC, "7 days") for i in range(5)]
    for r in summary_of_states(merge_states(states, SPEC.keys), SPEC, "7 days").collect():
        own = [v for s, k, at, v in rows if (s, k) == (r.site, r.sensor) and v is not None and r.window_start <= at < r.window_end]
        assert math.isclose(r.stddev_value, statistics.stdev(own), rel_tol=1e-3)


def test_days_roll_up_to_weeks(spark):
    df = spark.createDataFrame(readings(3, 3000), SCHEMA)
    weeks = roll_up_states(window_states(df, SPEC, "1 day"), SPEC.keys, "7 days")
    same(summary_of_states(weeks, SPEC, "7 days"), summarize(df, SPEC, "7 days"))


def test_decimals_give_the_same_mean_to_the_last_digit(spark):
    df = spark.createDataFrame(readings(4, 3000), SCHEMA).withColumn("value", F.col("value").cast("decimal(10,4)"))
    states = [window_states(part, SPEC, "1 day") for part in df.randomSplit([1.0, 1.0, 1.0], seed=5)]
    got = summary_of_states(merge_states(states, SPEC.keys), SPEC, "1 day")
    want = summarize(df, SPEC, "1 day")
    assert got.schema["avg_value"].dataType == want.schema["avg_value"].dataType
    same(got, want)


def test_awkward_values(spark):
    day, nan, inf = datetime(2024, 1, 1), float("nan"), float("inf")
    rows = [("a", 1, day, None), ("a", 1, day, None), ("b", 1, day, 5.0), ("c", 1, day, inf), ("c", 1, day, 1.0), ("d", 1, day, nan), ("d", 1, day, 2.0), ("e", 1, None, 2.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    halves = [window_states(spark.createDataFrame(rows[i::2], SCHEMA), SPEC, "1 day") for i in range(2)]
    got = by_key(summary_of_states(merge_states(halves, SPEC.keys), SPEC, "1 day"))
    want = by_key(summarize(df, SPEC, "1 day"))
    assert set(got) == set(want)
    for key in want:
        assert repr(got[key].avg_value) == repr(want[key].avg_value) and got[key].reading_count == want[key].reading_count
    assert got["a", 1, day].stddev_value is None and got["b", 1, day].stddev_value is None
    empty = window_states(df.limit(0), SPEC, "1 day")
    assert merge_states([empty, empty], SPEC.keys).count() == 0


def test_batches_are_repeatable_and_old_rows_are_not_read(spark, tmp_path):
    rows = readings(6, 2000)
    spec, path = replace(SPEC), str(tmp_path / "states")
    first, second = (spark.createDataFrame(rows[i::2], SCHEMA) for i in range(2))
    running.add_batch(first, path, "one", spec)
    running.add_batch(second, path, "two", spec)
    # A run that is repeated replaces what it wrote.
    running.add_batch(second, path, "two", spec)
    whole = summarize(spark.createDataFrame(rows, SCHEMA), spec)
    found = running.running_summary(spark, path, spec)
    same(found, whole)
    running.compact(spark, path, str(tmp_path / "one"), "all", spec)
    same(running.running_summary(spark, str(tmp_path / "one"), spec), whole)
    plan = final_plan(found)
    # States only, and one shuffle for window function and aggregate.
    assert plan.count("Exchange hashpartitioning") == 1 and "state_m2" in plan and "PythonRDD" not in plan
