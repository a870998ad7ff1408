import math
import random
import statistics
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from vanescope.functions.columns import add_window_start
from vanescope.operators.anomalies import detect_anomalies
from vanescope.operators.summary import summarize
from vanescope.spec import TURBINE, SeriesSpec

SPEC = SeriesSpec(keys=("s",), ts="t", measures=("v",), target="v")
START = datetime(2022, 3, 1)


def frame(spark, rows):
    return spark.createDataFrame(rows, "s int, t timestamp_ntz, v double")


def hours(values, s=1):
    return [(s, START + timedelta(hours=i), v) for i, v in enumerate(values)]


def test_equals_brute_force(spark):
    rng = random.Random(3)
    rows = [
        (
            rng.choice([None, 1, 2, 3]) if i % 2 else 1,
            rng.choice([None, START + timedelta(minutes=rng.randrange(6000))]),
            rng.choice([None, rng.gauss(0, 1), rng.gauss(0, 1), rng.gauss(0, 9)]),
        )
        for i in range(2500)
    ]
    groups = {}
    for s, t, v in rows:
        if t is not None:
            day = t.replace(hour=0, minute=0)
            groups.setdefault((s, day), []).append(v)
    df = frame(spark, rows)
    got = {(r.s, r.window_start): r for r in summarize(df, SPEC).collect()}
    assert got.keys() == groups.keys()
    want = []
    for (s, day), values in groups.items():
        r, known = got[s, day], [v for v in values if v is not None]
        assert r.window_end == day + timedelta(days=1)
        assert r.reading_count == len(values)
        assert (r.min_v, r.max_v) == ((min(known), max(known)) if known else (None, None))
        if known:
            assert math.isclose(r.avg_v, statistics.fmean(known), abs_tol=1e-12)
        if len(known) < 2:
            assert r.stddev_v is None
            continue
        sd, mean = statistics.stdev(known), statistics.fmean(known)
        assert math.isclose(r.stddev_v, sd, rel_tol=1e-9)
        if s is not None:
            want += [(s, day, v) for v in known if v < mean - 2 * sd or v > mean + 2 * sd]
    found = detect_anomalies(df, SPEC).collect()
    assert sorted((r.s, r.window_start, r.v) for r in found) == sorted(want) and want
    for r in found:
        assert r.is_anomaly and not r.lower_bound_v <= r.v <= r.upper_bound_v


def test_stored_summary_gives_the_same_anomalies(spark, tmp_path):
    df = frame(spark, hours([1.0] * 20 + [50.0]) + hours([2.0] * 9 + [None, 70.0], s=2))
    summarize(df, SPEC).write.parquet(str(tmp_path / "summary"))
    stored = spark.read.parquet(str(tmp_path / "summary"))
    plain = sorted(detect_anomalies(df, SPEC).collect())
    assert plain == sorted(detect_anomalies(df, SPEC, summary=stored).collect())
    assert [r.v for r in plain] == [50.0, 70.0]


def test_smallest_group_that_can_flag_has_six_readings(spark):
    assert detect_anomalies(frame(spark, hours([1.0] * 4 + [9.0])), SPEC).count() == 0
    assert detect_anomalies(frame(spark, hours([1.0] * 5 + [9.0])), SPEC).count() == 1
    assert detect_anomalies(frame(spark, hours([1.0])), SPEC).count() == 0
    assert detect_anomalies(frame(spark, hours([1.0] * 8)), SPEC).count() == 0
    assert detect_anomalies(frame(spark, hours([None] * 8)), SPEC).count() == 0


def test_multiplier_and_period_are_arguments(spark):
    df = frame(spark, hours([1.0] * 4 + [9.0]))
    assert detect_anomalies(df, SPEC, k=1.0).count() == 1
    assert detect_anomalies(df, SPEC, period="1 hour", k=1.0).count() == 0


def test_windows_align_to_the_utc_day(spark):
    df = frame(spark, [(1, datetime(2022, 6, 1, 23, 59, 59), 1.0), (1, datetime(2022, 6, 2), 2.0)])
    starts = [r.window_start for r in summarize(df, SPEC).orderBy("window_start").collect()]
    assert starts == [datetime(2022, 6, 1), datetime(2022, 6, 2)]
    week = add_window_start(df, "t", "7 days").first().window_start
    assert week.weekday() == 3  # the epoch was a Thursday


def test_columns_and_types_on_cleaned_turbine_readings(spark):
    df = spark.range(24).select(
        F.lit(1).alias("turbine_id"),
        F.timestamp_seconds(F.col("id") * 3600).alias("timestamp"),
        *[F.lit(1).cast("decimal(10,4)").alias(m) for m in TURBINE.measures],
        F.current_timestamp().alias("ingestion_timestamp"),
    )
    assert summarize(df, TURBINE).dtypes == [
        ("turbine_id", "int"),
        ("min_power_mw", "decimal(10,4)"),
        ("max_power_mw", "decimal(10,4)"),
        ("avg_power_mw", "decimal(14,8)"),
        ("stddev_power_mw", "double"),
        ("reading_count", "bigint"),
        ("window_start", "timestamp"),
        ("window_end", "timestamp"),
    ]
    assert detect_anomalies(df, TURBINE).dtypes == [
        ("turbine_id", "int"),
        ("timestamp", "timestamp"),
        ("wind_speed", "decimal(10,4)"),
        ("wind_direction", "decimal(10,4)"),
        ("power_output", "decimal(10,4)"),
        ("ingestion_timestamp", "timestamp"),
        ("mean_power_mw", "decimal(14,8)"),
        ("stddev_power_mw", "double"),
        ("lower_bound_mw", "double"),
        ("upper_bound_mw", "double"),
        ("is_anomaly", "boolean"),
        ("window_start", "timestamp"),
        ("window_end", "timestamp"),
    ]
