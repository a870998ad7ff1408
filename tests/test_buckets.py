import random
from datetime import datetime, timedelta

import pytest
from plan import final_plan

from vanescope.operators.anomalies import detect_anomalies
from vanescope.operators.summary import summarize
from vanescope.plans import buckets
from vanescope.spec import SeriesSpec

SPEC = SeriesSpec(keys=("site", "sensor"), ts="at", measures=("value",), target="value")


@pytest.fixture(scope="module")
def readings(spark):
    pick = random.Random(3)
    # One sensor has a third of all rows.
    rows = [
        ("a" if n % 3 == 0 else pick.choice(["b", "c", None]), 1 if n % 3 == 0 else pick.choice([1, 2, None]),
         datetime(2024, 1, 1) + timedelta(minutes=pick.randrange(60 * 24 * 20)) if n % 50 else None, pick.choice([None, 9.0, *[pick.gauss(0, 1)] * 20]), n)
        for n in range(6000)
    ]
    return spark.createDataFrame(rows, "site string, sensor int, at timestamp, value double, n long")


@pytest.fixture(scope="module")
def name(spark, readings, tmp_path_factory):
    buckets.write_buckets(readings, "readings_in_buckets", str(tmp_path_factory.mktemp("b") / "t"), SPEC, "2 days", buckets=5)
    return "readings_in_buckets"


def rows(df):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.collect()), key=repr)


def test_summary_is_the_same_and_moves_nothing(spark, readings, name):
    found = buckets.bucketed_summary(spark, name, SPEC, "2 days")
    want = summarize(readings, SPEC, "2 days")
    assert found.columns == want.columns and rows(found) == rows(want)
    assert "Exchange" not in final_plan(found) and "Bucketed: true" in final_plan(found)


def test_anomalies_are_the_same_and_move_nothing(spark, readings, name):
    found = buckets.bucketed_anomalies(spark, name, SPEC, "2 days")
    want = detect_anomalies(readings, SPEC, "2 days")
    assert found.columns == want.columns and rows(found) == rows(want) and want.count() > 0
    assert "Exchange" not in final_plan(found) and "SortMergeJoin" in final_plan(found)


def test_a_heavy_sensor_is_spread_by_its_windows(spark, name, readings):
    per_bucket = spark.table(name).selectExpr("pmod(hash(site, sensor, window_start), 5) AS b").groupBy("b").count()
    assert max(r["count"] for r in per_bucket.collect()) < 0.4 * readings.count()
    assert buckets.heaviest_window(spark, name, SPEC) < 0.1


def test_empty_table(spark, readings, tmp_path):
    buckets.write_buckets(readings.limit(0), "no_readings", str(tmp_path / "t"), SPEC, "2 days", buckets=3)
    assert buckets.bucketed_summary(spark, "no_readings", SPEC, "2 days").count() == 0
    assert buckets.bucketed_anomalies(spark, "no_readings", SPEC, "2 days").count() == 0
    assert buckets.heaviest_window(spark, "no_readings", SPEC) == 0.0
