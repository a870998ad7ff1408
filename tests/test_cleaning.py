import random
import re
from decimal import Decimal

import pytest
from plan import final_plan, formatted
from pyspark.sql import functions as F

from vanescope.operators import cleaning
from vanescope.spec import TURBINE, SeriesSpec

SPEC = SeriesSpec(
    keys=("s",), ts="t", measures=("a", "b"), target="a",
    bounds={"a": (0.0, 10.0), "b": (0.0, 360.0)}, tie_break=("id",), decimal=(10, 4),
)


def messy(n=3000, seed=5):
    rng = random.Random(seed)
    nan = float("nan")
    return [
        (
            i,
            rng.choice([None, *range(7)]) if i % 3 else 1,
            rng.choice([None, *range(40)]),
            rng.choice([None, nan, -1.0, 11.0, 0.0, 10.0, rng.random() * 10]),
            rng.choice([None, 361.0, 0.0, 360.0, rng.random() * 360]),
        )
        for i in range(n)
    ]


def brute_force_clean(rows):
    kept = {}
    for row in rows:
        _, s, t, _, _ = row
        if s is not None and t is not None and ((s, t) not in kept or row[0] < kept[s, t][0]):
            kept[s, t] = row
    valid = [
        (
            i, s, t,
            a if a is not None and 0 <= a <= 10 else None,
            b if b is not None and 0 <= b <= 360 else None,
        )
        for i, s, t, a, b in kept.values()
    ]
    means = {}
    for s in {r[1] for r in valid}:
        for c in (3, 4):
            values = [r[c] for r in valid if r[1] == s and r[c] is not None]
            means[s, c] = sum(values) / len(values) if values else None
    return {
        i: (
            s, t,
            a if a is not None else means[s, 3],
            b if b is not None else means[s, 4],
            (a is None and means[s, 3] is not None) or (b is None and means[s, 4] is not None),
        )
        for i, s, t, a, b in valid
    }


def test_clean_equals_brute_force(spark):
    rows = messy()
    df = spark.createDataFrame(rows, "id int, s int, t int, a double, b double")
    result = cleaning.clean(df, SPEC, flag="is_imputed")
    assert dict(result.dtypes)["a"] == "decimal(10,4)"
    got = {r.id: (r.s, r.t, r.a, r.b, r.is_imputed) for r in result.collect()}
    want = brute_force_clean(rows)
    assert got.keys() == want.keys()
    for i, (s, t, a, b, flag) in want.items():
        assert got[i][:2] == (s, t) and got[i][4] == flag
        for value, exact in zip(got[i][2:4], (a, b)):
            assert abs(float(value) - exact) <= 0.00005 + 1e-9


def test_columns_of_cleaned_turbine_readings(spark):
    df = spark.sql(
        "SELECT TIMESTAMP '2022-03-01 00:00:00' AS timestamp, 1 AS turbine_id, 11.8D AS wind_speed,"
        " 169D AS wind_direction, 2.7D AS power_output, current_timestamp() AS ingestion_timestamp"
    )
    assert cleaning.clean(df, TURBINE).dtypes == [
        ("turbine_id", "int"),
        ("timestamp", "timestamp"),
        ("wind_speed", "decimal(10,4)"),
        ("wind_direction", "decimal(10,4)"),
        ("power_output", "decimal(10,4)"),
        ("ingestion_timestamp", "timestamp"),
    ]


def test_keep_one_is_independent_of_the_order_of_rows(spark):
    rows = messy(800)
    df = spark.createDataFrame(rows, "id int, s int, t int, a double, b double")
    shuffled = spark.createDataFrame(rows[::-1], df.schema).repartition(5)
    first = cleaning.keep_one_per_key(df, ["s", "t"], ["a"])
    second = cleaning.keep_one_per_key(shuffled, ["s", "t"], ["a"])
    assert sorted(map(str, first.collect())) == sorted(map(str, second.collect()))
    assert first.columns == df.columns
    assert first.count() == len({(r[1], r[2]) for r in rows})


def test_keep_one_prefers_a_value_then_the_smallest(spark):
    df = spark.createDataFrame([(1, 3.0), (1, None), (2, 5.0), (2, 4.0)], "k int, v double")
    assert dict(cleaning.keep_one_per_key(df, ["k"]).collect()) == {1: 3.0, 2: 4.0}


def test_keep_one_needs_an_order(spark):
    with pytest.raises(TypeError):
        cleaning.keep_one_per_key(spark.sql("SELECT 1 AS k, map('a', 1) AS m"), ["k"])


def test_duplicates_equal_brute_force_also_for_null_keys(spark):
    rows = messy(500)
    df = spark.createDataFrame(rows, "id int, s int, t int, a double, b double")
    counts = {}
    for r in rows:
        counts[r[1:3]] = counts.get(r[1:3], 0) + 1
    want = sorted(r[0] for r in rows if counts[r[1:3]] > 1)
    got = cleaning.find_duplicates(df, ["s", "t"])
    assert got.columns == df.columns
    assert sorted(r.id for r in got.collect()) == want
    assert any(r[1] is None for r in rows if counts[r[1:3]] > 1)


def test_sensor_without_values_stays_null_and_unflagged(spark):
    df = spark.createDataFrame([(1, None), (1, None), (2, 4.0), (2, None)], "s int, a double")
    got = cleaning.impute_group_mean(df, ["s"], ["a"], flag="filled").collect()
    assert sorted(map(tuple, got), key=str) == [
        (1, None, False), (1, None, False), (2, 4.0, False), (2, 4.0, True)
    ]


def test_range_is_inclusive_and_nan_is_outside(spark):
    df = spark.sql(
        "SELECT explode(array(0D, 25D, 25.1D, -0.1D, double('NaN'), null)) AS wind_speed"
    )
    got = cleaning.null_out(df, {"wind_speed": (0.0, 25.0)}).collect()
    assert [r[0] for r in got] == [0.0, 25.0, None, None, None, None]


def test_decimals_round_half_up_once(spark):
    values = "1.00005D, -1.00005D, 34.07075D, 34.070749999999997D, 1.000049999996D"
    df = spark.sql(f"SELECT explode(array({values})) AS v")
    got = [str(r[0]) for r in cleaning.to_decimal(df, ["v"], (10, 4)).collect()]
    assert got == ["1.0001", "-1.0001", "34.0708", "34.0708", "1.0000"]


def test_a_value_is_preferred_to_a_gap(spark):
    rows = [(1, 10, None, 3.0), (1, 10, 5.0, None), (2, 10, None, None), (2, 10, None, 1.0)]
    df = spark.createDataFrame(rows, "s int, t int, a double, b double")
    got = sorted(tuple(r) for r in cleaning.keep_one_per_key(df, ["s", "t"]).collect())
    assert got == [(1, 10, 5.0, None), (2, 10, None, 1.0)]


def test_key_filter_reaches_the_scan(spark, tmp_path):
    spark.range(5).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / "t"))
    df = cleaning.drop_missing_keys(spark.read.parquet(str(tmp_path / "t")), ["k"])
    assert "PushedFilters: [IsNotNull(k)]" in formatted(df)


def test_clean_shuffles_the_rows_once(spark, tmp_path):
    rows = spark.createDataFrame(messy(), "id int, s int, t int, a double, b double")
    rows.write.parquet(str(tmp_path / "rows"))
    plan = final_plan(cleaning.clean(spark.read.parquet(str(tmp_path / "rows")), SPEC))
    assert "SortMergeJoin" not in plan
    # The one exchange of the rows removes duplicates; means and filled rows both read it.
    exchanges = dict(re.findall(r"Exchange hashpartitioning\((.*?), 8\).*?plan_id=(\d+)", plan))
    rows_moved = {i for keys, i in exchanges.items() if keys.split(", ")[-1].startswith("t#")}
    assert len(rows_moved) == 1 and len(set(exchanges.values())) <= 3
    assert "partial_min(struct(" in plan


def test_copies_are_reduced_before_the_shuffle(spark, tmp_path):
    spark.range(0, 90_000, numPartitions=6).selectExpr(
        "1 AS s", "1 AS t", "CAST(id AS DOUBLE) AS a"
    ).write.parquet(str(tmp_path / "hot"))
    df = cleaning.keep_one_per_key(spark.read.parquet(str(tmp_path / "hot")), ["s", "t"])
    assert [tuple(r) for r in df.collect()] == [(1, 1, 0.0)]
    stages = final_plan(df)
    assert "partial_min(struct(" in stages
    # Six scans of 15,000 copies pass on one row each.
    moved = re.findall(r"shuffle records written: (\d+)", stages)
    assert all(int(n) <= 6 for n in moved)
