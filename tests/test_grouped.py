from contextlib import contextmanager

import pytest
from plan import final_plan
from pyspark.sql import functions as F

from vanescope.operators.grouped import attach_group_values


@contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


SHUFFLED = {
    "spark__sql__autoBroadcastJoinThreshold": "-1",
    "spark__sql__adaptive__autoBroadcastJoinThreshold": "-1",
}
STATIC = {"spark__sql__adaptive__enabled": "false", **SHUFFLED}


@pytest.fixture
def stored(spark, tmp_path):
    """A third of the rows in group 0, the rest in 400 groups, some without group."""
    rows = spark.range(0, 60_000, numPartitions=8).selectExpr(
        "id",
        "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 50 = 1 THEN NULL ELSE 1 + id % 400 END AS g",
        "CAST(id % 17 AS DOUBLE) AS x",
    )
    rows.write.parquet(str(tmp_path / "rows"))
    return spark.read.parquet(str(tmp_path / "rows"))


def grouped(rows):
    return rows.groupBy("g").agg(F.sum("x").alias("total"), F.count("*").alias("n"))


def expected(rows):
    totals = {}
    for r in rows.collect():
        totals[r.g] = totals.get(r.g, 0.0) + r.x
    return totals


@pytest.mark.parametrize("setting", [{}, SHUFFLED, STATIC], ids=["default", "shuffled", "static"])
@pytest.mark.parametrize("null_safe", [False, True])
@pytest.mark.parametrize("heavy", [4, 1e9, 20, 1e-9])
def test_values_are_those_of_the_group(spark, stored, setting, null_safe, heavy):
    totals = expected(stored)
    with settings(spark, **setting):
        result = attach_group_values(
            stored, grouped(stored), ["g"], ["total"], "n", ["id"], null_safe, heavy
        ).collect()
    assert sorted(r.id for r in result) == list(range(60_000))
    for r in result:
        assert r.total == (totals[r.g] if null_safe or r.g is not None else None)


def test_rows_stay_where_they_are_when_groups_are_few(spark, stored):
    df = attach_group_values(
        stored, grouped(stored), ["g"], ["total"], "n", ["id"], heavy_share=1
    )
    plan = final_plan(df)
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 3
    # Shuffled: the partial sums, the table of groups. Its other uses read the same exchange.
    assert plan.count("ReusedExchange") == 2
    assert plan.count("- Exchange hashpartitioning") == 2


def test_without_heavy_groups_one_broadcast_remains(spark, stored):
    plan = final_plan(
        attach_group_values(
            stored, grouped(stored), ["g"], ["total"], "n", ["id"], heavy_share=1e-9
        )
    )
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") == 1
    assert plan.count("- Exchange hashpartitioning") <= 2


def test_rows_of_a_heavy_group_are_spread(spark, stored):
    with settings(
        spark, spark__sql__adaptive__coalescePartitions__enabled="false", **SHUFFLED
    ):
        df = attach_group_values(
            stored, grouped(stored), ["g"], ["total"], "n", ["id"], heavy_share=1
        )
        assert "SortMergeJoin" in final_plan(df)
        sizes = [
            r["count"]
            for r in df.filter("g = 0").groupBy(F.spark_partition_id()).agg(
                F.count("total").alias("count")
            ).collect()
        ]
    assert len(sizes) == 8 and max(sizes) < 2 * min(sizes)


def test_a_thousand_equal_groups_all_keep_within_a_task(spark, tmp_path):
    spark.range(0, 40_000, numPartitions=4).selectExpr("id % 1000 AS g", "1D AS x", "id").write.parquet(
        str(tmp_path / "many")
    )
    rows = spark.read.parquet(str(tmp_path / "many"))
    with settings(
        spark, spark__sql__adaptive__coalescePartitions__enabled="false", **SHUFFLED
    ):
        df = attach_group_values(rows, grouped(rows), ["g"], ["total"], "n", ["id"])
        used = df.groupBy(F.spark_partition_id()).agg(F.count("total").alias("count")).collect()
    assert len(used) == 8 and max(r["count"] for r in used) < 2 * 40_000 / 8


def test_copies_of_one_row_are_spread_by_partition(spark, tmp_path):
    spark.range(0, 8000, numPartitions=8).selectExpr("1 AS g", "2D AS x").write.parquet(
        str(tmp_path / "copies")
    )
    rows = spark.read.parquet(str(tmp_path / "copies"))
    with settings(
        spark,
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__sql__files__maxPartitionBytes="600",
        spark__sql__files__openCostInBytes="0",
        **SHUFFLED,
    ):
        df = attach_group_values(rows, grouped(rows), ["g"], ["total"], "n", ["x"], heavy_share=1)
        used = df.groupBy(F.spark_partition_id()).agg(F.count("total").alias("count"))
        assert "Join" in final_plan(used)
        used = used.collect()
        assert len(used) > 2 and sum(r["count"] for r in used) == 8000
        assert {r.total for r in df.collect()} == {16000.0}
