import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vanescope.functions.columns import source_columns, with_snake_case_names
from vanescope.operators.context import attach_hourly, collapse_sources, flatten_hourly
from vanescope.operators.reports import count_per_key, first_rows, in_order
from vanescope.plans.hours import hourly_table
from vanescope.sinks.files import write_json_lines
from vanescope.sources import hourly

HOURS = [
    {
        "time": "2026-01-01T01:00:00+01:00",
        "airTemperature": {"ecmwf": 1.5, "ecmwf:aifs": 2.5, "sg": 3.25},
        "waveHeight": {"dwd": 0.5, "sg": 0.25},
    },
    {
        "time": "2026-01-01T01:00:00+00:00",
        "airTemperature": {"ecmwf": 4.5, "ecmwf:aifs": 5.5},
        "waveHeight": {"dwd": 0.75, "sg": None},
    },
]
META = {
    "cost": 1, "dailyQuota": 10, "end": "2026-01-01 01:00", "lat": 58.5, "lng": 17.25,
    "params": ["waveHeight", "airTemperature"], "requestCount": 3, "start": "2026-01-01 00:00",
}
PARAMS = ["waveHeight", "airTemperature"]
SCHEMA = hourly.hour_schema(
    {"airTemperature": ["ecmwf", "ecmwf:aifs", "sg"], "waveHeight": ["dwd", "sg"]}
)
FLAT = [
    (datetime(2026, 1, 1, 0), 0.5, 0.25, 1.5, 2.5, 3.25),
    (datetime(2026, 1, 1, 1), 0.75, None, 4.5, 5.5, None),
]
NAMES = [
    "time", "waveHeight_dwd", "waveHeight_sg",
    "airTemperature_ecmwf", "airTemperature_ecmwf_aifs", "airTemperature_sg",
]


def flat(hours):
    df = flatten_hourly(hours, PARAMS)
    assert df.columns == NAMES and dict(df.dtypes)["time"] == "timestamp"
    assert set(dict(df.dtypes).values()) == {"timestamp", "double"}
    naive = df.withColumn("time", F.col("time").cast("timestamp_ntz"))
    return [tuple(r) for r in naive.orderBy("time").collect()]


@pytest.fixture
def document(tmp_path):
    path = tmp_path / "document.json"
    path.write_text(json.dumps({"hours": HOURS, "meta": META}, indent=2))
    return str(path)


@pytest.mark.parametrize("schema", [None, hourly.document_schema(SCHEMA)])
def test_document(spark, document, schema):
    documents = hourly.read_documents(spark, document, schema)
    assert flat(hourly.hours_of(documents)) == FLAT
    assert hourly.metadata_of(documents).first().asDict() == META


@pytest.mark.parametrize("schema", [None, SCHEMA])
def test_lines_written_and_read_back(spark, document, tmp_path, schema):
    hours = hourly.hours_of(hourly.read_documents(spark, document))
    write_json_lines(hours, str(tmp_path / "hours"))
    assert flat(hourly.read_hours(spark, str(tmp_path / "hours"), schema)) == FLAT


@pytest.mark.parametrize("schema", [None, SCHEMA])
def test_table_of_hours(spark, document, tmp_path, schema):
    times = [f[0] for f in FLAT]
    from_document = hourly_table(spark, document, hour=schema)
    assert from_document.columns == NAMES
    assert [r.time for r in from_document.collect()] == times
    (tmp_path / "hours.json").write_text("\n".join(json.dumps(h) for h in HOURS[::-1]))
    from_lines = hourly_table(spark, str(tmp_path / "hours.json"), hour=schema, documents=False)
    assert from_lines.orderBy("time").collect() == from_document.orderBy("time").collect()


def test_strings(spark):
    lines = spark.createDataFrame([(json.dumps(h),) for h in HOURS], "line string")
    inferred = hourly.infer_schema(lines, "line")
    assert flat(hourly.parse_json(lines, "line", inferred)) == FLAT
    assert flat(hourly.parse_json(lines, "line", SCHEMA)) == FLAT


def test_broken_strings_give_nulls(spark):
    lines = spark.createDataFrame([("{",), ('{"k": 3}',)], "line string")
    schema = hourly.infer_schema(lines, "line")
    assert {r.k for r in hourly.parse_json(lines, "line", schema).collect()} == {None, 3}


def test_one_value_per_parameter(spark):
    lines = spark.createDataFrame([(json.dumps(h),) for h in HOURS], "line string")
    df = collapse_sources(hourly.parse_json(lines, "line", SCHEMA), PARAMS)
    assert df.columns == ["time", *PARAMS]
    assert sorted(tuple(r)[1:] for r in df.collect()) == [(0.25, 3.25), (0.75, 4.5)]


def test_names_with_dots_and_collisions(spark):
    df = spark.sql("SELECT named_struct('a.b', 1D) AS p, named_struct('a:b', 1, 'a_b', 2) AS q")
    assert df.select(*source_columns(df, "p")).columns == ["p_a.b"]
    with pytest.raises(ValueError):
        source_columns(df, "q")
    with pytest.raises(TypeError):
        source_columns(spark.range(1), "id")


def test_context_of_the_hour(spark, tmp_path):
    spark.range(0, 600).selectExpr("id", "timestamp_seconds(id * 60) AS t").write.parquet(
        str(tmp_path / "rows")
    )
    context = spark.range(0, 9).selectExpr("timestamp_seconds(id * 3600) AS time", "id * 1.5D AS w")
    rows = spark.read.parquet(str(tmp_path / "rows"))
    got = attach_hourly(rows, context, "t")
    assert got.columns == ["id", "t", "w"]
    values = {r.id: r.w for r in got.collect()}
    assert len(values) == 600
    for i, w in values.items():
        assert w == (i // 60 * 1.5 if i < 540 else None)


def test_snake_case(spark):
    df = spark.range(1).selectExpr("id AS ` Wind-Speed `", "id AS `Power Output`")
    assert with_snake_case_names(df).columns == ["wind_speed", "power_output"]
    with pytest.raises(ValueError):
        with_snake_case_names(spark.range(1).selectExpr("id AS `a b`", "id AS `A-B`"))


def test_orders_and_counts(spark):
    df = spark.range(0, 40).selectExpr("id % 3 AS k", "id").repartition(4)
    rows = [tuple(r) for r in in_order(df, ["k"]).collect()]
    assert rows == sorted(rows)
    assert [tuple(r) for r in first_rows(df, ["k", "id"], 3).collect()] == rows[:3]
    assert [tuple(r) for r in count_per_key(df, ["k"]).collect()] == [(0, 14), (1, 13), (2, 13)]


def test_context_off_the_hour_counts_for_its_hour(spark):
    rows = spark.sql("SELECT id, timestamp'2024-01-01 00:10:00' + make_interval(0,0,0,0,id) AS t FROM range(3)")
    context = spark.sql(
        "SELECT * FROM VALUES (timestamp'2024-01-01 00:45:00', 1.0D), (timestamp'2024-01-01 00:30:00', 5.0D),"
        " (timestamp'2024-01-01 00:30:00', 4.0D), (timestamp'2024-01-01 01:59:59', 7.0D) AS v(time, peak)"
    )
    got = {r.id: r.peak for r in attach_hourly(rows, context, "t").collect()}
    assert got == {0: 4.0, 1: 7.0, 2: None}


def test_long_hours_take_every_parameter_and_source(spark):
    from vanescope.sources.hourly import long_hours

    lines = [
        ('{"time": "2026-08-30T23:00:00+00:00", "waveHeight": {"sg": 1, "ecmwf:aifs": 2.5}, "note": "x"}',),
        ('{"time": "2026-08-31T01:00:00+02:00", "airTemperature": {"new source": -3.25e0, "sg": null, "text": "1"}}',),
        ('{"waveHeight": {"sg": 7}}',),
        ('{"time": "no time", "waveHeight": {"sg": 8}}',),
        ("no json",),
        ("[]",),
        ("3",),
        (None,),
        ("{}",),
    ]
    hours = spark.createDataFrame(lines, "line string")
    got = [(r.time and r.time.strftime("%d %H"), r.parameter, r.source, r.value) for r in long_hours(hours, "line").collect()]
    assert sorted(got, key=repr) == sorted(
        [("30 23", "waveHeight", "sg", 1.0), ("30 23", "waveHeight", "ecmwf:aifs", 2.5), ("30 23", "airTemperature", "new source", -3.25),
         (None, "waveHeight", "sg", 7.0), (None, "waveHeight", "sg", 8.0)],
        key=repr,
    )
    documents = spark.createDataFrame([('{"hours": [' + ", ".join(x for x, in lines[:2]) + '], "meta": {"cost": 1}}',), ("{}",), ('{"hours": 3}',), (None,)], "d string")
    found = long_hours(documents, "d", documents=True)
    assert sorted((r.source, r.value) for r in found.collect()) == [("ecmwf:aifs", 2.5), ("new source", -3.25), ("sg", 1.0)]


def test_events_of_unknown_type_are_kept(spark, tmp_path):
    from datetime import datetime

    from oracle import duck, mismatch

    from vanescope import workload

    at = datetime(2024, 1, 1, 5)
    rows = [(1, at, 1, "click", 1.0, "{}"), (2, at, 1, None, 2.0, "{}"), (3, at, 1, "refund", 5.0, "{}"), (4, at, 1, "refund", None, "{}"), (5, at, 1, "empty", None, "{}")]
    schema = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "tables/events.parquet"))
    connection = duck("/nowhere")
    connection.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/tables/events.parquet/*.parquet'")
    for name in ("json_hours", "json_long", "json_documents_long", "collapse_sources"):
        assert mismatch(workload.QUERIES[name](spark, str(tmp_path / "tables")), connection, workload.SQL[name]) is None, name
    assert workload.json_hours(spark, str(tmp_path / "tables")).first().peak_other_max == 5.0
