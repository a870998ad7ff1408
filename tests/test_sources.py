from pathlib import Path
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from vanescope.operators.reports import ingest_report
from vanescope.sinks.files import land_raw_files, landed_files, write_parquet
from vanescope.sources.database import postgres_options
from vanescope.sources.readings import list_csv_files, read_readings, read_readings_by_name, stamp

HEADER = "timestamp,turbine_id,wind_speed,wind_direction,power_output\n"
LINES = [
    "2022-03-01 00:00:00,1,11.8,169,2.7",
    "2022-03-01 00:00:00,1,9.0,100,2.0",
    "2022-03-01 01:00:00,1,abc,24,2.1",
    "2022-03-01 02:00:00,1,,24,2.2,extra",
    "2022-03-01 03:00:00,1,5",
    "bad,2,1,2,2.0",
    ",2,1,2,2.0",
    "2022-03-01T04:00:00,2,NaN,361,-1",
    "2022-03-01 05:00:00,3,26,-5,",
    "2022-03-01 06:00:00,,26,-5,1",
]


@pytest.fixture
def csv_dir(tmp_path):
    source = tmp_path / "raw"
    source.mkdir()
    (source / "group_1.csv").write_text(HEADER + "\n".join(LINES[:5]) + "\n")
    (source / "group_2.csv").write_text(HEADER + "\n".join(LINES[5:]) + "\n")
    (source / "empty.csv").write_text(HEADER)
    (source / "._group_1.csv").write_text("archive metadata")
    (source / "notes.txt").write_text("no readings")
    return source


def test_malformed_rows_are_kept(spark, csv_dir):
    rows = read_readings(spark, str(csv_dir)).cache().collect()
    parsed = {
        (r.timestamp and r.timestamp.hour, r.turbine_id, r.wind_speed, r.wind_direction,
         r.power_output, r._corrupt_record is not None)
        for r in rows
        if r.wind_speed == r.wind_speed
    }
    assert len(rows) == 10
    assert parsed == {
        (0, 1, 11.8, 169.0, 2.7, False),
        (0, 1, 9.0, 100.0, 2.0, False),
        (1, 1, None, 24.0, 2.1, True),
        (2, 1, None, 24.0, 2.2, True),
        (3, 1, 5.0, None, None, True),
        (None, 2, 1.0, 2.0, 2.0, True),
        (None, 2, 1.0, 2.0, 2.0, False),
        (5, 3, 26.0, -5.0, None, False),
        (6, None, 26.0, -5.0, 1.0, False),
    }
    assert {r._corrupt_record for r in rows if r._corrupt_record} == {
        LINES[i] for i in (2, 3, 4, 5, 7)
    }
    assert {r.source_file.rsplit("/", 1)[1] for r in rows} == {"group_1.csv", "group_2.csv"}


def test_report_counts_malformed_rows_and_empty_files(spark, csv_dir, tmp_path):
    write_parquet(read_readings(spark, str(csv_dir)), str(tmp_path / "bronze"))
    report = ingest_report(
        spark.read.parquet(str(tmp_path / "bronze")), files=list_csv_files(spark, str(csv_dir))
    )
    got = {
        r.source_file and r.source_file.rsplit("/", 1)[1]: (r.row_count, r.corrupt_count)
        for r in report.collect()
    }
    assert got == {
        "group_1.csv": (5, 3),
        "group_2.csv": (5, 2),
        "empty.csv": (0, 0),
        None: (10, 5),
    }


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        read_readings(spark, str(tmp_path / "absent"))
    (tmp_path / "other").mkdir()
    (tmp_path / "other" / "notes.txt").write_text("no readings")
    with pytest.raises(FileNotFoundError):
        read_readings(spark, str(tmp_path / "other"))


def test_header_check_is_optional(spark, tmp_path):
    (tmp_path / "swapped.csv").write_text(
        "turbine_id,timestamp,wind_speed,wind_direction,power_output\n" + LINES[0] + "\n"
    )
    assert read_readings(spark, str(tmp_path)).first().turbine_id == 1
    with pytest.raises(Exception, match="header"):
        read_readings(spark, str(tmp_path), check_header=True).collect()


def test_run_time_is_one_value(spark):
    at = datetime(2024, 5, 1, 12, tzinfo=timezone.utc)
    df = stamp(spark.range(100).repartition(4), at)
    assert df.select(F.unix_timestamp("ingestion_timestamp")).distinct().collect() == [
        (int(at.timestamp()),)
    ]


def test_raw_files_keep_every_byte(spark, csv_dir, tmp_path):
    (csv_dir / "large.csv").write_bytes(b"".join(b"%d;\xff;a\r\n" % i for i in range(400)))
    (csv_dir / "open end.csv").write_bytes(b"a\nb")
    (csv_dir / "blank%.csv").write_bytes(b"\n\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    try:
        land_raw_files(spark, str(csv_dir), str(tmp_path / "landed"))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    files = landed_files(spark, str(tmp_path / "landed")).collect()
    lines = spark.read.parquet(str(tmp_path / "landed/lines")).orderBy(
        "path", "split_start", "line_in_split"
    )
    content = {r.path: b"" for r in files}
    for row in lines.collect():
        content[row.path] += bytes(row.line) + b"\n"
    for r in files:
        kept = content[r.path] if r.ends_with_line_feed else content[r.path][:-1]
        assert len(kept) == r.length
        assert kept == Path(r.path.removeprefix("file:")).read_bytes()
    # Spark lists no file without a byte.
    assert len(files) == len([f for f in csv_dir.glob("[!.]*.csv") if f.stat().st_size])


def test_report_of_files_with_awkward_names(spark, tmp_path):
    source = tmp_path / "my 100% dir"
    source.mkdir()
    (source / "a b%.csv").write_text("timestamp,turbine_id,wind_speed,wind_direction,power_output\n" * 2)
    (source / "none.csv").write_text("timestamp,turbine_id,wind_speed,wind_direction,power_output\n")
    read_readings(spark, str(source)).write.parquet(str(tmp_path / "bronze"))
    report = ingest_report(
        spark.read.parquet(str(tmp_path / "bronze")), files=list_csv_files(spark, str(source))
    ).collect()
    assert sorted((r.row_count, r.is_total) for r in report) == [(0, False), (1, False), (1, True)]


def test_table_by_date_is_pruned_by_date(spark, tmp_path):
    from plan import formatted

    df = spark.range(0, 96).selectExpr("id", "timestamp_seconds(id * 3600) AS t")
    write_parquet(df, str(tmp_path / "t"), date_of="t", sort_by=["t"])
    back = spark.read.parquet(str(tmp_path / "t"))
    day = back.filter("reading_date = DATE '1970-01-02'")
    assert back.count() == 96 and day.count() == 24
    assert "PartitionFilters: [isnotnull(reading_date" in formatted(day)


def test_postgres_options():
    env = {"POSTGRES_DB": "d", "POSTGRES_HOST": "h", "POSTGRES_PORT": "5433", "POSTGRES_USER": "u"}
    assert postgres_options(env) == {
        "url": "jdbc:postgresql://h:5433/d",
        "user": "u",
        "password": "",
        "driver": "org.postgresql.Driver",
    }


def rows_scanned(df):
    """Rows that the scan of files gives, before any filter."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_lookup_passes_over_row_groups_without_the_value(spark, tmp_path):
    from vanescope.operators.reports import for_sensor

    # Many sensors, in no order, so that every row group spans nearly all of them.
    rows = spark.range(200_000).selectExpr("id", "xxhash64(id) % 1000000 * 2 AS sensor", "uuid() AS note").repartition(4)
    spark.conf.set("parquet.block.size", str(256 << 10))
    try:
        for name, lookup in (("plain", None), ("filtered", {"sensor": 50_000})):
            write_parquet(rows, str(tmp_path / name), sort_by=["id"], lookup_by=lookup)
    finally:
        spark.conf.unset("parquet.block.size")
    known = rows.orderBy("id").first().sensor
    plain, filtered = (spark.read.parquet(str(tmp_path / name)) for name in ("plain", "filtered"))
    assert for_sensor(filtered, "sensor", known).count() == for_sensor(plain, "sensor", known).count() >= 1
    found = for_sensor(filtered, "sensor", known)
    assert rows_scanned(found) < 0.2 * rows_scanned(for_sensor(plain, "sensor", known))
    assert {r.sensor for r in found.collect()} == {known}
    # An odd number is no sensor.
    assert rows_scanned(for_sensor(filtered, "sensor", 33)) < 0.1 * rows.count()


def readable(rows):
    return sorted(repr([v for k, v in r.asDict().items() if k != "source_file"] + [r.source_file.rpartition("/")[2]]) for r in rows.collect())


def test_files_of_one_header_read_the_same_by_name(spark, csv_dir):
    by_position, by_name = read_readings(spark, str(csv_dir)), read_readings_by_name(spark, str(csv_dir))
    assert by_name.columns == by_position.columns
    assert readable(by_name) == readable(by_position)


def test_columns_bind_by_the_names_of_each_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Power_Output,turbine_id, timestamp ,wind_speed,wind_direction\n1.5,7,2022-03-01 00:00:00,9.0,10\n")
    (tmp_path / "b.csv").write_text('\nturbine_id,note,timestamp\n8,"x, y",2022-03-01 01:00:00\n8,z\n')
    (tmp_path / "c.csv").write_text(HEADER + HEADER + "2022-03-01 02:00:00,9,1,2,bad\n")
    rows = read_readings_by_name(spark, str(tmp_path)).collect()
    got = [(r.source_file.rpartition("/")[2], r.timestamp and r.timestamp.hour, r.turbine_id, r.wind_speed, r.power_output, r._corrupt_record) for r in rows]
    assert sorted(got, key=repr) == sorted(
        [
            ("a.csv", 0, 7, 9.0, 1.5, None),
            ("b.csv", 1, 8, None, None, None),
            ("b.csv", None, 8, None, None, "8,z"),
            # A second line like the header is a line like any other.
            ("c.csv", None, None, None, None, HEADER.strip()),
            ("c.csv", 2, 9, 1.0, None, "2022-03-01 02:00:00,9,1,2,bad"),
        ],
        key=repr,
    )
    (tmp_path / "d.csv").write_text("turbine_id,Turbine_Id\n1,2\n")
    with pytest.raises(ValueError, match="repeats"):
        read_readings_by_name(spark, str(tmp_path))


def test_headers_of_files_in_many_splits(spark, tmp_path):
    names = ["timestamp", "turbine_id", "wind_speed", "wind_direction", "power_output"]
    for turbine, order in ((1, names), (2, names[::-1])):
        lines = [",".join(order)]
        for n in range(400):
            row = dict(zip(names, ["2022-03-01 00:00:00", str(turbine), str(n), "1", "2"]))
            lines.append(",".join(row[c] for c in order))
        (tmp_path / f"{turbine}.csv").write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        rows = read_readings_by_name(spark, str(tmp_path))
        assert sorted((r.turbine_id, r.wind_speed, r.power_output, r._corrupt_record) for r in rows.collect()) == [
            (t, float(n), 2.0, None) for t in (1, 2) for n in range(400)
        ]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
