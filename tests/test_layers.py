import random
import statistics
from datetime import datetime, timedelta, timezone
from decimal import ROUND_HALF_UP, Decimal

import pytest

from vanescope.plans import layers
from vanescope.sinks.files import landed_files, write_parquet

BOUNDS = [(0, 25), (0, 360), (0, 2.5)]


def write_fleet(directory, seed=11):
    """Three files of hourly readings of nine turbines, some rows missing or out of range."""
    rng = random.Random(seed)
    rows = []
    for turbine in range(1, 10):
        for hour in range(24 * 12):
            if rng.random() < 0.05:
                continue
            power = 9.0 if rng.random() < 0.01 else round(rng.uniform(1.2, 1.8), 1)
            power = 2.4 if rng.random() < 0.02 else power
            rows.append(
                [
                    datetime(2022, 3, 1) + timedelta(hours=hour),
                    turbine,
                    rng.choice([None, 26.0, *[round(rng.uniform(9, 15), 1)] * 8]),
                    rng.choice([None, 400, *[rng.randrange(361)] * 8]),
                    power,
                ]
            )
    directory.mkdir()
    for group in range(3):
        lines = ["timestamp,turbine_id,wind_speed,wind_direction,power_output"]
        for r in rows:
            if (r[1] - 1) // 3 == group:
                lines.append(",".join("" if v is None else str(v) for v in r))
        (directory / f"data_group_{group + 1}.csv").write_text("\n".join(lines) + "\n")
    return rows


def brute_force(rows):
    silver = []
    for turbine in range(1, 10):
        own = [
            [r[0], *[v if v is not None and lo <= v <= hi else None
                     for v, (lo, hi) in zip(r[2:], BOUNDS)]]
            for r in rows
            if r[1] == turbine
        ]
        for c in (1, 2, 3):
            known = [Decimal(str(r[c])) for r in own if r[c] is not None]
            mean = sum(known) / len(known)
            for r in own:
                value = mean if r[c] is None else Decimal(str(r[c]))
                r[c] = value.quantize(Decimal("0.0001"), ROUND_HALF_UP)
        silver += [(turbine, *r) for r in own]
    days = {}
    for r in silver:
        days.setdefault((r[0], r[1].date()), []).append(r)
    summary, flagged = {}, set()
    for key, own in days.items():
        power = [float(r[4]) for r in own]
        sd = statistics.stdev(power) if len(power) > 1 else None
        mean = statistics.fmean(power)
        summary[key] = (min(power), max(power), mean, sd, len(own))
        if sd is not None:
            flagged |= {r[:2] for r in own if abs(float(r[4]) - mean) > 2 * sd}
    return silver, summary, flagged


@pytest.fixture(scope="module")
def run(spark, tmp_path_factory):
    base = tmp_path_factory.mktemp("run")
    rows = write_fleet(base / "raw_data")
    config = layers.RunConfig(source=str(base / "raw_data"), base=str(base / "data"))
    return rows, config, layers.run(spark, config)


def test_layers_equal_brute_force(spark, run):
    rows, config, (summary, anomalies) = run
    silver, want_summary, want_flagged = brute_force(rows)
    stored = layers.stored_tables(spark, config)
    got = stored["silver"].select(
        "turbine_id", "timestamp", "wind_speed", "wind_direction", "power_output"
    )
    assert sorted(map(tuple, got.collect())) == sorted(silver)

    rows_of_summary = summary.collect()
    assert len(rows_of_summary) == len(want_summary)
    for r in rows_of_summary:
        low, high, mean, sd, n = want_summary[r.turbine_id, r.window_start.date()]
        assert (float(r.min_power_mw), float(r.max_power_mw), r.reading_count) == (low, high, n)
        assert abs(float(r.avg_power_mw) - mean) < 1e-8
        assert abs(r.stddev_power_mw - sd) < 1e-9

    assert {(r.turbine_id, r.timestamp) for r in anomalies.collect()} == want_flagged
    assert want_flagged


def test_counts_report_and_views(spark, run):
    rows, config, (_, anomalies) = run
    counts = {r.table_name: r.rows for r in layers.layer_counts(spark, config).collect()}
    assert counts["bronze"] == counts["silver"] == len(rows)
    # Taken while the tables were written.
    noted = {r.table_name: (r.row_count, r.corrupt_count) for r in layers.run_counts(spark, config).collect()}
    assert noted == {name: (n, 0 if name == "bronze" else None) for name, n in counts.items()}
    report = layers.bronze_report(spark, config).collect()
    assert [r.row_count for r in report if r.is_total] == [len(rows)]
    assert len(report) == 4 and all(r.corrupt_count == 0 for r in report)
    layers.register_serving_views(spark, config)
    first = spark.sql(
        "SELECT turbine_id, COUNT(*) AS anomaly_count FROM gold_anomalies "
        "GROUP BY turbine_id ORDER BY anomaly_count DESC"
    ).first()
    assert first.anomaly_count <= anomalies.count()
    assert spark.sql("SELECT COUNT(*) FROM Processed_data").first()[0] == len(rows)
    assert spark.sql("SELECT * FROM gold_summary_statistics WHERE turbine_id = 1").count() == 12


def test_bronze_keeps_lineage_and_raw_bytes(spark, run):
    _, config, _ = run
    bronze = layers.stored_tables(spark, config)["bronze"]
    assert bronze.select("ingestion_timestamp").distinct().count() == 1
    assert bronze.select("source_file").distinct().count() == 3
    raw = landed_files(spark, layers.Layers(config.base).raw_files)
    assert raw.filter("ends_with_line_feed").count() == raw.count() == 3
    report = spark.read.parquet(layers.Layers(config.base).report)
    assert report.count() == 4


def test_tables_by_date_and_flag(spark, run, tmp_path):
    rows, config, (_, anomalies) = run
    dated = layers.RunConfig(
        source=config.source, base=str(tmp_path), by_date=True, flag="is_imputed",
        keep_raw_files=False, run_time=datetime(2022, 4, 1, tzinfo=timezone.utc),
    )
    _, found = layers.run(spark, dated)
    silver = spark.read.parquet(layers.Layers(str(tmp_path)).silver)
    assert silver.select("reading_date").distinct().count() == 12
    missing = sum(
        any(v is None or not lo <= v <= hi for v, (lo, hi) in zip(r[2:], BOUNDS)) for r in rows
    )
    assert silver.filter("is_imputed").count() == missing
    assert found.columns == [
        *anomalies.columns[: anomalies.columns.index("ingestion_timestamp") + 1],
        "is_imputed",
        *anomalies.columns[anomalies.columns.index("ingestion_timestamp") + 1 :],
    ]
    assert found.count() == anomalies.count()


def test_publishing_needs_a_database(spark, run):
    with pytest.raises(ValueError):
        layers.publish(spark, run[1])


def test_counts_taken_on_the_way_to_the_files(spark, tmp_path):
    from pyspark.sql import functions as F

    counts = {"row_count": "count(*)", "total": "sum(id)"}
    nothing = spark.range(10).filter("id > 100")
    assert write_parquet(nothing, str(tmp_path / "a"), counts=counts)["row_count"] == 0
    assert write_parquet(spark.createDataFrame([], "id long"), str(tmp_path / "b"), counts=counts)["row_count"] == 0
    dated = spark.range(1000).withColumn("at", F.timestamp_seconds(F.col("id") * 3600))
    found = write_parquet(dated, str(tmp_path / "c"), date_of="at", sort_by=["id"], counts=counts)
    assert found == {"row_count": 1000, "total": 499500}
    assert spark.read.parquet(str(tmp_path / "c")).count() == 1000
