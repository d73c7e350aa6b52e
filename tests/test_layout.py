"""How tables and reports lie on disk and in which order rows come: landing table, positions, single report files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from roadflow import operators as ops
from roadflow.sinks import read_catalogue, read_catalogued, report_path, write_catalogued, write_report_file
from roadflow.sources import read_landing, read_report, write_landing

T0 = dt.datetime(2024, 1, 10)


def _rows_read(df):
    """Rows that the Parquet scan of an executed plan put out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    while not plan.nodeName().startswith("Scan"):
        plan = plan.executedPlan() if plan.nodeName() == "AdaptiveSparkPlan" else plan.children().head()
    return plan.metrics().apply("numOutputRows").value()


def _readings(spark, days=40, per_day=600, sensors=10):
    n = days * per_day
    rows = spark.range(n).select(
        F.concat(F.lit("S"), (F.col("id") % sensors).cast("string")).alias("sensor_id"), (F.col("id") % 7).cast("int").alias("vehicle_count"),
        (F.col("id") % 90).cast("double").alias("avg_speed"),
        F.timestamp_seconds(F.lit(int(T0.replace(tzinfo=dt.timezone.utc).timestamp())) + F.floor(F.col("id") * 86400 / per_day)).alias("event_time"))
    return rows


def test_a_day_and_a_sensor_read_little_of_the_landing_table(spark, tmp_path):
    path, rows = str(tmp_path / "landing"), _readings(spark)
    write_landing(rows, path, row_group_rows=50)
    day = read_landing(spark, path, dt.date(2024, 1, 15))
    assert _rows_read(day) == 600 < 0.05 * rows.count()
    assert day.count() == rows.where("to_date(event_time) = '2024-01-15'").count() == 600
    one = read_landing(spark, path, dt.date(2024, 1, 15), sensors=["S3"])
    assert _rows_read(one) <= 200 and one.count() == 60  # row groups of 50, sorted by sensor
    assert sorted(map(tuple, read_landing(spark, path).collect())) == sorted(map(tuple, rows.collect()))


def test_landing_replaces_days_and_keeps_rows_without_time(spark, tmp_path):
    path = str(tmp_path / "landing")
    write_landing(_readings(spark, 3, 20), path)
    write_landing(_readings(spark, 1, 5).unionByName(_readings(spark, 1, 1).withColumn("event_time", F.lit(None).cast("timestamp"))), path)
    assert read_landing(spark, path, dt.date(2024, 1, 10)).count() == 5
    assert read_landing(spark, path, dt.date(2024, 1, 10), days=3).count() == 45
    assert read_landing(spark, path).count() == 46


@pytest.mark.parametrize("rows", [0, 1, 7, 500])
def test_positions_are_row_numbers(spark, rows):
    df = spark.range(rows).select((F.col("id") * 37 % 101).alias("k"), F.col("id").alias("v")).repartition(5)
    got = ops.with_positions(df, F.col("k").desc_nulls_last(), F.col("v"))
    want = sorted(((r.k, r.v) for r in df.collect()), key=lambda r: (-r[0], r[1]))
    assert [(r.k, r.v, r.position) for r in sorted(got.collect(), key=lambda r: r.position)] == [(*w, i + 1) for i, w in enumerate(want)]
    assert "Window" not in got._jdf.queryExecution().executedPlan().toString()


def test_positions_of_equal_and_null_rows(spark):
    df = spark.createDataFrame([("a",), (None,), ("a",), ("b",), ("a",)], "x string").repartition(3)
    got = sorted((r.position, r.x) for r in ops.with_positions(df, "x").collect())
    assert got == [(1, None), (2, "a"), (3, "a"), (4, "a"), (5, "b")]


def _peaks(spark, n):
    rows = [(dt.date(2024, 1, 10), f"J{i:05d}", T0 + dt.timedelta(hours=(i + 3) % 24), i, None if i % 50 == 3 else 14.5 + i, "NO") for i in range(n)]
    return spark.createDataFrame(rows, "report_date date, sensor_id string, peak_hour timestamp, vehicles_hour bigint, avg_speed_at_peak double, needs_intervention string")


@pytest.mark.parametrize("n", [0, 1, 700])
def test_a_report_is_one_file_with_the_text_of_a_pandas_export(spark, tmp_path, n):
    peaks = _peaks(spark, n).repartition(6)
    out = str(tmp_path)
    for _ in range(2):  # a rerun replaces it
        path = write_report_file(peaks, out, "peak", "2024-01-10", "sensor_id")
    assert path == report_path(out, "peak", "2024-01-10") and os.path.isfile(path)
    frame = peaks.toPandas().sort_values("sensor_id")
    with open(path, newline="") as f:
        assert f.read() == frame.to_csv(index=False)
    back = read_report(spark, out, "peak", "2024-01-10")
    assert sorted(map(str, back.collect())) == sorted(map(str, peaks.collect()))
    assert [p for p in os.listdir(out) if not p.startswith(".")] == [os.path.basename(path)]


def test_the_catalogue_knows_every_write(spark, tmp_path):
    out, day = str(tmp_path), dt.date(2024, 1, 10)
    assert read_catalogue(spark, out).count() == 0 and read_catalogued(spark, out, "peak") is None
    write_catalogued(_peaks(spark, 5), out, "peak", day, "sensor_id")
    write_catalogued(_peaks(spark, 9), out, "peak", day - dt.timedelta(days=1), "sensor_id")
    assert read_catalogued(spark, out, "peak").count() == 5  # the latest date, not the last write
    write_catalogued(_peaks(spark, 2), out, "peak", day, "sensor_id")
    write_catalogued(_peaks(spark, 0), out, "peak", day + dt.timedelta(days=2), "sensor_id")
    assert read_catalogue(spark, out).count() == 4
    assert read_catalogued(spark, out, "peak", day).count() == 2
    assert read_catalogued(spark, out, "peak").count() == 0  # the newest is empty
    assert read_catalogued(spark, out, "peak", day - dt.timedelta(days=3)) is None and read_catalogued(spark, out, "volume") is None


def test_a_report_replaces_a_folder_of_the_same_name(spark, tmp_path):
    os.makedirs(report_path(str(tmp_path), "peak", "2024-01-10"))
    path = write_report_file(_peaks(spark, 3), str(tmp_path), "peak", "2024-01-10", "sensor_id")
    assert os.path.isfile(path)
