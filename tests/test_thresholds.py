"""thresholds, rounding and the scalar expressions (handmade rows)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from roadflow import operators as ops
from roadflow.functions import (
    alert_message,
    area_from_name,
    congestion_band,
    junction_status,
    speed_round,
)

READING = "sensor_id string, vehicle_count int, avg_speed double, event_time timestamp"
T0 = dt.datetime(2026, 2, 1, 10, 0)


def test_alert_threshold_is_strict_and_skips_null(spark):
    readings = spark.createDataFrame(
        [("J1", 1, 9.99, T0), ("J1", 1, 10.0, T0), ("J1", 1, None, T0)], READING)
    alerts = ops.detect_alerts(readings, alert_time=T0).collect()
    assert [a.avg_speed for a in alerts] == [9.99]
    a = alerts[0]
    assert (a.alert_time, a.detected_at, a.reason) == (T0, T0, "avg_speed_below_10_kmph")


def test_alert_time_defaults_to_processing_time(spark):
    readings = spark.createDataFrame([("J1", 1, 1.0, T0)], READING)
    row = ops.detect_alerts(readings).first()
    assert row.alert_time is not None and row.alert_time > T0 - dt.timedelta(days=365 * 10)


def test_congestion_index_and_zero_speed(spark):
    readings = spark.createDataFrame(
        [("J1", 2, 2.0, T0), ("J1", 3, 3.0, T0 + dt.timedelta(minutes=1)),
         ("J2", 4, 0.0, T0)], READING)
    rows = {r.sensor_id: r for r in ops.aggregate_windows(readings).collect()}
    assert rows["J1"].total_vehicles == 5 and rows["J1"].avg_speed_window == 2.5
    assert rows["J1"].congestion_index == 2.0
    assert rows["J1"].window_start == T0 and rows["J1"].window_end == T0 + dt.timedelta(minutes=5)
    assert rows["J2"].congestion_index is None


def test_window_is_half_open_and_null_time_dropped(spark):
    readings = spark.createDataFrame(
        [("J1", 1, 20.0, T0 + dt.timedelta(minutes=4, seconds=59, microseconds=999999)),
         ("J1", 1, 20.0, T0 + dt.timedelta(minutes=5)), ("J1", 1, 20.0, None)], READING)
    starts = sorted(r.window_start for r in ops.aggregate_windows(readings).collect())
    assert starts == [T0, T0 + dt.timedelta(minutes=5)]


def _hourly(spark, speeds):
    rows = [(dt.date(2024, 1, 10), f"J{i}", dt.datetime(2024, 1, 10, 8), 100, s)
            for i, s in enumerate(speeds, 1)]
    return spark.createDataFrame(
        rows, "report_date date, sensor_id string, hour timestamp, vehicles_hour bigint, "
              "avg_speed_hour double")


def test_intervention_uses_rounded_speed(spark):
    peaks = {r.sensor_id: r for r in ops.peak_hours(_hourly(spark, [14.99, 14.995, None])).collect()}
    assert (peaks["J1"].avg_speed_at_peak, peaks["J1"].needs_intervention) == (14.99, "YES")
    assert (peaks["J2"].avg_speed_at_peak, peaks["J2"].needs_intervention) == (15.0, "NO")
    assert peaks["J3"].needs_intervention == "NO"


def test_rounding_half_up(spark):
    df = spark.createDataFrame([(2.675,), (14.995,)], "x double")
    assert [r.r for r in df.select(speed_round("x").alias("r")).collect()] == [2.68, 15.0]


def test_status_bands(spark):
    df = spark.createDataFrame([(v,) for v in (14.99, 15.0, 24.99, 25.0, None)], "s double")
    got = [r.st for r in df.select(junction_status("s").alias("st")).collect()]
    assert got == ["Critical", "Warning", "Warning", "Normal", None]


def test_congestion_band_lower_bound_inclusive(spark):
    df = spark.createDataFrame([(v,) for v in (29.99, 30.0, 59.99, 60.0, 150.0, None)], "i double")
    got = [r.b for r in df.select(congestion_band("i").alias("b")).collect()]
    assert got == ["low", "medium", "medium", "high", "high", None]


def test_area_from_name(spark):
    df = spark.createDataFrame([("Colombo City Center",), ("Galle Face Junction",), ("Single",)],
                               "name string")
    assert [r.a for r in df.select(area_from_name("name").alias("a")).collect()] == \
        ["City", "Face", "Single"]


def test_alert_message_texts(spark):
    df = spark.createDataFrame([("Critical", 7.04), ("Warning", 20.0), ("Normal", 40.0)],
                               "status string, s double")
    got = [r.m for r in df.select(alert_message("status", "s").alias("m")).collect()]
    assert got == ["Speed critically low at 7.0 km/h", "Moderate congestion detected", None]


def test_peak_tie_goes_to_earliest_hour(spark):
    rows = [(dt.date(2024, 1, 10), "J5", dt.datetime(2024, 1, 10, h), 284, 30.0) for h in (9, 2)]
    hourly = spark.createDataFrame(
        rows, "report_date date, sensor_id string, hour timestamp, vehicles_hour bigint, "
              "avg_speed_hour double")
    assert ops.peak_hours(hourly).first().peak_hour == dt.datetime(2024, 1, 10, 2)


def test_hourly_mean_is_unweighted_and_exact(spark):
    aggs = spark.createDataFrame(
        [(dt.datetime(2024, 1, 8, 6, m), "J1", 1, s) for m, s in ((10, 28.93), (20, 24.24), (30, 22.655))],
        "window_start timestamp, sensor_id string, total_vehicles bigint, avg_speed_window double")
    row = ops.hourly_volumes(aggs).first()
    assert row.vehicles_hour == 3
    assert row.avg_speed_hour == 25.275
    assert ops.peak_hours(ops.hourly_volumes(aggs)).first().avg_speed_at_peak == 25.28


def test_time_range_selector(spark):
    df = spark.createDataFrame([(T0 - dt.timedelta(minutes=m),) for m in (0, 1, 59, 60, 61)],
                               "window_start timestamp")
    got = ops.filter_time_range(df, "window_start", "Last Hour", as_of=T0).count()
    assert got == 3  # [T0 - 1h, T0): 1, 59 and 60 minutes before
    assert ops.filter_time_range(df, "window_start", "All Time").count() == 5


def test_busiest_junction_tie_by_sensor(spark):
    peaks = spark.createDataFrame(
        [("J2", 10, T0), ("J1", 10, T0), ("J3", 9, T0)],
        "sensor_id string, vehicles_hour bigint, peak_hour timestamp")
    assert ops.busiest_junction(peaks).first().sensor_id == "J1"


def test_peak_range_is_seven_days_at_most(spark):
    peaks = spark.createDataFrame([(dt.date(2024, 1, d),) for d in range(1, 20)], "report_date date")
    got = ops.peak_hour_range(peaks, dt.date(2024, 1, 3), dt.date(2024, 1, 31)).count()
    assert got == 17  # the 3rd to the 19th: a range isn't cut to a week
    assert ops.peak_hour_range(peaks, dt.date(2024, 1, 3), dt.date(2024, 1, 4)).count() == 2


def test_pivot_of_named_and_of_all_sensors(spark):
    vol = spark.createDataFrame([(0, f"S{i}", 1 + i) for i in range(5)] + [(7, None, 9)],
                                "hour_of_day int, sensor_id string, total_volume bigint")
    assert ops.volume_pivot(vol, ["S1", "S4"]).collect()[0].asDict() == {"hour_of_day": 0, "S1": 2, "S4": 5}
    for width in (1, 2, 100):
        blocks = ops.volume_pivot_blocks(vol, width)
        names = {(r.block, r.column): r.sensor_id for r in blocks.dictionary.collect()}
        assert [names[divmod(k, width)] for k in range(6)] == [None, "S0", "S1", "S2", "S3", "S4"]
        cells = {(r.hour_of_day, names[r.block, k]): r[f"c{k}"] for r in blocks.cells.collect() for k in range(width) if r[f"c{k}"] is not None}
        assert cells == {(0, f"S{i}"): 1 + i for i in range(5)} | {(7, None): 9}
    assert blocks.block(0).columns == ["hour_of_day", "None", "S0", "S1", "S2", "S3", "S4"]
    empty = ops.volume_pivot_blocks(vol.limit(0))
    assert empty.cells.count() == 0 and empty.dictionary.count() == 0


def test_status_alert_selectors(spark):
    status = spark.createDataFrame(
        [(T0, "J1", 10, 7.0, 1.0), (T0, "J2", 10, 20.0, 1.0), (T0, "J3", 10, 40.0, 1.0)],
        "window_start timestamp, sensor_id string, total_vehicles bigint, avg_speed_window double, "
        "congestion_index double")
    st = ops.junction_status(status)
    assert ops.status_alerts(st).count() == 2
    assert [r.junction for r in ops.status_alerts(st, severity="Critical").collect()] == ["J1"]
    assert ops.status_alerts(st, junctions=["J3"]).count() == 0


def test_datetime_parameters_ignore_the_driver_zone(spark, monkeypatch):
    """Naive datetime parameters are wall-clock UTC, whatever the Python process's zone is.

    Checked inside Spark (formatted in the UTC session): collecting timestamps to
    Python would itself convert them to the process's zone.
    """
    import time

    monkeypatch.setenv("TZ", "Asia/Kathmandu")
    time.tzset()
    try:
        readings = spark.sql("select 'J1' as sensor_id, 1 as vehicle_count, 5.0d as avg_speed, "
                             "timestamp'2026-02-01 10:00:00' as event_time")
        alert = ops.detect_alerts(readings, alert_time=T0)
        text = alert.select(F.date_format("alert_time", "yyyy-MM-dd HH:mm:ss").alias("t")).first().t
        assert text == "2026-02-01 10:00:00"
        win = spark.sql("select timestamp'2026-02-01 09:30:00' as window_start")
        assert ops.filter_time_range(win, "window_start", "Last Hour", as_of=T0).count() == 1
    finally:
        monkeypatch.delenv("TZ")
        time.tzset()
