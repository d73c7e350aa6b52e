"""Sinks: console (update mode), alert JSON encoding, report lookup dispatch."""

import datetime as dt
import json
import os

import pytest

from roadflow import operators as ops
from roadflow.sources import read_readings_stream, read_report
from roadflow.streaming import run_to_completion, write_stream_console, write_stream_kafka

READING = "sensor_id string, vehicle_count int, avg_speed double, event_time timestamp"


def test_encode_alerts_json(spark):
    t = dt.datetime(2026, 2, 1, 10, 0, 0, 123456)
    readings = spark.createDataFrame([("J1", 5, 3.5, t), ("J2", 6, 4.0, None)], READING)
    alerts = ops.detect_alerts(readings, alert_time=dt.datetime(2026, 2, 1, 10, 1))
    rows = [json.loads(r.value) for r in ops.encode_alerts(alerts).collect()]
    by_sensor = {r["sensor_id"]: r for r in rows}
    assert by_sensor["J1"]["detected_at"] == "2026-02-01T10:00:00.123Z"  # milliseconds only
    assert "detected_at" not in by_sensor["J2"]                          # NULL fields left out
    assert by_sensor["J1"]["reason"] == "avg_speed_below_10_kmph"
    assert set(by_sensor["J1"]) == {"alert_time", "detected_at", "sensor_id", "vehicle_count",
                                    "avg_speed", "reason"}


def test_console_sink_update_mode(spark, tmp_path):
    src = str(tmp_path / "in")
    os.makedirs(src)
    with open(os.path.join(src, "f.json"), "w") as f:
        f.write('{"sensor_id":"J1","timestamp":"2026-02-01T10:00:00+00:00",'
                '"vehicle_count":5,"avg_speed":9.5}\n')
    aggs = ops.aggregate_windows(read_readings_stream(spark, "text", path=src))
    q = write_stream_console(aggs, trigger="availableNow", checkpoint=str(tmp_path / "ckpt"))
    run_to_completion([q])
    progress = q.recentProgress
    assert progress and progress[0]["numInputRows"] == 1


def test_unknown_report_kind_is_empty(spark, tmp_path):
    with pytest.warns(UserWarning):
        df = read_report(spark, str(tmp_path), "no_such_report")
    assert df.count() == 0 and df.columns == []


def test_kafka_sink_needs_checkpoint(spark):

    readings = spark.createDataFrame([], READING)
    with pytest.raises(ValueError):
        write_stream_kafka(readings, "critical-alerts")


def test_kafka_source_without_connector_is_a_clear_error(spark):
    with pytest.raises(RuntimeError, match="spark-sql-kafka"):
        read_readings_stream(spark, "kafka", topic="traffic_raw")
