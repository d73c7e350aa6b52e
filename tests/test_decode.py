"""wire decoding of readings (handmade rows)."""

import datetime as dt

from roadflow.sources import decode_readings, encode_readings

ROWS = [
    '{"sensor_id":"J1","timestamp":"2026-02-01T10:00:00+00:00","vehicle_count":5,"avg_speed":9.5}',
    "not json",
    '{"sensor_id":"J1"}',
    '{"sensor_id":"J1","vehicle_count":5.5,"avg_speed":"x"}',
    '{"sensor_id":"J1","vehicle_count":7,"avg_speed":12,"extra":1}',
    None,
    '{"sensor_id":"J2","timestamp":"2026-02-01T10:00:00.123456+00:00","vehicle_count":1,"avg_speed":1.0}',
    '{"sensor_id":"J3","timestamp":"2026-02-01T10:00:00+05:30","vehicle_count":1,"avg_speed":1.0}',
    '{"sensor_id":"J4","timestamp":"bad-ts","vehicle_count":1,"avg_speed":1.0}',
]


def _decoded(spark):
    raw = spark.createDataFrame([(i, v) for i, v in enumerate(ROWS)], "i int, value string")
    return decode_readings(raw.coalesce(1)).collect()


def test_decode_rows(spark):
    rows = [tuple(r) for r in _decoded(spark)]
    t = dt.datetime(2026, 2, 1, 10, 0, 0)
    assert rows[0] == ("J1", 5, 9.5, t)
    assert rows[1] == (None, None, None, None)
    assert rows[2] == ("J1", None, None, None)
    assert rows[3] == ("J1", None, None, None)
    assert rows[4] == ("J1", 7, 12.0, None)
    assert rows[5] == (None, None, None, None)
    assert rows[6][3] == dt.datetime(2026, 2, 1, 10, 0, 0, 123456)
    assert rows[7][3] == dt.datetime(2026, 2, 1, 4, 30, 0)
    assert rows[8] == ("J4", 1, 1.0, None)


def test_decode_binary_payload(spark):
    raw = spark.createDataFrame([(bytearray(ROWS[0], "utf-8"),)], "value binary")
    assert tuple(decode_readings(raw).first()) == ("J1", 5, 9.5, dt.datetime(2026, 2, 1, 10))


def test_encode_decode_roundtrip_keeps_microseconds(spark):
    readings = spark.createDataFrame(
        [("J1", 3, 12.34, dt.datetime(2024, 1, 1, 0, 0, 7, 179575))],
        "sensor_id string, vehicle_count int, avg_speed double, event_time timestamp")
    wire = encode_readings(readings)
    text = wire.first().value
    assert '"timestamp":"2024-01-01T00:00:07.179575+00:00"' in text
    assert decode_readings(wire).collect() == readings.collect()
