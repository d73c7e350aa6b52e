"""watermark, append-mode emission and late data; stateless alerts.

One JSON file and one ``availableNow`` run per step, same checkpoint.
"""

import datetime as dt
import json
import os

from roadflow import operators as ops
from roadflow.sources import read_readings_stream
from roadflow.streaming import StreamConfig, run_streaming, run_to_completion, write_stream_parquet

DAY = "2026-02-01"


def _line(t, vehicles, speed=30.0, sensor="J1"):
    stamp = t if t == "bad-ts" else f"{DAY}T{t}+00:00"
    return json.dumps({"sensor_id": sensor, "timestamp": stamp, "vehicle_count": vehicles,
                       "avg_speed": speed})


def _drop(folder, name, lines):
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(lines) + "\n")


def _ts(t):
    h, m = t.split(":")[:2]
    return dt.datetime(2026, 2, 1, int(h), int(m))


class Stream:
    def __init__(self, spark, tmp_path, max_files=None):
        self.spark = spark
        self.src = str(tmp_path / "in")
        self.out = str(tmp_path / "out")
        self.ckpt = str(tmp_path / "ckpt")
        self.max_files = max_files
        os.makedirs(self.src)

    def run(self):
        readings = read_readings_stream(self.spark, "text", path=self.src,
                                        max_files_per_trigger=self.max_files)
        q = write_stream_parquet(ops.aggregate_windows(readings), self.out, self.ckpt,
                                 trigger="availableNow")
        run_to_completion([q])
        return q

    def emitted(self):
        if not os.path.exists(os.path.join(self.out, "_spark_metadata")):
            return []
        df = self.spark.read.parquet(self.out)
        return sorted((r.window_start, r.total_vehicles) for r in df.collect())


def test_late_data_trace(spark, tmp_path):
    s = Stream(spark, tmp_path)
    _drop(s.src, "f0.json", [_line("10:01:00", 10), _line("10:05:00", 1)])
    s.run()
    assert s.emitted() == []

    _drop(s.src, "f1.json", [_line("10:20:00", 7)])
    s.run()
    assert s.emitted() == [(_ts("10:00"), 10), (_ts("10:05"), 1)]

    _drop(s.src, "f2.json", [_line("10:02:00", 99), _line("10:09:59", 98), _line("10:10:00", 50)])
    q = s.run()
    assert s.emitted() == [(_ts("10:00"), 10), (_ts("10:05"), 1)]
    dropped = sum(op["numRowsDroppedByWatermark"] for p in q.recentProgress
                  for op in p.get("stateOperators", []))
    assert dropped == 2

    _drop(s.src, "f3.json", [_line("10:40:00", 2)])
    s.run()
    assert s.emitted() == [(_ts("10:00"), 10), (_ts("10:05"), 1), (_ts("10:10"), 50),
                           (_ts("10:20"), 7)]


def test_late_row_right_after_advance_is_merged(spark, tmp_path):
    s = Stream(spark, tmp_path, max_files=1)
    _drop(s.src, "f0.json", [_line("10:01:00", 10), _line("10:04:59.999", 20), _line("10:05:00", 1)])
    _drop(s.src, "f1.json", [_line("10:21:00", 7)])
    _drop(s.src, "f2.json", [_line("10:02:00", 99)])
    _drop(s.src, "f3.json", [_line("10:40:00", 2)])
    s.run()
    got = dict(s.emitted())
    assert got[_ts("10:00")] == 129


def test_alerts_are_stateless(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "alerts")
    os.makedirs(src)
    _drop(src, "f0.json", [_line("10:30:00", 5, 30.0)])
    _drop(src, "f1.json", [_line("10:02:00", 5, 3.0), _line("10:08:00", 5, 9.0),
                           _line("bad-ts", 5, 4.0), _line("10:31:00", 5, 10.0)])
    cfg = StreamConfig(checkpoint_dir=str(tmp_path / "ckpt"), alert_paths=[out], source="text",
                       source_path=src, alert_trigger="availableNow", max_files_per_trigger=1)
    run_to_completion(run_streaming(spark, cfg))
    rows = spark.read.parquet(out).collect()
    assert sorted(r.avg_speed for r in rows) == [3.0, 4.0, 9.0]
    assert sum(r.detected_at is None for r in rows) == 1
    assert all(r.alert_time is not None and r.reason == "avg_speed_below_10_kmph" for r in rows)


def test_run_streaming_writes_date_partitioned_aggregates(spark, tmp_path):
    src = str(tmp_path / "in")
    os.makedirs(src)
    _drop(src, "f0.json", [_line("10:01:00", 3), _line("23:59:00", 4), _line("23:59:30", 1)])
    agg_out = str(tmp_path / "agg")
    cfg = StreamConfig(checkpoint_dir=str(tmp_path / "ckpt"), agg_paths=[agg_out], source="text",
                       source_path=src, agg_trigger="availableNow", sink_files=1,
                       source_options={"maxFilesPerTrigger": "1"})
    run_to_completion(run_streaming(spark, cfg))
    assert os.path.isdir(os.path.join(agg_out, "window_date=2026-02-01"))
    rows = spark.read.parquet(agg_out).collect()
    # watermark = 23:59:30 - 10 min: the 10:00 window is out, 23:55 still open
    assert [(r.window_start, r.total_vehicles) for r in rows] == [(_ts("10:00"), 3)]
    day = os.path.join(agg_out, "window_date=2026-02-01")
    assert len([f for f in os.listdir(day) if f.endswith(".parquet")]) == 1


def test_mirror_copies_committed_output(spark, tmp_path):
    src = str(tmp_path / "in")
    os.makedirs(src)
    _drop(src, "f0.json", [_line("10:01:00", 3), _line("10:06:00", 4), _line("10:40:00", 1)])
    agg, alerts = str(tmp_path / "agg"), str(tmp_path / "alerts")
    cfg = StreamConfig(checkpoint_dir=str(tmp_path / "ckpt"), agg_paths=[agg], alert_paths=[alerts],
                       source="text", source_path=src, agg_trigger="availableNow",
                       alert_trigger="availableNow")
    run_to_completion(run_streaming(spark, cfg))
    # second run: mirrors only (the primaries have nothing new to do)
    cfg.agg_mirrors, cfg.alert_mirrors = [str(tmp_path / "agg_copy")], [str(tmp_path / "alerts_copy")]
    cfg.mirror_trigger = "availableNow"
    run_to_completion(run_streaming(spark, cfg))
    for a, b in ((agg, cfg.agg_mirrors[0]), (alerts, cfg.alert_mirrors[0])):
        left, right = spark.read.parquet(a), spark.read.parquet(b)
        assert sorted(left.collect()) == sorted(right.select(*left.columns).collect())
    assert os.path.isdir(os.path.join(cfg.agg_mirrors[0], "window_date=2026-02-01"))
    assert spark.read.parquet(agg).count() == 2


def test_await_any_termination_returns_when_a_query_ends(spark, tmp_path):
    from roadflow.streaming import await_any_termination

    src = str(tmp_path / "in")
    os.makedirs(src)
    _drop(src, "f0.json", [_line("10:01:00", 3, 5.0)])
    cfg = StreamConfig(checkpoint_dir=str(tmp_path / "ckpt"), alert_paths=[str(tmp_path / "a")],
                       source="text", source_path=src, alert_trigger="availableNow")
    spark.streams.resetTerminated()
    queries = run_streaming(spark, cfg)
    await_any_termination(spark, queries, timeout_s=120)
    assert not queries[0].isActive
    spark.streams.resetTerminated()


def test_mirrors_start_before_the_primary_has_written(spark, tmp_path):
    src = str(tmp_path / "in")
    os.makedirs(src)
    _drop(src, "f0.json", [_line("10:01:00", 3, 5.0), _line("10:40:00", 1)])
    agg, copy = str(tmp_path / "agg"), str(tmp_path / "agg_copy")
    cfg = StreamConfig(checkpoint_dir=str(tmp_path / "ckpt"), agg_paths=[agg], agg_mirrors=[copy],
                       source="text", source_path=src, agg_trigger="availableNow",
                       mirror_trigger="availableNow")
    run_to_completion(run_streaming(spark, cfg))   # the copy may see nothing yet: no error
    run_to_completion(run_streaming(spark, cfg))   # now it catches up
    assert sorted(spark.read.parquet(copy).collect()) == sorted(spark.read.parquet(agg).collect())


def test_shared_schemas_are_not_mutated(spark, tmp_path):
    from roadflow.schemas import WINDOW_AGG

    before = list(WINDOW_AGG.fieldNames())
    cfg = StreamConfig(checkpoint_dir=str(tmp_path / "ckpt"), agg_paths=[str(tmp_path / "a")],
                       agg_mirrors=[str(tmp_path / "b")], source="text",
                       source_path=str(tmp_path), agg_trigger="availableNow",
                       mirror_trigger="availableNow")
    run_to_completion(run_streaming(spark, cfg))
    assert WINDOW_AGG.fieldNames() == before


def test_parquet_payload_source(spark, tmp_path):
    from roadflow.plans.registry import _readings
    from roadflow.sources import encode_readings

    landed = str(tmp_path / "landed")
    readings = _readings(spark, "/root/testdata/sf0.001")
    encode_readings(readings).write.parquet(landed)
    stream = read_readings_stream(spark, "parquet", path=landed, watermark=None)
    out = str(tmp_path / "decoded")
    q = stream.writeStream.format("parquet").option("path", out) \
        .option("checkpointLocation", str(tmp_path / "ckpt")).trigger(availableNow=True).start()
    run_to_completion([q])
    assert sorted(spark.read.parquet(out).collect()) == sorted(readings.collect())


def test_one_drain_completes_the_copies(spark, tmp_path):
    from roadflow.streaming import drain

    src = str(tmp_path / "in")
    os.makedirs(src)
    _drop(src, "f0.json", [_line("10:01:00", 3, 5.0), _line("10:40:00", 1)])
    agg, alerts = str(tmp_path / "agg"), str(tmp_path / "alerts")
    drain(spark, StreamConfig(checkpoint_dir=str(tmp_path / "ckpt"), agg_paths=[agg], alert_paths=[alerts],
                              agg_mirrors=[agg + "_copy"], alert_mirrors=[alerts + "_copy"],
                              source="text", source_path=src))
    for path, n in ((agg, 1), (alerts, 1)):
        left, right = spark.read.parquet(path), spark.read.parquet(path + "_copy")
        assert left.count() == n and sorted(left.collect()) == sorted(right.collect())


def test_processing_time_trigger_and_update_mode(spark, tmp_path):
    """STR-5, STR-7: every batch hands over the windows it changed; a table keyed by window keeps the last."""
    src = str(tmp_path / "in")
    os.makedirs(src)
    _drop(src, "f0.json", [_line("10:01:00", 3), _line("10:06:00", 4)])
    seen = []
    aggs = ops.aggregate_windows(read_readings_stream(spark, "text", path=src))
    q = (aggs.writeStream.outputMode("update").trigger(processingTime="1 second")
         .option("checkpointLocation", str(tmp_path / "ckpt"))
         .foreachBatch(lambda df, n: seen.append((n, {r.window_start: r.total_vehicles for r in df.collect()})))
         .start())
    try:
        q.processAllAvailable()
        _drop(src, "f1.json", [_line("10:02:00", 5)])
        q.processAllAvailable()
    finally:
        q.stop()
    changed = [rows for _, rows in seen if rows]
    assert changed[0] == {_ts("10:00"): 3, _ts("10:05"): 4}
    assert changed[-1] == {_ts("10:00"): 8}


def test_failed_query_stops_the_others(spark, tmp_path):
    import pytest
    from roadflow.streaming import await_any_termination

    src = str(tmp_path / "in")
    os.makedirs(src)
    _drop(src, "f0.json", [_line("10:01:00", 3, 5.0)])
    spark.streams.resetTerminated()
    readings = read_readings_stream(spark, "text", path=src)
    good = write_stream_parquet(ops.detect_alerts(readings), str(tmp_path / "a"), str(tmp_path / "ca"), trigger="1 second")

    def fail(df, n):
        raise ValueError("planned")

    bad = readings.writeStream.option("checkpointLocation", str(tmp_path / "cb")).foreachBatch(fail).start()
    with pytest.raises(RuntimeError, match="failed"):
        await_any_termination(spark, [good, bad], timeout_s=120)
    assert not good.isActive and not bad.isActive
    spark.streams.resetTerminated()
