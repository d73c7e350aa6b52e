"""report files; the daily job end to end (stored table -> reports), idempotence."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from roadflow import operators as ops
from roadflow.plans import run_daily
from roadflow.plans.registry import q_peak_hour_daily
from roadflow.sinks import write_report_csv
from roadflow.sources import read_report, read_window_aggs
from roadflow.streaming import StreamConfig, run_streaming, run_to_completion

from sf_paths import SF_SMALL

HEADER = "report_date,sensor_id,peak_hour,vehicles_hour,avg_speed_at_peak,needs_intervention\n"


def _write(folder, name, sensor):
    with open(os.path.join(folder, name), "w") as f:
        f.write(HEADER + f"2024-01-15,{sensor},2024-01-15 08:00:00,100,12.5,YES\n")


@pytest.fixture()
def report_dir(tmp_path):
    d = str(tmp_path / "reports")
    os.makedirs(d)
    _write(d, "peak_hour_report_2024-01-14.csv", "J14")
    _write(d, "a_peak_hour_report_2024-01-15.csv", "A15")
    _write(d, "peak_hour_report_2024-01-15.csv", "J15")
    return d


def test_greatest_matching_path_wins(spark, report_dir):
    rows = read_report(spark, report_dir, "peak", "2024-01-15").collect()
    assert [r.sensor_id for r in rows] == ["J15"]
    assert rows[0].peak_hour == dt.datetime(2024, 1, 15, 8)
    assert rows[0].report_date == dt.date(2024, 1, 15)


def test_unknown_date_is_empty_with_schema(spark, report_dir):
    with pytest.warns(UserWarning, match="no peak_hour_report report found"):
        df = read_report(spark, report_dir, "peak", "2030-01-01")
    assert df.count() == 0
    assert df.columns[:3] == ["report_date", "sensor_id", "peak_hour"]


def test_yesterday_default(spark, tmp_path):
    yesterday = dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)
    d = str(tmp_path / "r")
    os.makedirs(d)
    _write(d, f"peak_hour_report_{yesterday}.csv", "JY")
    _write(d, "peak_hour_report_2000-01-01.csv", "OLD")
    assert [r.sensor_id for r in read_report(spark, d, "peak", "yesterday").collect()] == ["JY"]


def test_required_report_missing_raises(spark, report_dir):
    with pytest.raises(FileNotFoundError):
        read_report(spark, report_dir, "volume", required=True)


def test_undated_lookup_takes_greatest(spark, report_dir):
    rows = read_report(spark, report_dir, "peak", required=True).collect()
    assert [r.sensor_id for r in rows] == ["J15"]


def test_csv_written_by_spark_reads_back(spark, tmp_path):
    peaks = q_peak_hour_daily(spark, SF_SMALL)
    out = str(tmp_path / "r")
    write_report_csv(peaks, out, "peak", "2024-01-10", num_files=1)
    path = os.path.join(out, "peak_hour_report_2024-01-10.csv")
    parts = [p for p in os.listdir(path) if p.endswith(".csv")]
    assert len(parts) == 1
    with open(os.path.join(path, parts[0])) as f:
        text = f.read()
    assert text.startswith(HEADER) and "2024-01-10 " in text and "T" not in text.split("\n")[1]
    back = read_report(spark, out, "peak", "2024-01-10")
    assert sorted(back.collect()) == sorted(peaks.withColumn("peak_hour", peaks.peak_hour.cast("timestamp")).collect())


@pytest.fixture(scope="module")
def stored_aggs(spark, tmp_path_factory):
    """The stream job run over the sf0.001 events: a date-partitioned aggregate table."""
    base = tmp_path_factory.mktemp("stream")
    cfg = StreamConfig(checkpoint_dir=str(base / "ckpt"), agg_paths=[str(base / "agg")],
                       source="events", source_path=SF_SMALL, source_glob="events.parquet",
                       agg_trigger="availableNow")
    run_to_completion(run_streaming(spark, cfg))
    return str(base / "agg")


def test_read_window_aggs_prunes_partitions(spark, stored_aggs):
    day = read_window_aggs(spark, stored_aggs, dt.date(2024, 1, 10))
    plan = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(window_date" in plan
    assert "GreaterThanOrEqual(window_start" in plan
    assert day.count() > 0
    assert {r.d for r in day.selectExpr("to_date(window_start) d").distinct().collect()} == \
        {dt.date(2024, 1, 10)}


def test_missing_table_is_a_clear_error(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="not found"):
        read_window_aggs(spark, str(tmp_path / "nope"), dt.date(2024, 1, 10))


def test_run_daily_matches_query_and_is_idempotent(spark, stored_aggs, tmp_path):
    out = str(tmp_path / "daily")
    day = dt.date(2024, 1, 10)
    first = run_daily(spark, day, stored_aggs, out)
    run_daily(spark, day, stored_aggs, out)
    table = spark.read.parquet(os.path.join(out, "daily_peak_hour"))
    assert table.count() == first.peak.count() == 5
    want = q_peak_hour_daily(spark, SF_SMALL).drop("report_date")
    got = table.drop("report_date").withColumn("peak_hour", table.peak_hour.cast("timestamp_ntz"))
    assert sorted(got.collect()) == sorted(want.collect())
    reports = os.path.join(out, "reports")
    assert sorted(p for p in os.listdir(reports) if not p.startswith(".")) == [
        "peak_hour_report_2024-01-10.csv", "traffic_volume_pivot_2024-01-10.csv",
        "traffic_volume_vs_time_2024-01-10.csv"]
    vol = read_report(spark, reports, "volume", day)
    assert vol.count() == first.volume.count()
    summary = spark.read.parquet(os.path.join(out, "daily_summary")).collect()
    assert len(summary) == 1 and summary[0].window_count == first.day.count()


def test_run_daily_other_day_keeps_first(spark, stored_aggs, tmp_path):
    out = str(tmp_path / "daily2")
    run_daily(spark, dt.date(2024, 1, 10), stored_aggs, out)
    run_daily(spark, dt.date(2024, 1, 11), stored_aggs, out)
    dates = {r.report_date for r in spark.read.parquet(os.path.join(out, "daily_peak_hour"))
             .select("report_date").distinct().collect()}
    assert dates == {dt.date(2024, 1, 10), dt.date(2024, 1, 11)}


def test_empty_day_gives_empty_reports(spark, stored_aggs, tmp_path):
    out = str(tmp_path / "d3")
    res = run_daily(spark, dt.date(2030, 1, 1), stored_aggs, out)
    assert res.peak.count() == 0
    assert read_report(spark, os.path.join(out, "reports"), "peak", "2030-01-01").count() == 0
    stored = spark.read.parquet(os.path.join(out, "daily_summary")).first()
    assert stored.window_count == 0 and stored.total_vehicles is None
    row = res.summary.first()
    assert row.total_vehicles is None and row.window_count == 0
    assert ops.busiest_junction(res.peak).count() == 0


def test_live_view_and_report_feed(spark, stored_aggs, tmp_path):
    from roadflow.plans import live_view, report_feed, write_weekly_report

    out = str(tmp_path / "daily4")
    for d in (9, 10):
        run_daily(spark, dt.date(2024, 1, d), stored_aggs, out)
    lv = live_view(spark, stored_aggs, as_of=dt.datetime(2024, 1, 10, 12), time_range="Last 24 Hours")
    windows = lv.status.collect()
    assert windows and all(dt.datetime(2024, 1, 9, 12) <= r.window_start < dt.datetime(2024, 1, 10, 12)
                           for r in windows)
    plan = lv.status._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    kpi = lv.kpis.first()
    assert kpi.total_vehicles == sum(r.total_vehicles for r in windows)
    assert kpi.critical_count == sum(r.status == "Critical" for r in windows)
    assert lv.map.count() == sum(r.sensor_id != "J5" for r in windows)
    assert lv.alerts.count() == sum(r.status in ("Critical", "Warning") for r in windows)

    feed = report_feed(spark, out, dt.date(2024, 1, 10), junctions=["J1", "J2"])
    assert feed.peak.count() == 5
    assert {r.report_date for r in feed.weekly.collect()} == {dt.date(2024, 1, 9), dt.date(2024, 1, 10)}
    assert feed.heatmap.count() == 2 and len(feed.heatmap.columns) == 25
    assert feed.pivot.count() == 5  # one row per sensor, whatever their number
    named = report_feed(spark, out, dt.date(2024, 1, 10), sensors=["J1", "J2", "J3", "J4", "J5"])
    assert named.pivot.count() == feed.city.count()
    assert feed.totals.agg(F.sum("total_volume")).first()[0] == \
        feed.volume.agg(F.sum("total_volume")).first()[0]
    path = write_weekly_report(feed.weekly, str(tmp_path / "export"), dt.date(2024, 1, 4), dt.date(2024, 1, 10))
    assert path.endswith("weekly_peak_hours_2024-01-04_to_2024-01-10.csv")
    assert spark.read.option("header", "true").csv(path).count() == 10


def test_rollup_outputs_equal_direct_operators(spark, stored_aggs):
    day = read_window_aggs(spark, stored_aggs, dt.date(2024, 1, 10))
    rollup = ops.hourly_rollup(day)
    assert sorted(ops.hourly_from_rollup(rollup).collect()) == sorted(ops.hourly_volumes(day).collect())
    assert sorted(ops.volume_from_rollup(rollup).collect()) == \
        sorted(ops.volume_by_hour(day, ordered=False).collect())
    assert ops.summary_from_rollup(rollup).collect() == ops.daily_summary(day).collect()


def test_cli_daily_job(spark, stored_aggs, tmp_path):
    from roadflow import cli

    out = str(tmp_path / "cli")
    cli.main(["daily", "--in", stored_aggs, "--out", out, "--run-date", "2024-01-10"])
    assert spark.read.parquet(os.path.join(out, "daily_peak_hour")).count() == 5


def test_live_view_before_first_write_is_empty(spark, tmp_path):
    from roadflow.plans import live_view

    lv = live_view(spark, str(tmp_path / "not_yet"), time_range="All Time")
    assert lv.status.count() == 0 and lv.kpis.first().critical_count == 0


def _batch_alert_count(spark):
    from roadflow.plans.registry import q_congestion_alerts

    return q_congestion_alerts(spark, SF_SMALL).count()


def test_cli_stream_backfill_then_daily(spark, tmp_path):
    from roadflow import cli

    agg, out = str(tmp_path / "agg"), str(tmp_path / "daily")
    cli.main(["stream", "--checkpoint-dir", str(tmp_path / "ckpt"), "--source", "events",
              "--source-path", SF_SMALL, "--source-glob", "events.parquet", "--agg-path", agg, "--alert-path", str(tmp_path / "alerts"),
              "--sink-files", "2", "--available-now"])
    cli.main(["daily", "--in", agg, "--out", out, "--run-date", "2024-01-10"])
    got = spark.read.parquet(os.path.join(out, "daily_peak_hour")).drop("report_date")
    want = q_peak_hour_daily(spark, SF_SMALL).drop("report_date")
    got = got.withColumn("peak_hour", got.peak_hour.cast("timestamp_ntz"))
    assert sorted(got.collect()) == sorted(want.collect())
    alerts = spark.read.parquet(str(tmp_path / "alerts"))
    assert alerts.count() == _batch_alert_count(spark) and alerts.where("detected_at is null").count() == 0


def test_empty_newest_report_stays_the_newest(spark, tmp_path):
    d = str(tmp_path / "r")
    os.makedirs(d)
    _write(d, "peak_hour_report_2024-01-10.csv", "OLD")
    with open(os.path.join(d, "peak_hour_report_2024-01-11.csv"), "w") as f:
        f.write(HEADER)
    assert read_report(spark, d, "peak").count() == 0


def test_weekly_export_does_not_shadow_a_day(spark, stored_aggs, tmp_path):
    from roadflow.plans import report_feed, write_weekly_report

    out = str(tmp_path / "shadow")
    for d in (9, 10):
        run_daily(spark, dt.date(2024, 1, d), stored_aggs, out)
    feed = report_feed(spark, out, dt.date(2024, 1, 10))
    reports = os.path.join(out, "reports")
    write_weekly_report(feed.weekly, reports, dt.date(2024, 1, 10), dt.date(2024, 1, 16))
    days = {r.report_date for r in read_report(spark, reports, "peak", "2024-01-10").collect()}
    assert days == {dt.date(2024, 1, 10)}


def test_rerun_of_a_day_that_became_empty_leaves_no_rows(spark, stored_aggs, tmp_path):
    out, day = str(tmp_path / "stale"), dt.date(2024, 1, 10)
    run_daily(spark, day, stored_aggs, out)
    run_daily(spark, dt.date(2024, 1, 9), stored_aggs, out)
    empty = str(tmp_path / "empty")
    spark.read.parquet(stored_aggs).where("false").write.parquet(empty)
    run_daily(spark, day, empty, out)
    for table in ("daily_peak_hour", "intervention_report"):
        days = {r.report_date for r in spark.read.parquet(os.path.join(out, table)).collect()}
        assert days == {dt.date(2024, 1, 9)}
    summary = spark.read.parquet(os.path.join(out, "daily_summary")).where(F.col("report_date") == F.lit(day))
    assert [r.window_count for r in summary.collect()] == [0]


def test_written_report_is_in_order(spark, stored_aggs, tmp_path):
    """SRT-1, SNK-7: the report is one file, its rows by sensor and hour."""
    out = str(tmp_path / "ordered")
    run_daily(spark, dt.date(2024, 1, 10), stored_aggs, out)
    with open(os.path.join(out, "reports", "traffic_volume_vs_time_2024-01-10.csv")) as f:
        rows = [line.split(",")[:2] for line in f.read().splitlines()[1:]]
    keys = [(s, int(h)) for s, h in rows]
    assert keys and keys == sorted(keys)
