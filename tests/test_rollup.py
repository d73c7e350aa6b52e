"""The stored additive roll-up equals the direct operators, whatever the values and the range (JOB-2, AGG-2, -3, -8, SET-1)."""

import datetime as dt
import math

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from roadflow import operators as ops
from roadflow.plans import range_reports, run_daily, store_rollup
from roadflow.schemas import WINDOW_AGG
from roadflow.session import matching_paths

DAY = dt.date(2024, 1, 10)
T0 = dt.datetime(2024, 1, 10)
ODD = [float("nan"), float("inf"), float("-inf"), 1e25, -1e25, 1e20, 0.0, None]


def _aggs(spark, rows):
    """Window aggregates from (window number, sensor, vehicles, speed, index)."""
    full = [(T0 + dt.timedelta(minutes=5 * w), T0 + dt.timedelta(minutes=5 * w + 5), s, v, speed, index) for w, s, v, speed, index in rows]
    return spark.createDataFrame(full, WINDOW_AGG)


def _same(a, b):
    if a is None or b is None or isinstance(a, (str, int, dt.date)):
        return a == b
    return math.isnan(a) and math.isnan(b) or a == b or math.isclose(a, b, rel_tol=1e-12)


def _equal(got, want):
    got, want = (sorted((tuple(r) for r in df.collect()), key=str) for df in (got, want))
    key = lambda r: tuple(str(x) for x in r if not isinstance(x, float))
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert all(_same(a, b) for a, b in zip(g, w)), (g, w)


speeds = st.one_of(st.sampled_from(ODD), st.floats(0, 120).map(lambda x: round(x, 2)))
rows = st.lists(st.tuples(st.integers(0, 40), st.sampled_from(["J1", "J2"]), st.integers(0, 50), speeds, speeds), max_size=25,
                unique_by=lambda r: (r[0], r[1]))


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows)
def test_rollup_equals_the_direct_operators(spark, rows):
    aggs = _aggs(spark, rows)
    rollup = ops.hourly_rollup(aggs)
    hourly = ops.hourly_volumes(aggs)
    _equal(ops.hourly_from_rollup(rollup).select(*hourly.columns), hourly)
    _equal(ops.volume_from_rollup(rollup), ops.volume_by_hour(aggs, ordered=False))
    _equal(ops.summary_from_rollup(rollup), ops.daily_summary(aggs))
    _equal(ops.peak_hours(ops.hourly_from_rollup(rollup)), ops.daily_peaks(aggs))


def test_a_bad_reading_sends_no_police(spark, tmp_path):
    """One hour with window speeds {NaN, 20}: its mean is NaN and the flag NO, in the direct form and in the daily job."""
    aggs = _aggs(spark, [(0, "J1", 5, float("nan"), float("nan")), (1, "J1", 5, 20.0, 0.25)])
    aggs.withColumn("window_date", aggs.window_start.cast("date")).write.partitionBy("window_date").parquet(str(tmp_path / "agg"))
    assert [r.needs_intervention for r in ops.daily_peaks(aggs).collect()] == ["NO"]
    for write in (True, False):
        out = run_daily(spark, DAY, str(tmp_path / "agg"), str(tmp_path / "out"), write=write)
        peak = out.peak.first()
        assert math.isnan(peak.avg_speed_at_peak) and peak.needs_intervention == "NO"
        assert math.isnan(out.summary.first().avg_congestion_index)


def test_ranges_come_from_the_stored_rollup(spark, tmp_path):
    """Days are replaced as a whole; a day that has lost its windows loses its roll-up; reports read the roll-up only."""
    table, rollup = str(tmp_path / "agg"), str(tmp_path / "rollup")

    def store(rows, days):
        aggs = _aggs(spark, rows)
        aggs.withColumn("window_date", aggs.window_start.cast("date")).write.mode("overwrite").partitionBy("window_date").parquet(table)
        store_rollup(spark, table, rollup, DAY, days)

    many = [(w, s, w % 7, 10.0 + w % 50, None if w % 9 == 0 else w / 8) for w in range(0, 288 * 3, 11) for s in ("J1", "J2")]
    store(many, 3)
    aggs = _aggs(spark, many)
    end = DAY + dt.timedelta(days=2)
    reports = range_reports(spark, rollup, DAY, end)
    _equal(reports.volume, ops.volume_by_hour(aggs, ordered=False))
    _equal(reports.summary, ops.daily_summary(aggs))
    _equal(reports.peaks, ops.daily_peaks(aggs))
    plan = reports.volume._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(report_date" in plan
    assert all("/rollup/report_date=" in f for f in reports.volume.inputFiles())  # never the windows
    # the second day has no windows any more; days outside the range stay as they are
    fewer = [r for r in many if not 288 <= r[0] < 576]
    store(fewer, 2)
    assert {p.rsplit("=", 1)[1] for p in matching_paths(spark, f"{rollup}/report_date=*")} == {"2024-01-10", "2024-01-12"}
    _equal(range_reports(spark, rollup, DAY, end).summary, ops.daily_summary(_aggs(spark, fewer)))
    # one day, and an empty one
    store(many, 3)
    store_rollup(spark, table, rollup, DAY + dt.timedelta(days=9))
    _equal(range_reports(spark, rollup, DAY, DAY).summary, ops.daily_summary(_aggs(spark, [r for r in many if r[0] < 288])))
    none = range_reports(spark, rollup, DAY + dt.timedelta(days=9), DAY + dt.timedelta(days=9))
    assert none.volume.count() == 0 and none.summary.first().window_count == 0


@pytest.mark.parametrize("value", [1e25, float("inf"), float("nan")])
def test_a_value_without_a_decimal_only_touches_its_group(spark, value):
    aggs = _aggs(spark, [(0, "J1", 1, value, 1.0), (0, "J2", 1, 0.1, 1.0), (1, "J2", 1, 0.2, 1.0)])
    got = {r.sensor_id: r.avg_speed_hour for r in ops.hourly_from_rollup(ops.hourly_rollup(aggs)).collect()}
    assert _same(got["J1"], value) and got["J2"] == 0.15
