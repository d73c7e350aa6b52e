"""Physical-plan checks: pushdown, pruning, no Python in the plan, top-k shapes."""

import pytest

from roadflow.plans.registry import QUERIES as REGISTERED

from sf_paths import SF_SMALL

QUERIES = dict(REGISTERED)
DAY_QUERIES = ["hourly_volumes", "peak_hour_daily", "volume_by_hour", "volume_pivot",
               "volume_heatmap", "city_hourly_volume", "junction_volume_totals", "daily_summary",
               "busiest_junction", "intervention_report", "peak_hour_range"]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan(fn(spark, SF_SMALL)) for name, fn in QUERIES.items()}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_in_plan(plans, name):
    for node in ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas"):
        assert node not in plans[name]


@pytest.mark.parametrize("name", DAY_QUERIES)
def test_day_bound_reaches_the_scan(plans, name):
    p = plans[name]
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in p
    assert "LessThan(ts," in p


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_events_scan_is_column_pruned(plans, name):
    p = plans[name]
    if "events.parquet" in p:
        assert ("event_id" in p) == (name == "rollup_odd_speeds") and "event_type" not in p


def test_peak_uses_group_limit_and_two_shuffles(plans):
    p = plans["peak_hour_daily"]
    assert "WindowGroupLimit" in p
    # window aggregate + one (report_date, sensor_id) co-partitioning; the hourly
    # aggregate and the peak window reuse it
    assert p.count("Exchange hashpartitioning") == 2


def test_dimension_join_is_broadcast(plans):
    assert "BroadcastHashJoin" in plans["junction_map"]
    assert "SortMergeJoin" not in plans["junction_map"]


def test_top1_is_take_ordered(plans):
    assert "TakeOrderedAndProject" in plans["busiest_junction"]


def test_pivot_values_given_two_phase(plans):
    assert "pivotfirst" in plans["volume_pivot"].lower()


def test_window_aggregate_is_partial_before_shuffle(plans):
    p = plans["window_agg"]
    assert "partial_sum" in p and "partial_count" in p
    assert p.index("Exchange") < p.index("partial_sum")  # partial aggregate sits below the shuffle
