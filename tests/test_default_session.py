"""The checked queries in a session with default SQL settings (as a driver's own
session would be): default time zone, 200 shuffle partitions, default state store."""

import pytest

import __spark_entry__ as entry
from roadflow.plans.check import compare, duckdb_connection
from roadflow.plans.registry import reset_stored

from sf_paths import SF_SMALL

NAMES = ["peak_hour_daily", "window_agg_stream", "daily_peak_report", "status_alerts",
         "live_kpi_last_24h"]


@pytest.fixture(scope="module")
def fresh(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.session.timeZone", "America/Los_Angeles")
    session.conf.unset("spark.sql.shuffle.partitions")
    session.conf.unset("spark.sql.streaming.stateStore.providerClass")
    reset_stored()
    yield session
    reset_stored()


@pytest.mark.parametrize("name", NAMES)
def test_query_in_default_session(fresh, name):
    got = entry.queries()[name](fresh, SF_SMALL).toPandas()
    want = duckdb_connection(SF_SMALL).execute(entry.oracle_sql()[name]).df()
    res = compare(got, want)
    assert res["ok"], res


def test_session_left_in_utc_with_its_other_settings(fresh):
    entry.entry(fresh).collect()
    assert fresh.conf.get("spark.sql.session.timeZone") == "UTC"
    assert fresh.conf.get("spark.sql.shuffle.partitions") == "200"
