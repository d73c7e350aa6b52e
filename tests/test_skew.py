"""A sensor holding all rows (derived from the events table) still spreads over reducers."""

import pytest
from pyspark.sql import functions as F

from roadflow import operators as ops
from roadflow.plans.registry import _readings

from sf_paths import SF_ORACLE


@pytest.fixture(scope="module")
def no_coalesce(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    session.conf.set("spark.sql.shuffle.partitions", "8")
    return session


def test_hot_sensor_spreads_over_shuffle_partitions(no_coalesce):
    hot = _readings(no_coalesce, SF_ORACLE).withColumn("sensor_id", F.lit("J1"))  # one key, all rows
    aggs = ops.aggregate_windows(hot)
    sizes = [r["n"] for r in aggs.groupBy(F.spark_partition_id().alias("p"))
             .agg(F.count(F.lit(1)).alias("n")).collect()]
    assert len(sizes) == 8
    assert max(sizes) <= 1.5 * (sum(sizes) / len(sizes))
    # nothing is dropped: every reading lands in exactly one window
    assert aggs.agg(F.sum("total_vehicles")).first()[0] == hot.agg(F.sum("vehicle_count")).first()[0]


def test_hot_sensor_peak_groups_stay_bounded(no_coalesce):
    hot = _readings(no_coalesce, SF_ORACLE).withColumn("sensor_id", F.lit("J1"))
    aggs = ops.aggregate_windows(hot)
    per_group = aggs.groupBy(F.to_date("window_start"), "sensor_id").count()
    assert per_group.agg(F.max("count")).first()[0] <= 288  # windows per (day, sensor)
    peaks = ops.daily_peaks(aggs)
    assert peaks.count() == per_group.count()
