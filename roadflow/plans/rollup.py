"""A stored additive roll-up: one row per (sensor, hour), from which any range of days is reported (JOB-2, SET-1).

The table is partitioned by ``report_date`` and holds sums and counts only (``operators.hourly_rollup``), so
reports over any range merge its rows and never read the windows again. A day is replaced as a whole, also by an
empty day.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow import operators as ops
from roadflow.schemas import HOURLY_ROLLUP
from roadflow.session import delete_path, matching_paths, use_utc
from roadflow.sinks import write_daily
from roadflow.sources import read_window_aggs

REPORT_DATE = "report_date"


@dataclass
class RangeReports:
    hourly: DataFrame
    peaks: DataFrame
    volume: DataFrame
    summary: DataFrame


def store_rollup(spark: SparkSession, in_path: str, rollup_path: str, day: dt.date, days: int = 1) -> None:
    """Roll up ``days`` UTC days of the aggregate table from ``day`` on: one pruned scan, one job. The days' partitions
    are replaced; a day without windows has none."""
    use_utc(spark)
    rollup = ops.hourly_rollup(read_window_aggs(spark, in_path, day, days))
    if days == 1:
        write_daily(rollup, rollup_path, day=day)
        return
    wanted = {str(day + dt.timedelta(days=k)) for k in range(days)}
    before = {p.rsplit("=", 1)[1]: p for p in matching_paths(spark, f"{rollup_path}/{REPORT_DATE}=*")}
    dated = rollup.withColumn(REPORT_DATE, F.to_date("hour"))
    write_daily(dated.hint("rebalance", REPORT_DATE), rollup_path)
    stale = wanted & before.keys()
    if stale:
        for date in stale - {str(r[0]) for r in dated.select(REPORT_DATE).distinct().collect()}:  # at most ``days`` dates
            delete_path(spark, before[date])


def read_rollup(spark: SparkSession, rollup_path: str, start: dt.date, end: dt.date) -> DataFrame:
    """The roll-up rows of the days from ``start`` to ``end``, both included: one partition-pruned scan."""
    rows = spark.read.schema(HOURLY_ROLLUP).parquet(rollup_path)
    return rows.where(F.col(REPORT_DATE).between(F.lit(start), F.lit(end)))


def range_reports(spark: SparkSession, rollup_path: str, start: dt.date, end: dt.date) -> RangeReports:
    """Hourly volumes, daily peaks, hour-of-day profile and summary of a range of days, from the roll-up alone."""
    use_utc(spark)
    rollup = read_rollup(spark, rollup_path, start, end)
    hourly = ops.hourly_from_rollup(rollup)
    return RangeReports(hourly, ops.peak_hours(hourly), ops.volume_from_rollup(rollup), ops.summary_from_rollup(rollup))
