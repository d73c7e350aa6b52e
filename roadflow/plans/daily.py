"""The daily batch job over the stored window aggregates (JOB-2)."""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow import operators as ops
from roadflow.session import checkpoint_root, use_utc
from roadflow.sinks import write_daily, write_report_file
from roadflow.sources import read_window_aggs


@dataclass
class DailyOutputs:
    day: DataFrame
    hourly: DataFrame
    peak: DataFrame
    volume: DataFrame
    pivot: DataFrame
    summary: DataFrame
    busiest: DataFrame
    interventions: DataFrame


def yesterday_utc() -> dt.date:
    """The day a scheduled run reports on: UTC today minus one day."""
    return dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)


def run_daily(spark: SparkSession, run_date: dt.date | None, in_path: str, out_path: str,
              sensors: list[str] | None = None, write: bool = True) -> DailyOutputs:
    """Reports for one UTC day from the stored aggregate table.

    One partition-pruned scan of the day builds the additive hourly roll-up
    (at most sensors x 24 rows), which is checkpointed to the shared checkpoint folder and stored beside
    the reports (``hourly_rollup``); hourly volumes, the hour-of-day profile and the summary are exact
    roll-ups of it, so the day is read once and a lost executor recomputes
    nothing upstream. ``plans.rollup.range_reports`` reports any range of days from the stored roll-up. Outputs are idempotent: exactly the ``report_date`` partition of the run
    is replaced in each Parquet table, also by an empty day, and each report file is replaced.

    Run it at least 15 minutes after midnight UTC: the last windows of the day
    are written by the stream only once the watermark passes them.
    """
    run_date = run_date or yesterday_utc()
    use_utc(spark)
    day = read_window_aggs(spark, in_path, run_date)
    checkpoint_root(spark)
    rollup = ops.hourly_rollup(day).checkpoint()
    hourly = ops.hourly_from_rollup(rollup)
    volume = ops.volume_from_rollup(rollup)
    summary = ops.summary_from_rollup(rollup).withColumn("report_date", F.lit(run_date))

    peak = ops.peak_hours(hourly)
    # hour x sensor only for sensors the caller names; sensor x hour is as wide for any number of them
    pivot = ops.volume_pivot(volume, sensors) if sensors is not None else ops.volume_heatmap(volume)
    busiest = ops.busiest_junction(peak)
    interventions = ops.intervention_report(peak)

    if write:
        reports = os.path.join(out_path, "reports")
        write_daily(rollup, os.path.join(out_path, "hourly_rollup"), day=run_date)
        write_daily(peak, os.path.join(out_path, "daily_peak_hour"), day=run_date)
        write_daily(summary, os.path.join(out_path, "daily_summary"), day=run_date)
        write_daily(interventions, os.path.join(out_path, "intervention_report"), day=run_date)
        # Report CSVs: one file each at any size, rows ordered as in the reference
        write_report_file(peak, reports, "peak", run_date, "sensor_id")
        write_report_file(volume, reports, "volume", run_date, "sensor_id", "hour_of_day")
        write_report_file(pivot, reports, "pivot", run_date, "hour_of_day" if sensors is not None else "sensor_id")
    return DailyOutputs(day, hourly, peak, volume, pivot, summary, busiest, interventions)
