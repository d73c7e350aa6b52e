"""Live view and report feed: the dashboard's data work as Spark jobs (JOB-3, JOB-4)."""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow import fixed
from roadflow import operators as ops
from roadflow.schemas import PEAK
from roadflow.session import use_utc
from roadflow.sinks import write_report_csv
from roadflow.sources import read_report, read_window_aggs

_UNITS = {"hour": 3600, "hours": 3600, "day": 86400, "days": 86400}


def _span(name: str) -> dt.timedelta | None:
    text = fixed.TIME_RANGES[name]
    if text is None:
        return None
    n, unit = text.split()
    return dt.timedelta(seconds=int(n) * _UNITS[unit])


@dataclass
class LiveView:
    status: DataFrame
    kpis: DataFrame
    map: DataFrame
    alerts: DataFrame


def live_view(spark: SparkSession, agg_path: str, as_of: dt.datetime | None = None,
              time_range: str = "Last Hour", junctions: Sequence[str] | None = None,
              severity: str = "All") -> LiveView:
    """Status, KPIs, map points and status alerts over the stored aggregates.

    The time range is applied (the reference collects it but never filters)
    and bounds the scan: only the ``window_date`` partitions it covers are read.
    """
    use_utc(spark)
    span = _span(time_range)
    if span is None:
        aggs = read_window_aggs(spark, agg_path, missing_ok=True)
    else:
        as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        first = (as_of - span).date()
        aggs = read_window_aggs(spark, agg_path, first, (as_of.date() - first).days + 1,
                                missing_ok=True)
        aggs = ops.filter_time_range(aggs, "window_start", time_range, as_of)
    if junctions is not None:
        aggs = ops.filter_junctions(aggs, junctions)
    status = ops.junction_status(aggs)
    return LiveView(status=status, kpis=ops.kpi_summary(status), map=ops.junction_map(status),
                    alerts=ops.status_alerts(status, severity=severity))


@dataclass
class ReportFeed:
    peak: DataFrame
    weekly: DataFrame
    volume: DataFrame
    pivot: DataFrame
    heatmap: DataFrame
    city: DataFrame
    totals: DataFrame
    interventions: DataFrame


def report_feed(spark: SparkSession, out_path: str, run_date: dt.date,
                start: dt.date | None = None, end: dt.date | None = None,
                junctions: Sequence[str] | None = None,
                sensors: Sequence[str] | None = None) -> ReportFeed:
    """Report pages over the daily job's outputs (see plans.daily.run_daily).

    ``weekly`` is the peaks from ``start`` to ``end`` (default: the 7 days up
    to ``run_date``), read as one partition-pruned scan of the peak table.
    """
    use_utc(spark)
    reports = os.path.join(out_path, "reports")
    peak = read_report(spark, reports, "peak", run_date)
    volume = read_report(spark, reports, "volume", run_date)
    start = start or run_date - dt.timedelta(days=6)
    end = end or run_date
    table = os.path.join(out_path, "daily_peak_hour")
    weekly = ops.peak_hour_range(spark.read.parquet(table), start, end).select(*PEAK.fieldNames())
    return ReportFeed(
        peak=peak,
        weekly=weekly.withColumn("date", F.col("report_date")),
        volume=volume,
        pivot=ops.volume_pivot(volume, sensors) if sensors is not None else ops.volume_heatmap(volume),
        heatmap=ops.volume_heatmap(volume, junctions),
        city=ops.city_hourly_volume(volume),
        totals=ops.junction_volume_totals(volume),
        interventions=ops.intervention_report(peak),
    )


def write_weekly_report(weekly: DataFrame, out_dir: str, start: dt.date, end: dt.date) -> str:
    """CSV export of the weekly peak table: ``weekly_peak_hours_<start>_to_<end>.csv``, a stem of its own,
    so that the export never counts as a day's peak report."""
    rows = weekly.select(*PEAK.fieldNames())
    return write_report_csv(rows.orderBy("report_date", "sensor_id"), out_dir, "weekly",
                            f"{start}_to_{end}")
