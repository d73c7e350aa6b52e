"""Daily reports over the stored window aggregates (JOB-2, JOB-4)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from string import Formatter

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from roadflow import fixed
from roadflow.functions import (
    add_parts,
    exact_mean,
    in_peak_band,
    intervention_flag,
    mean_of_parts,
    mean_parts,
    speed_round,
)
from roadflow.operators.live import filter_junctions


def hourly_rollup(aggs: DataFrame) -> DataFrame:
    """Additive per (sensor, UTC hour) measures of the window aggregates.

    Every daily output is a roll-up of this table, so a day is scanned once:
    sums are exact (decimal), which makes means of means exact at any level. A value without an exact
    decimal (NaN, infinite, 1e20 and more) is counted as such and kept in a plain sum, so a group that holds
    one gets the plain mean, as in the direct operators.
    """
    hour = F.date_trunc("hour", F.col("window_start")).alias("hour")
    return aggs.groupBy("sensor_id", hour).agg(
        F.sum("total_vehicles").alias("vehicles"),
        *mean_parts("avg_speed_window", "speed"),
        *mean_parts("congestion_index", "index"),
        F.count(F.lit(1)).alias("windows"))


def hourly_from_rollup(rollup: DataFrame) -> DataFrame:
    return rollup.select(
        F.to_date("hour").alias("report_date"), "sensor_id", "hour",
        F.col("vehicles").alias("vehicles_hour"),
        mean_of_parts("speed").alias("avg_speed_hour"))


def volume_from_rollup(rollup: DataFrame) -> DataFrame:
    """volume_by_hour from the hourly roll-up (same values, no rescan)."""
    merged = rollup.groupBy("sensor_id", F.hour("hour").alias("hour_of_day")).agg(
        F.sum("vehicles").alias("total_volume"), *add_parts("speed"), F.sum("windows").alias("sample_count"))
    return merged.select("sensor_id", "hour_of_day", "total_volume", mean_of_parts("speed").alias("avg_speed"), "sample_count")


def summary_from_rollup(rollup: DataFrame) -> DataFrame:
    """daily_summary from the hourly roll-up (same values, no rescan)."""
    merged = rollup.agg(F.sum("vehicles").alias("total_vehicles"), *add_parts("index"), F.sum("windows").alias("windows"))
    return merged.select("total_vehicles", mean_of_parts("index").alias("avg_congestion_index"),
                         F.coalesce("windows", F.lit(0)).cast("bigint").alias("window_count"))


def hourly_volumes(aggs: DataFrame) -> DataFrame:
    """Per (sensor, UTC hour): summed vehicles and the *unweighted* mean of the
    window means (AGG-2; kept unweighted on purpose). ``report_date`` is the
    hour's date, so several days can be processed in one pass."""
    return _hourly(aggs.withColumn("report_date", F.to_date("window_start")))


def _hourly(dated: DataFrame) -> DataFrame:
    hour = F.date_trunc("hour", F.col("window_start")).alias("hour")
    return dated.groupBy("report_date", "sensor_id", hour).agg(
        F.sum("total_vehicles").alias("vehicles_hour"),
        exact_mean("avg_speed_window").alias("avg_speed_hour"))


def daily_peaks(aggs: DataFrame,
                intervention_below: float = fixed.INTERVENTION_SPEED_BELOW) -> DataFrame:
    """Peak hour per (day, sensor) from window aggregates, with one shuffle.

    The window rows are hash-partitioned once by (report_date, sensor_id);
    the hourly aggregate (keys include both) and the peak window (partitioned
    by both) then run without further exchanges. A (day, sensor) group holds
    at most 288 window rows, so the partitioning cannot skew.
    """
    dated = aggs.withColumn("report_date", F.to_date("window_start")) \
        .repartition("report_date", "sensor_id")
    return peak_hours(_hourly(dated), intervention_below)


def peak_hours(hourly: DataFrame,
               intervention_below: float = fixed.INTERVENTION_SPEED_BELOW) -> DataFrame:
    """Busiest hour per (report_date, sensor); ties go to the earliest hour.

    ``row_number() = 1`` directly over the window lets Catalyst insert a
    partial WindowGroupLimit before the shuffle, so each map task ships at most
    one row per group. The intervention flag is tested on the rounded speed.
    """
    w = Window.partitionBy("report_date", "sensor_id") \
        .orderBy(F.col("vehicles_hour").desc(), F.col("hour").asc())
    top = hourly.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1)
    rounded = speed_round("avg_speed_hour", 2)
    return top.select(
        "report_date",
        "sensor_id",
        F.col("hour").alias("peak_hour"),
        "vehicles_hour",
        rounded.alias("avg_speed_at_peak"),
        intervention_flag(rounded, intervention_below).alias("needs_intervention"),
    )


def peak_hour_range(peaks: DataFrame, start: dt.date, end: dt.date) -> DataFrame:
    """The daily peak reports from ``start`` to ``end``, both included.

    On a ``report_date``-partitioned table this is one partition-pruned scan;
    a missing day contributes no rows.
    """
    return peaks.where(F.col("report_date").between(F.lit(start), F.lit(end)))


def volume_by_hour(aggs: DataFrame, ordered: bool = True) -> DataFrame:
    """Hour-of-day profile per sensor: volume, mean window speed, window count."""
    vol = aggs.groupBy("sensor_id", F.hour("window_start").alias("hour_of_day")).agg(
        F.sum("total_vehicles").alias("total_volume"),
        exact_mean("avg_speed_window").alias("avg_speed"),
        F.count(F.lit(1)).alias("sample_count"))
    return vol.orderBy("sensor_id", "hour_of_day") if ordered else vol


def volume_pivot(vol: DataFrame, sensors: Sequence[str], ordered: bool = True) -> DataFrame:
    """hour_of_day x sensor table of summed volume for the named ``sensors``; a missing cell is NULL.

    Names are columns, so they are the caller's; for all sensors of a table, however many, see ``volume_pivot_blocks``.
    """
    piv = vol.groupBy("hour_of_day").pivot("sensor_id", list(sensors)).agg(F.sum("total_volume"))
    return piv.orderBy("hour_of_day") if ordered else piv


def volume_heatmap(vol: DataFrame, junctions: Iterable[str] | None = None,
                   hours: Iterable[int] = range(24)) -> DataFrame:
    """sensor x hour-of-day volume matrix, columns h00..h23."""
    df = filter_junctions(vol, junctions) if junctions is not None else vol
    hours = list(hours)
    piv = df.groupBy("sensor_id").pivot("hour_of_day", hours).agg(F.sum("total_volume"))
    return piv.select("sensor_id", *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])


def city_hourly_volume(vol: DataFrame, band_low: int = fixed.PEAK_BAND_LOW,
                       band_high: int = fixed.PEAK_BAND_HIGH) -> DataFrame:
    """City-wide volume per hour of day, flagged when inside the peak band."""
    city = vol.groupBy("hour_of_day").agg(F.sum("total_volume").alias("total_volume"))
    return city.withColumn("in_peak_band", in_peak_band("total_volume", band_low, band_high))


def junction_volume_totals(vol: DataFrame) -> DataFrame:
    """Per junction: summed volume and mean of the hourly mean speeds."""
    return vol.groupBy("sensor_id").agg(F.sum("total_volume").alias("total_volume"),
                                        exact_mean("avg_speed").alias("avg_speed"))


def daily_summary(aggs: DataFrame) -> DataFrame:
    """One row: total vehicles, mean congestion index (NULLs skipped), window count."""
    return aggs.agg(F.sum("total_vehicles").alias("total_vehicles"),
                    exact_mean("congestion_index").alias("avg_congestion_index"),
                    F.count(F.lit(1)).alias("window_count"))


def busiest_junction(peaks: DataFrame) -> DataFrame:
    """Top-1 junction by peak volume; ties go to the smaller sensor id."""
    return (peaks.orderBy(F.col("vehicles_hour").desc(), F.col("sensor_id").asc())
            .limit(1).select("sensor_id", "vehicles_hour", "peak_hour"))


def intervention_report(peaks: DataFrame, only_required: bool = False) -> DataFrame:
    """Recommendation per junction peak; ``only_required`` keeps the YES rows."""
    if only_required:
        peaks = peaks.where(F.col("needs_intervention") == fixed.INTERVENTION_YES)
    yes = F.col("needs_intervention") == fixed.INTERVENTION_YES
    return peaks.select(
        "report_date",
        "sensor_id",
        "peak_hour",
        "vehicles_hour",
        "avg_speed_at_peak",
        F.when(yes, F.lit(fixed.ACTION_YES)).otherwise(F.lit(fixed.ACTION_NO)).alias("action"),
        F.when(yes, F.lit(fixed.SPEED_LABEL_YES)).otherwise(F.lit(fixed.SPEED_LABEL_NO))
        .alias("speed_label"),
        F.when(yes, F.concat(F.lit(fixed.DEPLOY_PREFIX),
                             F.date_format("peak_hour", "yyyy-MM-dd HH:mm:ss")))
        .alias("recommendation"),
    )


def page_recommendations(peaks: DataFrame) -> DataFrame:
    """The report page's text per junction that needs police: sensor_id, peak_hour, text (lines joined by newlines)."""
    rows = peaks.where(F.col("needs_intervention") == fixed.INTERVENTION_YES)
    values = {"sensor_id": F.col("sensor_id"), "peak_hour": F.date_format("peak_hour", "yyyy-MM-dd HH:mm:ss"),
              "vehicles_hour": F.col("vehicles_hour").cast("string"), "avg_speed_at_peak": F.col("avg_speed_at_peak").cast("string")}
    parts = []
    for literal, name, _, _ in Formatter().parse("\n".join(fixed.PAGE_LINES)):
        parts += [F.lit(literal)] + ([values[name]] if name else [])
    return rows.select("report_date", "sensor_id", "peak_hour", F.concat(*parts).alias("text"))
