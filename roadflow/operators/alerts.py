"""Low-speed alerts (stateless) and dashboard status alerts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow import fixed
from roadflow.functions import (
    alert_message,
    alert_recommendation,
    junction_status,
    timestamp_literal,
)
from roadflow.operators.live import filter_junctions, filter_time_range


def detect_alerts(readings: DataFrame, threshold: float = fixed.ALERT_SPEED_BELOW,
                  alert_time: dt.datetime | Column | None = None) -> DataFrame:
    """One alert per reading with ``avg_speed < threshold`` (strict; NULL speed none).

    Map-only: no state and no watermark, so late rows and rows with an
    unparsable time (``detected_at`` NULL) alert too. ``alert_time`` defaults
    to the processing time (constant within a micro-batch).
    """
    if alert_time is None:
        stamp = F.current_timestamp()
    elif isinstance(alert_time, Column):
        stamp = alert_time
    else:
        stamp = timestamp_literal(alert_time)
    return readings.where(F.col("avg_speed") < threshold).select(
        stamp.alias("alert_time"),
        F.col("event_time").alias("detected_at"),
        "sensor_id",
        "vehicle_count",
        "avg_speed",
        F.lit(fixed.ALERT_REASON).alias("reason"),
    )


def encode_alerts(alerts: DataFrame) -> DataFrame:
    """Whole row as one JSON ``value`` (NULL fields are left out, times in ms)."""
    return alerts.select(F.to_json(F.struct(*alerts.columns)).alias("value"))


def status_alerts(status: DataFrame, severity: str = "All", junctions=None,
                  time_range: str = "All Time", as_of=None) -> DataFrame:
    """Critical and Warning windows as alert rows (Normal rows give none).

    Selectors as in the dashboard: severity ("All" passes all), junction subset
    and time range (applied here; see filter_time_range).
    """
    if "status" not in status.columns:
        status = status.withColumn("status", junction_status())
    df = status.where(F.col("status").isin(fixed.STATUS_CRITICAL, fixed.STATUS_WARNING))
    if severity != "All":
        df = df.where(F.col("status") == severity)
    if junctions is not None:
        df = filter_junctions(df, junctions)
    df = filter_time_range(df, "window_start", time_range, as_of)
    return df.select(
        F.col("window_start").alias("ts"),
        F.col("sensor_id").alias("junction"),
        F.col("status").alias("severity"),
        alert_message("status", "avg_speed_window").alias("message"),
        F.col("total_vehicles").alias("vehicles"),
        F.col("avg_speed_window").alias("speed"),
        alert_recommendation("status").alias("recommendation"),
    )
