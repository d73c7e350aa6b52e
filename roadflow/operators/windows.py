"""Per-sensor tumbling-window aggregate with congestion index (AGG-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow import fixed
from roadflow.functions import congestion_index, exact_mean, mean_parts

_UNIT_MICROS = {"second": 1_000_000, "minute": 60_000_000, "hour": 3_600_000_000,
                "day": 86_400_000_000}


def _duration_micros(size: str) -> int:
    """'5 minutes' -> 300000000 (seconds, minutes, hours, days)."""
    n, unit = size.split()
    return int(n) * _UNIT_MICROS[unit.lower().rstrip("s")]


def _window_start(time_col: str, size: str) -> Column:
    """Epoch-aligned start of the tumbling window holding ``time_col``: the
    same boundaries as ``window()``, as one timestamp instead of a struct."""
    micros = F.unix_micros(F.col(time_col))
    return F.timestamp_micros(micros - F.pmod(micros, F.lit(_duration_micros(size))))


def window_parts(readings: DataFrame, size: str = fixed.WINDOW_DURATION,
                 time_col: str = "event_time") -> DataFrame:
    """Additive measures per window and sensor (``schemas.WINDOW_PARTS``) of a batch of readings."""
    rows = readings.where(F.col(time_col).isNotNull()).groupBy(_window_start(time_col, size).alias("window_start"), F.col("sensor_id")).agg(
        F.sum("vehicle_count").alias("total_vehicles"), *mean_parts("avg_speed", "speed"))
    end = (F.col("window_start") + F.expr(f"INTERVAL {size}")).alias("window_end")
    return rows.select("window_start", end, "sensor_id", "total_vehicles", "speed_sum", "speed_n", "speed_fit", "speed_plain")


def aggregate_windows(readings: DataFrame, size: str = fixed.WINDOW_DURATION,
                      time_col: str = "event_time") -> DataFrame:
    """(window_start, window_end, sensor_id, total_vehicles, avg_speed_window,
    congestion_index) per epoch-aligned ``[start, end)`` window and sensor.

    Batch: partial hash aggregate before the shuffle, so a hot sensor sends at
    most one partial row per window from each map task; the shuffle key is
    (window, sensor), which spreads a hot sensor over its many windows. The
    window is a plain timestamp key (cheaper to hash than the window struct).
    Streaming: ``window()`` keys the state, so the watermark can evict it;
    append mode emits a window once the watermark passes its end. Rows with
    a NULL event time belong to no window in either form.

    The window mean is exact (decimal sum, one division): a double sum depends
    on the order in which partial aggregates merge, so a mean of 15.0 could
    come out as 14.999999999999998 on one run and change the status, or a mean
    of 6.45 as 6.449999999999999 and round down.
    """
    measures = [F.sum("vehicle_count").alias("total_vehicles"),
                exact_mean("avg_speed").alias("avg_speed_window")]
    if readings.isStreaming:
        agg = (readings.groupBy(F.window(time_col, size).alias("window"), F.col("sensor_id"))
               .agg(*measures)
               .select(F.col("window.start").alias("window_start"),
                       F.col("window.end").alias("window_end"),
                       "sensor_id", "total_vehicles", "avg_speed_window"))
    else:
        agg = (readings.where(F.col(time_col).isNotNull())
               .groupBy(_window_start(time_col, size).alias("window_start"), F.col("sensor_id"))
               .agg(*measures)
               .select("window_start",
                       (F.col("window_start") + F.expr(f"INTERVAL {size}")).alias("window_end"),
                       "sensor_id", "total_vehicles", "avg_speed_window"))
    return agg.withColumn("congestion_index",
                          congestion_index("total_vehicles", "avg_speed_window"))
