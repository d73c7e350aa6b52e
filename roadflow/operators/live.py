"""Live-view tables over window aggregates (JOB-3): status, KPIs, map points."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow import fixed
from roadflow.functions import (
    area_from_name,
    congestion_band,
    delta_from_reference,
    exact_mean,
    junction_status as status_expr,
    marker_size,
    timestamp_literal,
)


def filter_junctions(df: DataFrame, junctions: Iterable[str], col: str = "sensor_id") -> DataFrame:
    return df.where(F.col(col).isin(list(junctions)))


def filter_time_range(df: DataFrame, col: str, name: str = "All Time",
                      as_of: dt.datetime | Column | None = None) -> DataFrame:
    """Dashboard range selector: [as_of - range, as_of); "All Time" passes all.

    ``as_of`` defaults to the query's current timestamp.
    """
    if name not in fixed.TIME_RANGES:
        raise ValueError(f"unknown time range {name!r}; one of {list(fixed.TIME_RANGES)}")
    span = fixed.TIME_RANGES[name]
    if span is None:
        return df
    if as_of is None:
        end = F.current_timestamp()
    elif isinstance(as_of, Column):
        end = as_of
    else:
        end = timestamp_literal(as_of)  # wall clock in the session zone, not the driver's
    start = end - F.expr(f"INTERVAL {span}")
    return df.where((F.col(col) >= start) & (F.col(col) < end))


def junction_status(aggs: DataFrame) -> DataFrame:
    """Window aggregates + status, congestion band and delta from the reference line."""
    return aggs.select(
        "*",
        status_expr("avg_speed_window").alias("status"),
        congestion_band("congestion_index").alias("congestion_band"),
        delta_from_reference("congestion_index").alias("delta_from_ref"),
    )


def kpi_summary(status: DataFrame) -> DataFrame:
    """One row of dashboard KPIs (apply filter_time_range first for "last hour")."""
    if "status" not in status.columns:
        status = status.withColumn("status", status_expr("avg_speed_window"))
    return status.agg(
        F.sum("total_vehicles").alias("total_vehicles"),
        exact_mean("avg_speed_window").alias("avg_speed"),
        F.count_if(F.col("status") == fixed.STATUS_CRITICAL).alias("critical_count"),
        exact_mean("congestion_index").alias("congestion_index"),
    )


def junction_map(status: DataFrame, dim: DataFrame | None = None) -> DataFrame:
    """Map points: windows joined to the junction dimension (unknown sensors dropped).

    The built-in dimension has 4 rows, so it is broadcast. A caller's own
    dimension gets no hint: Spark broadcasts it only below
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise sort-merge joins.
    """
    if dim is None:
        from roadflow.sources.tables import junction_dim
        dim = F.broadcast(junction_dim(status.sparkSession))
    if "status" not in status.columns:
        status = status.withColumn("status", status_expr("avg_speed_window"))
    joined = status.join(dim, "sensor_id", "inner")
    return joined.select(
        "window_start",
        "sensor_id",
        "lat",
        "lon",
        "name",
        area_from_name("name").alias("area"),
        F.col("total_vehicles").alias("vehicles"),
        F.col("avg_speed_window").alias("speed"),
        "status",
        marker_size("congestion_index").alias("size"),
    )
