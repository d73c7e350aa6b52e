"""DataFrame -> DataFrame operators. None of them triggers an action."""

from roadflow.operators.alerts import detect_alerts, encode_alerts, status_alerts
from roadflow.operators.daily import (
    busiest_junction,
    city_hourly_volume,
    daily_peaks,
    daily_summary,
    hourly_from_rollup,
    hourly_rollup,
    hourly_volumes,
    intervention_report,
    junction_volume_totals,
    page_recommendations,
    peak_hour_range,
    peak_hours,
    summary_from_rollup,
    volume_by_hour,
    volume_from_rollup,
    volume_heatmap,
    volume_pivot,
)
from roadflow.operators.live import (
    filter_junctions,
    filter_time_range,
    junction_map,
    junction_status,
    kpi_summary,
)
from roadflow.operators.ordering import with_positions
from roadflow.operators.pivot import PivotBlocks, volume_pivot_blocks
from roadflow.operators.windows import aggregate_windows, window_parts

__all__ = [
    "aggregate_windows", "detect_alerts", "encode_alerts", "status_alerts",
    "busiest_junction", "city_hourly_volume", "daily_peaks", "daily_summary", "hourly_from_rollup",
    "hourly_rollup", "hourly_volumes", "summary_from_rollup", "volume_from_rollup",
    "intervention_report", "junction_volume_totals", "page_recommendations", "peak_hour_range", "peak_hours",
    "volume_by_hour", "volume_heatmap", "volume_pivot", "filter_junctions",
    "filter_time_range", "junction_map", "junction_status", "kpi_summary", "window_parts",
    "with_positions", "PivotBlocks", "volume_pivot_blocks",
]
