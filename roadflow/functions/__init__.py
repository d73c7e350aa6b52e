"""Column expressions (built-ins only, codegen-friendly)."""

from roadflow.functions.traffic import (
    add_parts,
    alert_message,
    alert_recommendation,
    area_from_name,
    congestion_band,
    congestion_index,
    delta_from_reference,
    exact_mean,
    exact_ratio,
    exact_sum,
    in_peak_band,
    intervention_flag,
    junction_status,
    marker_size,
    mean_of_parts,
    mean_parts,
    speed_round,
    timestamp_literal,
)

__all__ = [
    "add_parts", "alert_message", "alert_recommendation", "area_from_name", "congestion_band",
    "congestion_index", "delta_from_reference", "exact_mean", "exact_ratio", "exact_sum", "in_peak_band", "intervention_flag",
    "junction_status", "marker_size", "mean_of_parts", "mean_parts", "speed_round", "timestamp_literal",
]
