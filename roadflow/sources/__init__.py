"""Sources: reading streams, stored aggregate tables, report files, dimensions."""

from roadflow.sources.landing import read_landing, write_landing
from roadflow.sources.readings import (
    decode_readings,
    encode_readings,
    read_readings_stream,
    readings_from_events,
    with_event_time,
)
from roadflow.sources.tables import junction_dim, read_report, read_window_aggs

__all__ = [
    "read_landing", "write_landing",
    "decode_readings", "encode_readings", "read_readings_stream", "readings_from_events",
    "with_event_time", "junction_dim", "read_report", "read_window_aggs",
]
