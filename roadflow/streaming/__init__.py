"""Structured Streaming sinks and the streaming job."""

from roadflow.streaming.fanout import AppendSink, KafkaSink, Ledger, ShowSink, UpsertSink, fan_out, read_appended, read_upserted
from roadflow.streaming.jobs import (
    StreamConfig,
    await_any_termination,
    drain,
    mirror_stream,
    run_streaming,
    run_to_completion,
)
from roadflow.streaming.sinks import (
    write_stream_console,
    write_stream_kafka,
    write_stream_parquet,
)

__all__ = [
    "AppendSink", "KafkaSink", "Ledger", "ShowSink", "UpsertSink", "fan_out", "read_appended", "read_upserted",
    "StreamConfig", "await_any_termination", "drain", "mirror_stream", "run_streaming", "run_to_completion", "write_stream_console",
    "write_stream_kafka", "write_stream_parquet",
]
