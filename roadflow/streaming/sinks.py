"""Streaming sinks: Parquet (exactly-once file sink), Kafka, console."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from roadflow.operators.alerts import encode_alerts

AVAILABLE_NOW = "availableNow"


def _with_trigger(writer: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """``"availableNow"`` drains what is there and stops; anything else is a
    processing-time interval such as ``"1 minute"``."""
    if trigger is None:
        return writer
    if trigger == AVAILABLE_NOW:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=trigger)


def write_stream_parquet(df: DataFrame, path: str, checkpoint: str,
                         trigger: str | None = "1 minute",
                         partition_by: Sequence[str] | None = None,
                         query_name: str | None = None) -> StreamingQuery:
    """Append-mode Parquet sink with its own checkpoint (exactly-once via the
    sink's commit log). Aggregates need a watermark: a window is written once,
    when the watermark passes its end."""
    writer = (df.writeStream.format("parquet").outputMode("append")
              .option("path", path).option("checkpointLocation", checkpoint))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if query_name:
        writer = writer.queryName(query_name)
    return _with_trigger(writer, trigger).start()


def write_stream_kafka(alerts: DataFrame, topic: str = "critical-alerts",
                       checkpoint: str | None = None,
                       bootstrap_servers: str = "kafka:9092",
                       trigger: str | None = "5 seconds") -> StreamingQuery:
    """Each row as one JSON ``value`` to a Kafka topic (needs the Kafka connector)."""
    if checkpoint is None:
        raise ValueError("a Kafka sink needs its own checkpoint location")
    writer = (encode_alerts(alerts).writeStream.format("kafka")
              .option("kafka.bootstrap.servers", bootstrap_servers)
              .option("topic", topic)
              .option("checkpointLocation", checkpoint)
              .outputMode("append"))
    return _with_trigger(writer, trigger).start()


def write_stream_console(df: DataFrame, trigger: str | None = "30 seconds",
                         num_rows: int = 10, truncate: bool = False,
                         output_mode: str = "update",
                         checkpoint: str | None = None) -> StreamingQuery:
    """Console sink, update mode by default: rows changed in each batch."""
    writer = (df.writeStream.format("console").outputMode(output_mode)
              .option("truncate", str(truncate).lower())
              .option("numRows", str(num_rows)))
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    return _with_trigger(writer, trigger).start()
