"""Reading streams: wire decoding, event-time watermark, and the events adapter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow import fixed
from roadflow.functions import timestamp_literal
from roadflow.schemas import EVENTS, READING_JSON

# Wire format of the event time: ISO-8601 with microseconds and a numeric
# offset, e.g. 2026-02-01T10:00:00.123456+00:00.
WIRE_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSxxx"


def decode_readings(raw: DataFrame, value_col: str = "value") -> DataFrame:
    """Bytes/text JSON payload -> (sensor_id, vehicle_count, avg_speed, event_time).

    Malformed JSON gives an all-NULL row, a bad field only that field NULL, and
    an unparsable time a NULL event_time (``try_cast``: under ANSI a plain cast
    would fail the whole streaming query). Works on batch and streaming input.
    """
    data = F.from_json(F.col(value_col).cast("string"), READING_JSON).alias("data")
    return raw.select(data).select(
        F.col("data.sensor_id").alias("sensor_id"),
        F.col("data.vehicle_count").alias("vehicle_count"),
        F.col("data.avg_speed").alias("avg_speed"),
        F.col("data.timestamp").try_cast(T.TimestampType()).alias("event_time"),
    )


def encode_readings(readings: DataFrame) -> DataFrame:
    """Readings -> one JSON ``value`` per row, in the producer's wire format."""
    payload = F.struct(
        F.col("sensor_id"),
        F.date_format("event_time", WIRE_TIME_FORMAT).alias("timestamp"),
        F.col("vehicle_count"),
        F.col("avg_speed"),
    )
    return readings.select(F.to_json(payload).alias("value"))


def with_event_time(readings: DataFrame, delay: str = fixed.WATERMARK_DELAY,
                    time_col: str = "event_time") -> DataFrame:
    """Event-time watermark; a no-op for batch plans."""
    return readings.withWatermark(time_col, delay)


def time_range(df: DataFrame, col: str, start, end) -> DataFrame:
    """Half-open [start, end) on a raw timestamp column, typed so it pushes down."""
    dtype = df.schema[col].dataType
    if start is not None:
        df = df.where(F.col(col) >= timestamp_literal(start, dtype))
    if end is not None:
        df = df.where(F.col(col) < timestamp_literal(end, dtype))
    return df


def readings_from_events(events: DataFrame, start: dt.date | dt.datetime | None = None,
                         end: dt.date | dt.datetime | None = None,
                         sensor: Column | None = None, keep: list[str] | None = None) -> DataFrame:
    """Map the driver's ``events`` table onto readings (FIXTURES.md, F0).

    sensor_id = 'J' || (user_id % 5 + 1) unless ``sensor`` says otherwise; event_time = ts; vehicle_count =
    props.k; avg_speed = round(value % 60, 2). ``start``/``end`` bound ``ts``
    before any cast so the range reaches the Parquet reader as PushedFilters. ``keep``: columns of ``events`` that stay.
    """
    events = time_range(events, "ts", start, end)
    if sensor is None:
        sensor = F.concat(F.lit("J"), (F.col("user_id") % 5 + 1).cast("string"))
    return events.select(
        sensor.alias("sensor_id"),
        F.get_json_object("props", "$.k").cast("int").alias("vehicle_count"),
        F.round(F.col("value") % 60, 2).alias("avg_speed"),
        F.col("ts").cast(T.TimestampType()).alias("event_time"),
        *(keep or []),
    )


def read_readings_stream(spark: SparkSession, source: str = "kafka", *,
                         path: str | None = None, topic: str = "traffic_raw",
                         bootstrap_servers: str = "kafka:9092",
                         starting_offsets: str = "latest",
                         fail_on_data_loss: bool = False,
                         path_glob: str | None = None,
                         max_files_per_trigger: int | None = None,
                         watermark: str | None = fixed.WATERMARK_DELAY,
                         options: dict[str, str] | None = None) -> DataFrame:
    """Streaming readings with an event-time watermark.

    ``kafka``  : one topic, JSON ``value`` (needs the Kafka connector on the classpath).
    ``text``   : a directory of newline-delimited JSON payloads.
    ``parquet``: a directory of Parquet files with a ``value`` payload column
                 (e.g. a raw landing copy of the topic); schema from the files.
    ``events`` : a directory holding the ``events`` Parquet table (F0 mapping).

    ``options`` go to the source as they are, e.g. ``maxOffsetsPerTrigger`` /
    ``minPartitions`` for Kafka: bounded micro-batches keep a backlog from
    turning into one huge batch after an outage.
    """
    if source == "kafka":
        try:
            raw = (spark.readStream.format("kafka")
                   .option("kafka.bootstrap.servers", bootstrap_servers)
                   .option("subscribe", topic)
                   .option("startingOffsets", starting_offsets)
                   .option("failOnDataLoss", str(fail_on_data_loss).lower())
                   .options(**(options or {}))
                   .load())
        except Exception as exc:
            if "kafka" in str(exc).lower() and "data source" in str(exc).lower():
                raise RuntimeError(
                    "the Kafka source needs the spark-sql-kafka connector on the classpath "
                    "(spark.jars.packages); use source='text' or 'events' without it") from exc
            raise
        readings = decode_readings(raw)
    elif source in ("text", "parquet", "events"):
        if path is None:
            raise ValueError(f"source={source!r} needs a directory path")
        reader = spark.readStream.options(**(options or {}))
        if path_glob:
            reader = reader.option("pathGlobFilter", path_glob)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        if source == "text":
            readings = decode_readings(reader.text(path))
        elif source == "parquet":
            landed = spark.read.option("pathGlobFilter", path_glob or "*.parquet").parquet(path)
            readings = decode_readings(reader.schema(landed.schema).parquet(path))
        else:
            readings = readings_from_events(reader.schema(EVENTS).parquet(path))
    else:
        raise ValueError(f"unknown reading source {source!r}")
    return with_event_time(readings, watermark) if watermark else readings


def day_bounds(run_date: dt.date, days: int = 1) -> tuple[dt.datetime, dt.datetime]:
    """[run_date 00:00, run_date + days 00:00), wall clock (UTC)."""
    start = dt.datetime(run_date.year, run_date.month, run_date.day)
    return start, start + dt.timedelta(days=days)
