"""The streaming job: readings -> {window aggregate, alerts} -> sinks (JOB-1)."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DateType, StructField, StructType

from roadflow import fixed
from roadflow.operators.alerts import detect_alerts
from roadflow.operators.windows import aggregate_windows
from roadflow.schemas import ALERT, WINDOW_AGG
from roadflow.session import ensure_dir, prefer_rocksdb_state, shuffle_partitions, use_utc
from roadflow.sources.readings import read_readings_stream
from roadflow.sources.tables import WINDOW_DATE
from roadflow.streaming.sinks import (
    AVAILABLE_NOW,
    write_stream_console,
    write_stream_kafka,
    write_stream_parquet,
)


@dataclass
class StreamConfig:
    """Where the streaming job reads from and writes to.

    ``agg_paths``/``alert_paths`` hold one or more output tables; each gets its
    own query and checkpoint (``<checkpoint_dir>/<name>-<i>``) and its own
    aggregation state. ``agg_mirrors``/``alert_mirrors`` are cheaper copies:
    each streams the committed files of the first path into the copy (see
    ``mirror_stream``) instead of aggregating the source again.
    """

    checkpoint_dir: str
    agg_paths: list[str] = field(default_factory=list)
    alert_paths: list[str] = field(default_factory=list)
    agg_mirrors: list[str] = field(default_factory=list)
    alert_mirrors: list[str] = field(default_factory=list)
    mirror_trigger: str | None = "1 minute"
    source: str = "kafka"
    source_path: str | None = None
    source_glob: str | None = None  # e.g. "events.parquet" in a folder of several tables
    topic: str = "traffic_raw"
    bootstrap_servers: str = "kafka:9092"
    starting_offsets: str = "latest"
    max_files_per_trigger: int | None = None
    source_options: dict[str, str] = field(default_factory=dict)
    window: str = fixed.WINDOW_DURATION
    watermark: str = fixed.WATERMARK_DELAY
    alert_below: float = fixed.ALERT_SPEED_BELOW
    agg_trigger: str | None = "1 minute"
    alert_trigger: str | None = "10 seconds"
    kafka_alert_topic: str | None = None
    kafka_trigger: str | None = "5 seconds"
    console: bool = False
    console_trigger: str | None = "30 seconds"
    partition_aggs_by_date: bool = True
    # State partitions of a new checkpoint (None: the session's shuffle partitions).
    state_partitions: int | None = None
    # Writer tasks of the aggregate sink (None: every state partition writes its
    # own file per date). When set, the emitted rows (not the state) are hashed
    # by date and a bucket of the sensor into that many tasks.
    sink_files: int | None = None


def stored_window_aggs(aggs: DataFrame) -> DataFrame:
    """Add the ``window_date`` partition column of the stored aggregate table."""
    return aggs.withColumn(WINDOW_DATE, F.to_date("window_start"))


def run_streaming(spark: SparkSession, cfg: StreamConfig) -> list[StreamingQuery]:
    """Start every configured query and return them (the caller awaits).

    The source is defined once; Spark runs one query per sink, each with its
    own offsets and checkpoint, and aggregate queries each keep their own state.
    """
    use_utc(spark)  # window_date partitions are UTC dates
    prefer_rocksdb_state(spark)
    readings = read_readings_stream(
        spark, cfg.source, path=cfg.source_path, topic=cfg.topic,
        bootstrap_servers=cfg.bootstrap_servers, starting_offsets=cfg.starting_offsets,
        path_glob=cfg.source_glob, max_files_per_trigger=cfg.max_files_per_trigger,
        watermark=cfg.watermark, options=cfg.source_options)
    aggs = aggregate_windows(readings, cfg.window)
    stored = stored_window_aggs(aggs) if cfg.partition_aggs_by_date else aggs
    alerts = detect_alerts(readings, cfg.alert_below)
    parts = [WINDOW_DATE] if cfg.partition_aggs_by_date else None
    if cfg.sink_files:
        # by date and a bucket of the sensor: a micro-batch of one date still has sink_files writers
        bucket = F.pmod(F.xxhash64("sensor_id"), F.lit(cfg.sink_files))
        stored = stored.repartition(cfg.sink_files, *(parts or []), bucket)

    with shuffle_partitions(spark, cfg.state_partitions):
        return _start_all(spark, cfg, stored, aggs, alerts, parts)


def _start_all(spark, cfg, stored, aggs, alerts, parts) -> list[StreamingQuery]:
    queries: list[StreamingQuery] = []
    for i, path in enumerate(cfg.agg_paths):
        queries.append(write_stream_parquet(
            stored, path, os.path.join(cfg.checkpoint_dir, f"agg-{i}"),
            cfg.agg_trigger, partition_by=parts))
    for i, path in enumerate(cfg.alert_paths):
        queries.append(write_stream_parquet(
            alerts, path, os.path.join(cfg.checkpoint_dir, f"alerts-{i}"), cfg.alert_trigger))
    queries += _start_mirrors(spark, cfg, parts)
    if cfg.kafka_alert_topic:
        queries.append(write_stream_kafka(
            alerts, cfg.kafka_alert_topic, os.path.join(cfg.checkpoint_dir, "alerts-kafka"),
            cfg.bootstrap_servers, cfg.kafka_trigger))
    if cfg.console:
        queries.append(write_stream_console(
            aggs, cfg.console_trigger, checkpoint=os.path.join(cfg.checkpoint_dir, "console")))
    return queries


def _start_mirrors(spark, cfg, parts) -> list[StreamingQuery]:
    queries: list[StreamingQuery] = []
    agg_schema = (StructType(WINDOW_AGG.fields + [StructField(WINDOW_DATE, DateType())])
                  if parts else WINDOW_AGG)
    for kind, sources, mirrors, mirror_parts, schema in (
            ("agg", cfg.agg_paths, cfg.agg_mirrors, parts, agg_schema),
            ("alerts", cfg.alert_paths, cfg.alert_mirrors, None, ALERT)):
        if mirrors and not sources:
            raise ValueError(f"{kind} mirrors need a primary {kind} path")
        for i, path in enumerate(mirrors):
            queries.append(mirror_stream(
                spark, sources[0], path, os.path.join(cfg.checkpoint_dir, f"{kind}-mirror-{i}"),
                cfg.mirror_trigger, partition_by=mirror_parts, schema=schema))
    return queries


def drain(spark: SparkSession, cfg: StreamConfig) -> None:
    """Process what the source holds now and return. Copies start when their primaries have ended,
    so one drain leaves them complete.

    Batches are unbounded unless the configuration bounds them (``max_files_per_trigger``,
    ``source_options``): a bound makes rows late wherever the source isn't in event-time order,
    and late rows are dropped, so it is the caller's choice."""
    cfg = replace(cfg, agg_trigger=AVAILABLE_NOW, alert_trigger=AVAILABLE_NOW, mirror_trigger=AVAILABLE_NOW,
                  kafka_trigger=AVAILABLE_NOW, console_trigger=AVAILABLE_NOW)
    run_to_completion(run_streaming(spark, replace(cfg, agg_mirrors=[], alert_mirrors=[])))
    run_to_completion(_start_mirrors(spark, cfg, [WINDOW_DATE] if cfg.partition_aggs_by_date else None))


def mirror_stream(spark: SparkSession, source_path: str, target_path: str, checkpoint: str,
                  trigger: str | None = "1 minute", partition_by: list[str] | None = None,
                  schema: StructType | None = None) -> StreamingQuery:
    """Copy a streaming Parquet table as it grows (exactly-once on both sides).

    Reading a file-sink folder goes through its commit log, so only committed
    files are copied; the copy's own sink log makes replays idempotent. With a
    ``schema`` (partition columns included) the copy can start before the
    source has written anything: the folder is created and the file source
    picks up the commit log once it appears. Without one it is read from the
    existing table.
    """
    if schema is None:
        schema = spark.read.parquet(source_path).schema
    else:
        ensure_dir(spark, source_path)
    rows = spark.readStream.schema(schema).parquet(source_path)
    return write_stream_parquet(rows, target_path, checkpoint, trigger, partition_by=partition_by)


def await_any_termination(spark: SparkSession, queries: list[StreamingQuery],
                          timeout_s: float | None = None) -> None:
    """Block until any query ends (as the reference's job does); if one failed,
    stop the others and re-raise, so a supervisor can restart the whole job
    from its checkpoints."""
    try:
        if timeout_s:
            spark.streams.awaitAnyTermination(timeout_s)
        else:
            spark.streams.awaitAnyTermination()
    except StreamingQueryException:
        pass  # raised for the query that failed: found below, after which the others are stopped
    failed = [q for q in queries if not q.isActive and q.exception() is not None]
    if failed:
        for q in queries:
            if q.isActive:
                q.stop()
        raise RuntimeError(f"streaming query {failed[0].name or failed[0].id} failed") \
            from failed[0].exception()


def run_to_completion(queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait for ``availableNow`` queries; re-raise the first failure."""
    for q in queries:
        q.awaitTermination(timeout_s) if timeout_s else q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"streaming query {q.name or q.id} failed") from q.exception()
