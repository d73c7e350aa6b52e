"""One streaming query that feeds every sink from one read of the source (STR-9, JOB-1).

``fan_out`` runs one ``foreachBatch`` query. A micro-batch is persisted, handed to each sink in turn, and the sink's
name and the batch id go to a ledger when the sink is done. After a failure Spark replays the batch under the same id:
sinks that have it in the ledger are left out, and what an interrupted sink wrote is written again in the same
place, so nothing appears twice. Readers take only batches that the ledger holds.

``UpsertSink`` is update mode into a table (STR-5, SNK-4): every window that a batch touches is merged with what is
stored, open windows included. What is stored is additive (sums and counts), so a batch reads and replaces only the
dates that its rows fall on. A date's rows are in ``window_date=<d>/batch=<id>``; the newest committed batch of a date
holds all of its windows. A batch that was never committed is not read, and is overwritten by its replay.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from typing import Protocol

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from roadflow import fixed
from roadflow.functions import add_parts, congestion_index, mean_of_parts
from roadflow.operators.alerts import encode_alerts
from roadflow.operators.windows import window_parts
from roadflow.schemas import WINDOW_AGG, WINDOW_PARTS
from roadflow.session import delete_path, ensure_dir, matching_paths, prefer_rocksdb_state, touch, use_utc
from roadflow.sources.tables import WINDOW_DATE
from roadflow.streaming.sinks import _with_trigger

BATCH = "batch"
_KEEP = 8  # marks of a sink that stay in the ledger


class Ledger:
    """Which micro-batches each sink has finished: one empty file per sink and batch in a shared folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _marks(self, sink: str) -> list[int]:
        return sorted(int(p.rsplit("/", 1)[1]) for p in matching_paths(self.spark, f"{self.path}/{sink}/*"))

    def last(self, sink: str) -> int:
        """The newest batch that the sink has finished; -1 before the first."""
        return max(self._marks(sink), default=-1)

    def mark(self, sink: str, batch_id: int) -> None:
        """The sink has finished the batch, and so all before it: older marks go, except a few."""
        touch(self.spark, f"{self.path}/{sink}/{batch_id}")
        for old in self._marks(sink)[:-_KEEP]:
            delete_path(self.spark, f"{self.path}/{sink}/{old}")


class Sink(Protocol):
    def write(self, batch: DataFrame, batch_id: int, committed: int) -> None:
        """Write a batch so that writing it again gives the same table. ``committed``: the last batch of the ledger."""

    def finish(self, spark: SparkSession, batch_id: int) -> None:
        """After the batch is in the ledger."""


@dataclass
class AppendSink:
    """Rows of each batch, transformed, in a folder of their own: ``<path>/batch=<id>``."""

    path: str
    transform: Callable[[DataFrame], DataFrame]

    def write(self, batch: DataFrame, batch_id: int, committed: int) -> None:
        self.transform(batch).write.mode("overwrite").parquet(f"{self.path}/{BATCH}={batch_id}")

    def finish(self, spark: SparkSession, batch_id: int) -> None:
        pass


@dataclass
class UpsertSink:
    """Window aggregates in update mode: merged into the stored windows of the dates that a batch touches."""

    path: str
    window: str = fixed.WINDOW_DURATION

    def write(self, batch: DataFrame, batch_id: int, committed: int) -> None:
        new = window_parts(batch, self.window).withColumn(WINDOW_DATE, F.to_date("window_start"))
        # the dates of one micro-batch: as many as it spans days
        dates = {str(r[0]) for r in new.select(WINDOW_DATE).distinct().collect()}
        old = _stored_parts(batch.sparkSession, self.path, committed, dates)
        keys = [WINDOW_DATE, "window_start", "window_end", "sensor_id"]
        both = old.unionByName(new) if old is not None else new
        merged = both.groupBy(*keys).agg(F.sum("total_vehicles").alias("total_vehicles"), *add_parts("speed"))
        # even files per date, whatever the number of windows
        rows = merged.withColumn(BATCH, F.lit(batch_id).cast("long")).hint("rebalance", WINDOW_DATE)
        (rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(WINDOW_DATE, BATCH).parquet(self.path))

    def finish(self, spark: SparkSession, batch_id: int) -> None:
        """Of each date the two newest versions stay: the current one, and the one before for readers under way."""
        for date in {d for d, b, _ in _versions(spark, self.path) if b == batch_id}:
            for _, _, path in _versions(spark, self.path, date)[:-2]:
                delete_path(spark, path)


@dataclass
class KafkaSink:
    """Rows as JSON to a topic (needs the Kafka connector). Kafka keeps what an interrupted batch sent, so a replay may repeat it."""

    topic: str
    transform: Callable[[DataFrame], DataFrame]
    bootstrap_servers: str = "kafka:9092"

    def write(self, batch: DataFrame, batch_id: int, committed: int) -> None:
        (encode_alerts(self.transform(batch)).write.format("kafka").option("kafka.bootstrap.servers", self.bootstrap_servers)
         .option("topic", self.topic).save())

    def finish(self, spark: SparkSession, batch_id: int) -> None:
        pass


@dataclass
class ShowSink:
    """The first ``rows`` windows that a batch changed, with their merged values, as text to ``show`` (the console).
    Stands after ``table``, whose new version it reads."""

    table: UpsertSink
    rows: int = 10
    show: Callable[[str], None] = print

    def write(self, batch: DataFrame, batch_id: int, committed: int) -> None:
        touched = window_parts(batch, self.table.window).select("window_start", "sensor_id")
        dates = {str(r[0]) for r in touched.select(F.to_date("window_start")).distinct().collect()}
        stored = _stored_parts(batch.sparkSession, self.table.path, batch_id, dates)
        self.show(f"batch {batch_id}")
        if stored is None:
            return
        changed = finished_windows(stored.join(touched, ["window_start", "sensor_id"], "left_semi"))
        for row in changed.orderBy("window_start", "sensor_id").limit(self.rows).collect():
            self.show(" | ".join(str(v) for v in row))

    def finish(self, spark: SparkSession, batch_id: int) -> None:
        pass


def fan_out(readings: DataFrame, sinks: dict[str, Sink], checkpoint: str, ledger: str,
            trigger: str | None = "1 minute", query_name: str | None = None) -> StreamingQuery:
    """Start one query over streaming ``readings`` that feeds every sink of ``sinks`` (name -> sink), in that order."""
    spark = readings.sparkSession
    use_utc(spark)
    prefer_rocksdb_state(spark)
    ensure_dir(spark, ledger)

    def feed(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        done = Ledger(own, ledger)
        due = [(name, sink, last) for name, sink in sinks.items() if (last := done.last(name)) < batch_id]
        if not due:
            return
        held = batch.persist(StorageLevel.MEMORY_AND_DISK) if len(due) > 1 else batch
        try:
            for name, sink, last in due:
                sink.write(held, batch_id, last)
                done.mark(name, batch_id)
                sink.finish(own, batch_id)
        finally:
            held.unpersist()

    writer = readings.writeStream.foreachBatch(feed).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return _with_trigger(writer, trigger).start()


# --- reading what the sinks wrote ---------------------------------------------

def read_appended(spark: SparkSession, sink: AppendSink, ledger: str, name: str, schema: T.StructType) -> DataFrame:
    """The rows of an ``AppendSink`` that the ledger knows as finished."""
    last = Ledger(spark, ledger).last(name)
    found = [p for p in matching_paths(spark, f"{sink.path}/{BATCH}=*") if int(p.rsplit("=", 1)[1]) <= last]
    if not found:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*found)


def read_upserted(spark: SparkSession, sink: UpsertSink, ledger: str, name: str) -> DataFrame:
    """The windows of an ``UpsertSink`` as of its last finished batch, open windows included."""
    use_utc(spark)
    parts = _stored_parts(spark, sink.path, Ledger(spark, ledger).last(name))
    return finished_windows(parts) if parts is not None else spark.createDataFrame([], WINDOW_AGG)


def finished_windows(parts: DataFrame) -> DataFrame:
    """Additive window measures as rows of the aggregate table."""
    rows = parts.select("window_start", "window_end", "sensor_id", "total_vehicles", mean_of_parts("speed").alias("avg_speed_window"))
    return rows.withColumn("congestion_index", congestion_index("total_vehicles", "avg_speed_window"))


def _versions(spark: SparkSession, path: str, date: str = "*") -> list[tuple[str, int, str]]:
    """(date, batch, folder), by date and batch."""
    found = []
    for p in matching_paths(spark, f"{path}/{WINDOW_DATE}={date}/{BATCH}=*"):
        m = re.search(rf"{WINDOW_DATE}=([^/]+)/{BATCH}=(\d+)$", p)
        found.append((m[1], int(m[2]), p))
    return sorted(found)


def _stored_parts(spark: SparkSession, path: str, committed: int, dates: set[str] | None = None) -> DataFrame | None:
    """The stored windows of ``dates`` (all if None): of each date the newest finished batch. Other folders aren't read."""
    newest = {d: p for d, b, p in _versions(spark, path) if b <= committed and (dates is None or d in dates)}
    if not newest:
        return None
    rows = spark.read.schema(WINDOW_PARTS).parquet(*newest.values())
    return rows.withColumn(WINDOW_DATE, F.to_date("window_start"))
