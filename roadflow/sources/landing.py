"""A clustered landing table of raw readings, laid out so that a day or a sensor reads little of it (FLT-2, SRC-3).

One folder per UTC day; inside, rows are sorted by sensor and time and cut into bounded row groups. A day is partition
pruning; a sensor or a stretch of time in the day skips the row groups whose footers exclude it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadflow.schemas import READING
from roadflow.sources.readings import day_bounds, time_range

EVENT_DATE = "event_date"
ROW_GROUP_ROWS = 100_000


def write_landing(readings: DataFrame, path: str, row_group_rows: int = ROW_GROUP_ROWS) -> None:
    """Replace the days that ``readings`` hold. Rows without an event time go to the null day's folder.

    Rows are dealt to range partitions of (day, sensor, time): a day or a sensor that holds a third of all rows is
    written by many tasks, each a stretch of its own.
    """
    keys = [EVENT_DATE, "sensor_id", "event_time"]
    rows = readings.withColumn(EVENT_DATE, F.to_date("event_time"))
    (rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .option("parquet.block.row.count.limit", str(row_group_rows))
     .partitionBy(EVENT_DATE).parquet(path))


def read_landing(spark: SparkSession, path: str, day: dt.date | None = None, days: int = 1,
                 sensors: Iterable[str] | None = None) -> DataFrame:
    """Readings of whole UTC days (all days if None), of some sensors or all."""
    schema = T.StructType([*READING.fields, T.StructField(EVENT_DATE, T.DateType())])
    rows = spark.read.schema(schema).parquet(path)
    if day is not None:
        start, end = day_bounds(day, days)
        rows = rows.where(F.col(EVENT_DATE).between(F.lit(start.date()), F.lit((end - dt.timedelta(days=1)).date())))
        rows = time_range(rows, "event_time", start, end)
    if sensors is not None:
        rows = rows.where(F.col("sensor_id").isin(*sensors))
    return rows.select(*READING.fieldNames())
