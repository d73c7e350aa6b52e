"""Batch sinks: idempotent daily Parquet table, report CSVs."""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame

from roadflow import fixed
from roadflow.sources.tables import REPORT_TIMESTAMP_FORMAT


def write_daily(df: DataFrame, path: str, partition_col: str = "report_date",
                day: dt.date | None = None) -> None:
    """A rerun or retry of a day replaces that day, never duplicates it.

    With ``day``, ``df`` holds that day only, and exactly its partition is replaced, also when
    ``df`` is empty. Without, the partitions present in ``df`` are (dynamic partition overwrite)."""
    if day is not None:
        df.drop(partition_col).write.mode("overwrite").parquet(
            os.path.join(path, f"{partition_col}={day}"))
        return
    (df.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col)
     .parquet(path))


def report_path(out_dir: str, kind: str, run_date: dt.date | str) -> str:
    stem = fixed.REPORT_STEMS.get(kind, kind)
    return os.path.join(out_dir, f"{stem}_{run_date}.csv")


def write_report_csv(df: DataFrame, out_dir: str, kind: str, run_date: dt.date | str,
                     num_files: int | None = None) -> str:
    """CSV report with header at ``<out_dir>/<stem>_<date>.csv`` (a Spark folder).

    ``num_files=1`` gives one part file; use it only for report-sized frames
    (bounded by sensors x 24 rows), since it funnels the write into one task.
    """
    path = report_path(out_dir, kind, run_date)
    if num_files is not None:
        df = df.coalesce(num_files)
    (df.write.mode("overwrite").option("header", "true")
     .option("timestampFormat", REPORT_TIMESTAMP_FORMAT)
     .option("timestampNTZFormat", REPORT_TIMESTAMP_FORMAT)
     .csv(path))
    return path
