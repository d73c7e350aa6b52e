"""A catalogue of written reports (SRC-5 to SRC-8, SRT-5): a table to which every write adds a row.

The latest report of a kind, or of a kind and date, is an aggregate over the catalogue, not a listing of names: a
rewritten day counts with its last write, an empty report is found as such, and a report that was never written
has no row. Rows are appended as files of their own, so writers don't wait for each other.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow.schemas import CATALOGUE, REPORT_SCHEMAS
from roadflow.session import matching_paths
from roadflow.sinks.single import write_report_file
from roadflow.sources.tables import read_csv

_FOLDER = "catalogue"


def write_catalogued(df: DataFrame, out_dir: str, kind: str, run_date: dt.date, *order: str | Column) -> str:
    """``write_report_file``, then a row in the catalogue: kind, date, path, rows, time of the write."""
    path = write_report_file(df, out_dir, kind, run_date, *order)
    spark = df.sparkSession
    rows = read_csv(spark, path, df.schema).count()
    entry = spark.createDataFrame([(kind, run_date, path, rows)], "kind string, report_date date, path string, rows long")
    entry.select("*", F.current_timestamp().alias("written_at")).coalesce(1).write.mode("append").parquet(f"{out_dir}/{_FOLDER}")
    return path


def read_catalogue(spark: SparkSession, out_dir: str) -> DataFrame:
    """Every write: kind, report_date, path, rows, written_at."""
    folder = f"{out_dir}/{_FOLDER}"
    if not matching_paths(spark, folder):
        return spark.createDataFrame([], CATALOGUE)
    return spark.read.schema(CATALOGUE).parquet(folder)


def latest_reports(catalogue: DataFrame, requests: DataFrame) -> DataFrame:
    """For each request (its columns, among them kind and report_date; a null date means any): found_date, path and rows of the
    report with the latest date, of its writes the last; null where there is none."""
    asked = requests.select(*[F.col(c).alias(f"asked_{c}") for c in requests.columns])
    match = (F.col("kind") == F.col("asked_kind")) & (F.col("asked_report_date").isNull() | (F.col("report_date") == F.col("asked_report_date")))
    keys = [f"asked_{c}" for c in requests.columns]
    newest = F.max_by(F.struct("report_date", "path", "rows"), F.struct("report_date", "written_at"))
    found = asked.join(catalogue, match, "left").groupBy(*keys).agg(newest.alias("newest"))
    return found.select(*[F.col(k).alias(c) for k, c in zip(keys, requests.columns)],
                        F.col("newest.report_date").alias("found_date"), "newest.path", "newest.rows")


def read_catalogued(spark: SparkSession, out_dir: str, kind: str, date: dt.date | None = None) -> DataFrame | None:
    """The latest report of a kind (and date), or None if none was written."""
    request = spark.createDataFrame([(kind, date)], "kind string, report_date date")
    path = latest_reports(read_catalogue(spark, out_dir), request).first()["path"]
    return read_csv(spark, path, REPORT_SCHEMAS.get(kind)) if path is not None else None
