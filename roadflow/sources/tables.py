"""Stored tables: window aggregates, report CSVs, the junction dimension."""

from __future__ import annotations

import datetime as dt
import warnings

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadflow import fixed
from roadflow.schemas import JUNCTION, REPORT_SCHEMAS, WINDOW_AGG
from roadflow.session import matching_paths
from roadflow.sources.readings import day_bounds, time_range

# Text form of timestamps in report CSVs (same text as a pandas export).
REPORT_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Partition column of the stored aggregate table (one folder per UTC day).
WINDOW_DATE = "window_date"

# Conditions that mean "nothing stored there yet"; any other analysis error is raised.
_NOTHING_STORED = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_window_aggs(spark: SparkSession, path: str, run_date: dt.date | None = None,
                     days: int = 1, missing_ok: bool = False) -> DataFrame:
    """The stored 5-minute aggregate table, optionally one UTC day ``[d, d+days)``.

    Reads through Spark, so a streaming sink's commit log decides which files
    count. The day bound is applied twice: on the ``window_date`` partition
    column when the table has it (partition pruning) and on ``window_start``
    (Parquet row-group skipping via PushedFilters). A missing table is an error
    naming the path (an empty frame with ``missing_ok``, for live views that
    start before the stream has written); an empty day is an empty frame.
    """
    try:
        df = spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() not in _NOTHING_STORED:
            raise
        if missing_ok:
            return spark.createDataFrame([], WINDOW_AGG)
        raise FileNotFoundError(f"window aggregate table not found: {path}") from exc
    if run_date is not None:
        start, end = day_bounds(run_date, days)
        if WINDOW_DATE in df.columns:
            df = df.where(F.col(WINDOW_DATE).between(
                F.lit(start.date()), F.lit((end - dt.timedelta(days=1)).date())))
        df = time_range(df, "window_start", start, end)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in WINDOW_AGG.fields])


def junction_dim(spark: SparkSession) -> DataFrame:
    """The fixed 4-row junction location dimension."""
    return spark.createDataFrame(fixed.JUNCTIONS, JUNCTION)


def read_report(spark: SparkSession, report_dir: str, kind: str,
                date: dt.date | str | None = None, required: bool = False) -> DataFrame:
    """Report CSV for a date (glob ``*<stem>_*<date>*.csv``); ``"yesterday"``
    means UTC yesterday, None any date.

    Names are listed first. Of several matching entries the one with the greatest
    name is the latest; only it is read, and if it holds no rows, so does the
    result. No match: an empty frame with the schema and a warning, or
    ``FileNotFoundError`` when ``required``.
    """
    if date == "yesterday":
        date = dt.datetime.now(dt.timezone.utc).date() - dt.timedelta(days=1)
    stem = fixed.REPORT_STEMS.get(kind, kind)
    pattern = f"*{stem}_*{date}*.csv" if date is not None else f"*{stem}*.csv"
    schema = REPORT_SCHEMAS.get(kind)
    found = matching_paths(spark, f"{report_dir.rstrip('/')}/{pattern}")
    if not found:
        if required:
            raise FileNotFoundError(f"no {stem} report matching {pattern} in {report_dir}")
        warnings.warn(f"no {stem} report found for {date or 'any date'} in {report_dir}",
                      stacklevel=2)
        return _no_rows(spark, schema)
    return read_csv(spark, found[-1], schema)


def read_csv(spark: SparkSession, path: str, schema) -> DataFrame:
    """A report as it was written: one file, or a folder of parts."""
    reader = (spark.read.option("header", "true")
              .option("timestampFormat", REPORT_TIMESTAMP_FORMAT)
              .option("timestampNTZFormat", REPORT_TIMESTAMP_FORMAT))
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", "true")
    try:
        return reader.csv(path)
    except AnalysisException as exc:
        if exc.getCondition() != "UNABLE_TO_INFER_SCHEMA":
            raise
        return _no_rows(spark, schema)  # a folder without part files


def _no_rows(spark: SparkSession, schema) -> DataFrame:
    if schema is not None:
        return spark.createDataFrame([], schema)
    return spark.createDataFrame([], "_empty string").select()
