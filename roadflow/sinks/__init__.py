"""Batch sinks: the daily Parquet table and report CSVs."""

from roadflow.sinks.batch import report_path, write_daily, write_report_csv
from roadflow.sinks.catalogue import latest_reports, read_catalogue, read_catalogued, write_catalogued
from roadflow.sinks.single import write_report_file

__all__ = ["latest_reports", "read_catalogue", "read_catalogued", "write_catalogued",
           "report_path", "write_daily", "write_report_csv", "write_report_file"]
