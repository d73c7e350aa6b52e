"""Composite jobs and the registry of checked queries."""

from roadflow.plans.daily import DailyOutputs, run_daily
from roadflow.plans.rollup import RangeReports, range_reports, read_rollup, store_rollup
from roadflow.plans.views import LiveView, ReportFeed, live_view, report_feed, write_weekly_report

__all__ = ["DailyOutputs", "LiveView", "RangeReports", "ReportFeed", "range_reports", "read_rollup", "store_rollup", "live_view", "report_feed", "run_daily",
           "write_weekly_report"]
