"""roadflow: road-sensor analytics on Spark DataFrames and Structured Streaming.

Every transform is a pure function ``DataFrame -> DataFrame`` built from
``pyspark.sql.functions`` only (no UDFs), so Catalyst can push filters into the
Parquet scan, prune columns and keep the work inside whole-stage codegen.

Event times are UTC. Operators that truncate to hours or dates follow the
session time zone, so they expect ``spark.sql.session.timeZone=UTC``; the job
entry points (``run_streaming``, ``run_daily``, ``live_view``,
``report_feed``, the CLI, the checked queries) set it with ``use_utc``.
"""

from roadflow.session import build_session, scratch_dir, ship_package, use_utc

__all__ = ["build_session", "scratch_dir", "ship_package", "use_utc"]
