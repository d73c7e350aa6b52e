"""spark-submit entry points for the two jobs.

    spark-submit --py-files roadflow.zip roadflow/cli.py stream \
        --checkpoint-dir ... --agg-path ... --alert-path ... [--available-now]
    spark-submit --py-files roadflow.zip roadflow/cli.py daily --in ... --out ... [--run-date D]

(or ``python -m roadflow.cli ...`` with a local master). The daily job
defaults to yesterday (UTC); schedule it at 00:15 UTC or later.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from roadflow.plans.daily import run_daily
from roadflow.session import use_utc
from roadflow.streaming.jobs import (
    StreamConfig,
    await_any_termination,
    drain,
    run_streaming,
)


def _args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="roadflow")
    sub = p.add_subparsers(dest="job", required=True)
    s = sub.add_parser("stream", help="readings -> 5-minute aggregates and alerts")
    s.add_argument("--checkpoint-dir", required=True)
    s.add_argument("--source", default="kafka", choices=["kafka", "text", "parquet", "events"])
    s.add_argument("--source-path")
    s.add_argument("--source-glob", help='file-name filter, e.g. "events.parquet"')
    s.add_argument("--topic", default="traffic_raw")
    s.add_argument("--bootstrap-servers", default="kafka:9092")
    s.add_argument("--starting-offsets",
                   help="Kafka only; default: latest, with --available-now earliest")
    s.add_argument("--source-option", action="append", default=[], metavar="KEY=VALUE",
                   type=lambda text: tuple(text.split("=", 1)),
                   help="passed to the source, e.g. maxOffsetsPerTrigger=1000000")
    s.add_argument("--max-files-per-trigger", type=int)
    s.add_argument("--window", default=StreamConfig.window)
    s.add_argument("--watermark", default=StreamConfig.watermark)
    s.add_argument("--alert-below", type=float, default=StreamConfig.alert_below)
    s.add_argument("--agg-trigger", default=StreamConfig.agg_trigger)
    s.add_argument("--alert-trigger", default=StreamConfig.alert_trigger)
    s.add_argument("--mirror-trigger", default=StreamConfig.mirror_trigger)
    s.add_argument("--agg-path", action="append", default=[])
    s.add_argument("--alert-path", action="append", default=[])
    s.add_argument("--agg-mirror", action="append", default=[])
    s.add_argument("--alert-mirror", action="append", default=[])
    s.add_argument("--kafka-alert-topic")
    s.add_argument("--console", action="store_true")
    s.add_argument("--state-partitions", type=int)
    s.add_argument("--sink-files", type=int)
    s.add_argument("--available-now", action="store_true",
                   help="drain what is there and stop (backfills); default: run until stopped")
    d = sub.add_parser("daily", help="daily reports from the stored aggregates")
    d.add_argument("--in", dest="in_path", required=True)
    d.add_argument("--out", dest="out_path", required=True)
    d.add_argument("--run-date", type=dt.date.fromisoformat, help="default: yesterday (UTC)")
    d.add_argument("--sensor", action="append", help="pivot columns (default: one row per sensor, 24 hour columns)")
    return p.parse_args(argv)


def main(argv=None) -> None:
    args = _args(argv)
    spark = use_utc(SparkSession.builder.appName(f"roadflow-{args.job}").getOrCreate())
    if args.job == "stream":
        cfg = StreamConfig(
            checkpoint_dir=args.checkpoint_dir, source=args.source, source_path=args.source_path,
            source_glob=args.source_glob,
            topic=args.topic, bootstrap_servers=args.bootstrap_servers,
            agg_paths=args.agg_path, alert_paths=args.alert_path, agg_mirrors=args.agg_mirror,
            alert_mirrors=args.alert_mirror, kafka_alert_topic=args.kafka_alert_topic,
            console=args.console, state_partitions=args.state_partitions,
            sink_files=args.sink_files, window=args.window, watermark=args.watermark,
            alert_below=args.alert_below, agg_trigger=args.agg_trigger,
            alert_trigger=args.alert_trigger, mirror_trigger=args.mirror_trigger,
            starting_offsets=args.starting_offsets or ("earliest" if args.available_now else "latest"),
            max_files_per_trigger=args.max_files_per_trigger,
            source_options=dict(args.source_option))
        if args.available_now:
            drain(spark, cfg)
        else:
            await_any_termination(spark, run_streaming(spark, cfg))
    else:
        run_daily(spark, args.run_date, args.in_path, args.out_path, sensors=args.sensor)


if __name__ == "__main__":
    main()
