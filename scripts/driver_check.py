"""Run entry() and every query in a plain default SparkSession, as a driver would,
and compare each against its oracle SQL.

Usage: python scripts/driver_check.py [sf_dir]   (default /root/testdata/sf0.01)
The session gets no roadflow settings: system time zone, 200 shuffle partitions,
default state store, no checkpoint folder.
"""

from __future__ import annotations

import importlib.util
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from pyspark.sql import SparkSession

    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    entry = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(entry)
    from roadflow.plans.check import compare, duckdb_connection

    smoke = entry.entry(spark)
    print(f"entry: {smoke.count()} rows, {smoke.schema.simpleString()}")
    con = duckdb_connection(sf_dir)
    sqls = entry.oracle_sql()
    bad = []
    for name, fn in entry.queries().items():
        t0 = time.time()
        pdf = fn(spark, sf_dir).toPandas()
        status = "rows only"
        if name in sqls:
            res = compare(pdf, con.execute(sqls[name]).df())
            status = "ok" if res["ok"] else "MISMATCH"
            if not res["ok"]:
                bad.append(name)
        print(f"{name:26s} {len(pdf):7d} rows {time.time() - t0:6.1f}s {status}")
    print("mismatches:", bad or "none")
    spark.stop()
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main())
