"""One CSV file per report at any size (SNK-6, SNK-7).

Tasks write headerless parts in range order; the file system joins them. HDFS joins files by their blocks without
reading them (``concat``); where a file system cannot, the driver copies one stream after the other, a buffer at a
time. The report never goes through one task, and appears under its name only when it is whole.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.errors import UnsupportedOperationException
from pyspark.sql import Column, DataFrame, SparkSession

from roadflow.sinks.batch import report_path
from roadflow.sources.tables import REPORT_TIMESTAMP_FORMAT


def write_report_file(df: DataFrame, out_dir: str, kind: str, run_date: dt.date | str, *order: str | Column) -> str:
    """CSV report with header as one file ``<out_dir>/<stem>_<date>.csv``, rows in the given order; replaces what is there."""
    spark, path = df.sparkSession, report_path(out_dir, kind, run_date)
    parts = f"{out_dir}/_parts-{uuid.uuid4().hex}"
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order) if order else df
    (rows.write.option("header", "false").option("emptyValue", "")
     .option("timestampFormat", REPORT_TIMESTAMP_FORMAT).option("timestampNTZFormat", REPORT_TIMESTAMP_FORMAT).csv(parts))
    _join(spark, parts, ",".join(df.columns) + "\n", path)
    return path


def _join(spark: SparkSession, parts: str, header: str, path: str) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    file = jvm.org.apache.hadoop.fs.Path
    fs = file(parts).getFileSystem(conf)
    found = fs.globStatus(file(f"{parts}/part-*"))
    pieces = [p for p in sorted((f.getPath() for f in found), key=lambda p: p.getName()) if fs.getFileStatus(p).getLen()]
    whole = file(f"{parts}/whole")
    out = fs.create(whole, True)
    out.write(bytearray(header.encode()))
    out.close()
    if pieces:
        try:
            sources = spark.sparkContext._gateway.new_array(file, len(pieces))
            for k, p in enumerate(pieces):
                sources[k] = p
            fs.concat(whole, sources)
        except UnsupportedOperationException:  # this file system doesn't join files
            out = fs.create(whole, True)
            out.write(bytearray(header.encode()))
            for p in pieces:
                stream = fs.open(p)
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(stream, out, conf, False)
                stream.close()
            out.close()
    target = file(path)
    fs.delete(target, True)
    if not fs.rename(whole, target):
        raise OSError(f"could not move the report to {path}")
    fs.delete(file(parts), True)
