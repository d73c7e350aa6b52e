"""Global row numbers without a one-task window (SRT-1, SRT-2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadflow.session import checkpoint_root

_LOCAL = (1 << 33) - 1  # monotonically_increasing_id: the partition above these bits, the row below


def with_positions(df: DataFrame, *order: str | Column, position: str = "position") -> DataFrame:
    """``df`` with each row's place (from 1) in the given order; equal rows have neighbouring places.

    Rows are dealt to range partitions and sorted inside them; the partitions' row counts, one number each, are added up
    on the driver, and a row's place is what comes before its partition plus its place in it. Nothing but the counts
    meets in one task. The sorted rows are checkpointed to the shared folder first, so that counts and
    numbers are of the same partitions, also when an executor is lost between the two.
    """
    spark = df.sparkSession
    checkpoint_root(spark)
    # strings name columns; an order that starts with a descending column ranges over it the same way
    keys = [F.col(c) if isinstance(c, str) else c for c in order]
    rows = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    rows = rows.withColumn("__id", F.monotonically_increasing_id()).checkpoint()
    part = F.shiftright("__id", 33)
    counts = rows.groupBy(part.alias("part")).count().collect()
    before, total = {}, 0
    for r in sorted(counts, key=lambda r: r["part"]):
        before[r["part"]] = total
        total += r["count"]
    offset = F.element_at(F.create_map(*[F.lit(x) for pair in before.items() for x in pair]), part) if before else F.lit(0)
    return rows.withColumn(position, offset + F.col("__id").bitwiseAND(F.lit(_LOCAL)) + 1).drop("__id")
