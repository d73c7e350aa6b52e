"""Hour x sensor tables for any number of sensors (AGG-4, AGG-6)."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadflow.operators.ordering import with_positions

BLOCK_WIDTH = 1000


@dataclass
class PivotBlocks:
    """``cells``: block, hour_of_day and the block's columns c0 .. c<width - 1>, of summed volume (NULL: none).
    ``dictionary``: sensor_id -> block, column. A block is a table of its own: ``block(k)``, with the sensors' names."""

    cells: DataFrame
    dictionary: DataFrame
    width: int

    def block(self, k: int) -> DataFrame:
        """Block ``k`` as hour_of_day and one column per sensor, in the order of their names."""
        names = self.dictionary.where(F.col("block") == k).orderBy("column").select("sensor_id", "column").collect()
        rows = self.cells.where(F.col("block") == k)
        return rows.select("hour_of_day", *[F.col(f"c{r['column']}").alias(str(r["sensor_id"])) for r in names])


def volume_pivot_blocks(vol: DataFrame, width: int = BLOCK_WIDTH) -> PivotBlocks:
    """hour_of_day x sensor, cut into blocks of ``width`` columns, however many sensors there are.

    Sensors are numbered in the order of their names by range partitions (no one-task window); number // width is a sensor's
    block, the rest its column. One pivot with fixed values fills all blocks. A null sensor comes first.
    """
    if width < 1:
        raise ValueError("a block has one column at least")
    numbered = with_positions(vol.select("sensor_id").distinct(), "sensor_id")
    place = F.col("position") - 1
    dictionary = numbered.select("sensor_id", F.floor(place / width).cast("long").alias("block"), (place % width).cast("int").alias("column"))
    names = dictionary.select(F.col("sensor_id").alias("name"), "block", "column")
    rows = vol.join(names, vol["sensor_id"].eqNullSafe(names["name"]))
    cells = rows.groupBy("block", "hour_of_day").pivot("column", list(range(width))).agg(F.sum("total_volume"))
    return PivotBlocks(cells.select("block", "hour_of_day", *[F.col(str(k)).alias(f"c{k}") for k in range(width)]), dictionary, width)
