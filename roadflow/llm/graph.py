"""Connected components of an edge table by hooking and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from .common import discard, materialise


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node reachable, for every node of an edge. Nodes are longs.

    Each round every node takes the smallest label among its own and its neighbours', hands it on to
    its label's node, and then jumps to its label's label, so paths halve. Joins have the plain label
    table on one side (a hub's edges can be split) and minima are aggregated before they are shuffled.
    Ends when no label changes; every round is a written table."""
    e = edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
    e = materialise(e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v"))).where("u != v").distinct(), "edges")
    labels = materialise(e.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("node"), F.least("u", "m").alias("label")), "labels")
    state = None
    while True:
        lu = labels.select(F.col("node").alias("u"), F.col("label").alias("lu"))
        lv = labels.select(F.col("node").alias("v"), F.col("label").alias("lv"))
        seen = e.join(lu, "u").join(lv, "v").where("lv < lu")
        offers = seen.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.col("lv").alias("label")),
                                               F.struct(F.col("lu").alias("node"), F.col("lv").alias("label")))).alias("o")).select("o.*")
        before = labels
        hooked = materialise(labels.unionByName(offers).groupBy("node").agg(F.min("label").alias("label")), "labels")
        up = hooked.select(F.col("node").alias("label"), F.col("label").alias("above"))
        labels = materialise(hooked.join(up, "label").select("node", F.least("label", "above").alias("label")), "labels")
        discard(before, hooked)
        now = tuple(labels.agg(F.count("*"), F.sum(F.col("label").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("node", "label"))).first())
        if now == state:
            discard(e)
            out = labels.select("node", F.col("label").alias("component"))
            out.written_to = labels.written_to
            return out
        state = now
