"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products, one representative per group.

Equal vectors of a label are one class from the start. A class is compared in its own cell (nearest
centroid), and as a guest in each lower cell that may hold a partner: a vector within the threshold's angle of
y lies in a cell only if y is within that angle of the plane between the two centroids, so no pair is lost at a cell's border.
Cells are cut into blocks of about ``BLOCK`` vectors; every pair of blocks is a task's product, so a cell that holds a
third of all vectors is many small products. Out of a product come degree sums and a spanning forest, never pairs.

Defined results: null labels, and vectors that are null, empty, zero or hold null or non-finite components, link
with nothing; vectors of different length don't link; a null id is read as -1; rows equal in all columns are vectors of
their own and link; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import materialise
from .graph import components
from .minhash import whole_groups
from .vectors import SAMPLE, matrix, sample_rows, spherical_kmeans, unit, usable

BLOCK, PER_CELL, PER_CENTRE = 512, 20_000, 8  # PER_CENTRE: sampled vectors that a centroid stands for at least
ASSIGN_ROWS = 1000


def cell_distances(centres: np.ndarray) -> np.ndarray:
    """Distances of the centroids from one another: cells x cells, whatever the number of rows."""
    return np.array([np.sqrt(((centres - c) ** 2).sum(axis=1)) for c in centres]).reshape(len(centres), len(centres))


def guest_cells(x: np.ndarray, centres: np.ndarray, apart: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Home cell of each unit row, and (rows x cells) flags: the home, and lower cells that may hold a partner. ``apart``: ``cell_distances``."""
    near = x @ centres.T
    home = near.argmax(axis=1)
    sine = np.sqrt(max(0.0, 1 - threshold * threshold)) + 1e-9
    margin = near[np.arange(len(x)), home][:, None] - near
    flags = (margin <= sine * apart[home] + 1e-12) & (np.arange(len(centres))[None, :] < home[:, None])
    flags[np.arange(len(x)), home] = True
    return home, flags


def block_links(sim: np.ndarray, left: np.ndarray, right: np.ndarray, sizes_l: np.ndarray, sizes_r: np.ndarray):
    """Of a link mask between two lists of nodes: the weight of links per node, and a forest (node, smallest node of its component)."""
    a, b = np.nonzero(sim)
    if not len(a):
        return None
    nodes = np.unique(np.concatenate((left[a], right[b])))
    u, v = np.searchsorted(nodes, left[a]), np.searchsorted(nodes, right[b])
    weight = np.bincount(u, sizes_r[b], minlength=len(nodes)) + np.bincount(v, sizes_l[a], minlength=len(nodes))
    label = np.arange(len(nodes))
    while True:
        low = label.copy()
        np.minimum.at(low, u, label[v])
        np.minimum.at(low, v, label[u])
        low = low[low]
        if (low == label).all():
            break
        label = low
    return nodes, weight.astype(np.int64), nodes[label]


def linked(vectors: DataFrame, *, threshold: float = 0.98, block: int = BLOCK, per_cell: int = PER_CELL, sample: int = SAMPLE) -> DataFrame:
    """One row per row: vec_id, n_links, component_id, kept. Needs vec_id, embedding, label."""
    rows = vectors.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(-1).cast("long")).alias("vec_id"), "label", "embedding")
    valid = F.col("label").isNotNull() & usable(F.col("embedding"))
    classes = rows.where(valid).groupBy("label", "embedding").agg(F.min("vec_id").alias("first"), F.count("*").alias("n"))
    # class ids: unique also where one id stands for several vectors
    classes = classes.withColumn("id", F.xxhash64("label", "embedding")).withColumn("dim", F.size("embedding"))
    classes = materialise(classes, "classes")
    n = classes.count()
    dims = classes.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    dim = dims[0]["dim"] if dims else 0
    sampled = sample_rows(classes.where(F.col("dim") == dim), sample) if dims else np.zeros((0, 1))
    # as many cells as the table asks for; a bounded sample has centroids for PER_CENTRE vectors each
    centres = spherical_kmeans(sampled, min(max(1, len(sampled) // PER_CENTRE), max(1, n // per_cell)))
    shared = vectors.sparkSession.sparkContext.broadcast((centres, cell_distances(centres)))  # cells x (dim + cells) numbers

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        middle, apart = shared.value
        for batch in (b.slice(k, ASSIGN_ROWS) for b in batches for k in range(0, b.num_rows, ASSIGN_ROWS)):
            size = batch.column("dim").to_numpy()
            for d in np.unique(size):
                part = batch.take(pa.array(np.flatnonzero(size == d)))
                if d == dim:
                    home, flags = guest_cells(unit(matrix(part.column("embedding"))), middle, apart, threshold)
                    at, cell = np.nonzero(flags)
                else:  # other lengths: a cell of their own
                    at, cell, home = np.arange(len(part)), np.full(len(part), -int(d)), np.full(len(part), -int(d))
                part = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([pa.array(cell, pa.int32()), pa.array(home[at] == cell, pa.bool_()), *(part.column(c) for c in ("label", "id", "n", "embedding"))],
                                                 names=["cell", "own", "label", "id", "n", "embedding"])

    label_type = classes.schema["label"].dataType.simpleString()
    placed = classes.select("dim", "label", "id", "n", "embedding").mapInArrow(
        assign, f"cell int, own boolean, label {label_type}, id long, n long, embedding {classes.schema['embedding'].dataType.simpleString()}")
    placed = materialise(placed.withColumn("group", F.xxhash64("label", "cell")), "placed")
    counts = materialise(placed.groupBy("group").agg(F.count("*").alias("size")), "cells")
    placed = placed.join(counts, "group")
    blocks = F.ceil(F.col("size") / block).cast("int")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    placed = placed.select("group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "own", "id", "n", "embedding")

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bounds, t in whole_groups(batches, ("group", "i", "j")):
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                g = t.slice(s, e - s)
                ids, own, size, blk = (g.column(c).to_numpy() for c in ("id", "own", "n", "block"))
                x = unit(matrix(g.column("embedding")))
                same = g.column("i")[0] == g.column("j")[0]
                left = np.arange(len(ids)) if same else np.flatnonzero(blk == g.column("i")[0].as_py())
                right = left if same else np.flatnonzero(blk == g.column("j")[0].as_py())
                sim = x[left] @ x[right].T >= threshold
                sim &= own[left][:, None] | own[right][None, :]  # two guests meet elsewhere
                if same:
                    sim = np.triu(sim, 1)
                got = block_links(sim, ids[left], ids[right], size[left], size[right])
                if got is not None:
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in got], names=["id", "links", "root"])

    found = placed.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "id").mapInArrow(products, "id long, links long, root long")
    found = materialise(found, "links")
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    groups = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    named = classes.select("id", "label", "embedding", "first", "n").join(links, "id", "left").join(groups, F.col("id") == F.col("node"), "left")
    named = materialise(named.select("id", "first", F.coalesce("component", "id").alias("root"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")), "named")
    least = materialise(named.groupBy("root").agg(F.min("first").alias("component_id")), "least")
    named = materialise(named.join(least, "root").select("id", "n_links", "component_id"), "named")
    out = rows.select("vec_id", F.when(valid, F.xxhash64("label", "embedding")).alias("id")).join(named, "id", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), (component == F.col("vec_id")).alias("kept"))
