"""Approximate nearest neighbours by inner product: inverted lists, scanned by adaptive dimensions.

Lists come from spherical k-means on a bounded sample; every row is indexed. Rows of unequal norms get one more
column for this, which makes their norms equal (``lifted``): inner products with a query, which has 0 there, stay as they are. Rows longer than every sampled one, of which the
calibration can know nothing, are a list that every query scans. Vectors are turned by a random
rotation, after which each block of columns is a fair sample of a product. Within a probed list the columns are
scanned in blocks: after each block the hypothesis is tested that a candidate's product reaches the query's current k-th best score; it is
abandoned when its partial product lies ``Z`` deviations under what that would lead to expect (``least_partial``). ``Z`` follows from the chance
``MISS`` of abandoning a row wrongly. Survivors are scored in double precision on the original vectors.

The number of probed lists is calibrated on the sample's original vectors against brute force (inner products; ``target`` of its true neighbours must lie in them),
and a query goes on to further lists until those hold at least ``4 k`` rows. A task's group is a block of queries that live near
each other and a chunk of the rows of all lists that any of them probes. The group streams, the block's own lists first,
so the k-th best score found there is what rows of further lists are tested against, and a group returns k rows a query.

Defined results: vectors that are null, empty, zero or hold null or non-finite components, and rows without an
id, take no part; vectors of other lengths than the commonest are compared among themselves by full scan; a query
isn't its own neighbour, nor are other rows of its id; repeated queries are answered once; ties go to the smaller
id; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialise
from .vectors import SAMPLE, matrix, sample_rows, spherical_kmeans, unit, usable

K, PER_LIST, PER_CENTRE, COLUMNS, TARGET = 20, 4000, 8, 16, 0.96  # PER_CENTRE: sampled vectors that a centroid stands for at least
MISS = 0.001  # chance that a test abandons a row that belongs to the k best
Z = NormalDist().inv_cdf(1 - MISS)
LONG = 1 << 30  # the list of rows longer than any sampled one: all queries scan it
QUERY_BLOCK, ROW_CHUNK, STRIP = 1024, 1 << 17, 512
FEW = 0.02  # share of the pairs in play from which on they are followed one by one


def rotation(dim: int, seed: int = 5) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, dim)))
    return q * np.sign(np.diag(r))


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def lifted(x: np.ndarray, largest: float) -> np.ndarray:
    """Unit vectors with one more column, which makes up what a row's norm lacks of the ``largest`` (longer rows: nothing is lacking).
    A query, with 0 there, has by them the order of its inner products."""
    x = x / max(largest, 1e-300)
    return unit(np.hstack((x, np.sqrt(np.maximum(0.0, 1 - (x * x).sum(axis=1, keepdims=True))))))


def calibrate(sample: np.ndarray, centres: np.ndarray, k: int, target: float, queries: int = 300) -> int:
    """How many lists, best first, hold ``target`` of the true neighbours, by inner product, of sampled queries. Centres with one column more
    than the sample are those of ``lifted`` rows."""
    if len(sample) < 2 or len(centres) < 2:
        return 1
    rows, columns = sample, sample.shape[1]
    if centres.shape[1] > columns:
        rows, centres, whole = lifted(sample, norms(sample).max()), centres[:, :columns], centres
    else:
        whole = centres
    q = sample[np.linspace(0, len(sample) - 1, min(queries, len(sample))).astype(int)]
    cell = (rows @ whole.T).argmax(axis=1)
    score = q @ sample.T
    score[np.arange(len(q)), np.linspace(0, len(sample) - 1, len(q)).astype(int)] = -np.inf  # a query itself need not come first
    true = np.argsort(-score, axis=1)[:, :min(k, len(sample) - 1)]
    rank = np.argsort(np.argsort(-(q @ centres.T), axis=1), axis=1)
    need = np.sort(np.take_along_axis(rank, cell[true], axis=1).ravel())
    return int(need[min(len(need) - 1, int(np.ceil(target * len(need))))]) + 1


def least_partial(bar: np.ndarray, size: np.ndarray, seen: int, dim: int, z: float) -> np.ndarray:
    """The partial product over ``seen`` of ``dim`` columns below which a whole product of ``bar`` or more is rejected. Under a random rotation the
    part of a product T of vectors whose norms multiply to N has mean T c / d and the variance
    c (d - c) / (d (d + 2)) (2 T^2 / d + (N^2 - T^2) / (d - 1))."""
    if seen == dim:
        return bar
    known = np.isfinite(bar)
    t = np.where(known, bar, 0.0)
    spread = np.sqrt(seen * (dim - seen) / (dim * (dim + 2)) * (2 * t * t / dim + np.maximum(size * size - t * t, 0) / (dim - 1)))
    return np.where(known, t * seen / dim - z * spread, -np.inf)


class Scan:
    """The k best rows of a block of queries, over any number of strips of rows; what is held is k rows a query.

    Strips are scanned by blocks of turned columns. While many pairs are still in play a block is one matrix product; when few are,
    they are followed one by one. The k-th best score of a query, from all strips before, is what its test measures against."""

    def __init__(self, queries: np.ndarray, query_ids: np.ndarray, k: int, turn: np.ndarray | None, columns: int = COLUMNS, z: float = Z):
        self.x, self.ids, self.k, self.turn, self.z = queries, query_ids, k, turn, z
        dim = queries.shape[1]
        self.edges = [*range(0, dim, columns), dim] if turn is not None else [0, dim]
        self.turned = queries if turn is None else queries @ turn
        self.size = norms(queries)
        self.score = np.full((len(queries), k), -np.inf)
        self.found = np.full((len(queries), k), np.iinfo(np.int64).max)

    def add(self, rows: np.ndarray, row_ids: np.ndarray, who: np.ndarray | None = None) -> None:
        """Rows for the queries ``who`` (all if None)."""
        who = np.arange(len(self.x)) if who is None else who
        for lo in range(0, len(rows), STRIP):
            self._strip(rows[lo:lo + STRIP], row_ids[lo:lo + STRIP], who)

    def _strip(self, rows: np.ndarray, row_ids: np.ndarray, who: np.ndarray) -> None:
        edges, dim = self.edges, self.x.shape[1]
        turned = rows if self.turn is None else rows @ self.turn
        q, bar, longest = self.turned[who], self.score[who, -1] - 1e-9, norms(rows).max()
        value = q[:, :edges[1]] @ turned[:, :edges[1]].T
        alive = self.ids[who][:, None] != row_ids[None, :]
        a = b = None  # the pairs in play, once they are few
        for level, (s, e) in enumerate(zip(edges, edges[1:])):
            if level and a is None:
                value += q[:, s:e] @ turned[:, s:e].T
            elif level:
                value = value + np.einsum("ij,ij->i", q[a, s:e], turned[b, s:e])
            least = least_partial(bar, self.size[who] * longest, e, dim, self.z)
            if a is None:
                alive &= value >= least[:, None]
                if e == dim or np.count_nonzero(alive) < FEW * alive.size:
                    a, b = np.nonzero(alive)
                    value = value[a, b]
            else:
                ok = value >= least[a]
                a, b, value = a[ok], b[ok], value[ok]
        if not len(a):
            return
        exact = np.einsum("ij,ij->i", self.x[who[a]], rows[b])
        # the k best of what is held and what came
        changed = np.flatnonzero(np.bincount(a, minlength=len(who)))
        held = who[changed]
        owner = np.concatenate((np.repeat(np.arange(len(who))[changed], self.k), a))
        score = np.concatenate((self.score[held].ravel(), exact))
        ids = np.concatenate((self.found[held].ravel(), row_ids[b]))
        order = np.lexsort((ids, -score, owner))
        owner, score, ids = owner[order], score[order], ids[order]
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        ok = place < self.k
        self.score[who[owner[ok]], place[ok]], self.found[who[owner[ok]], place[ok]] = score[ok], ids[ok]

    def best(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query index, row id, score), best first."""
        q, c = np.nonzero(self.score > -np.inf)
        return q, self.found[q, c], self.score[q, c]


def nearest(vectors: DataFrame, queries: Column, *, k: int = K, per_list: int = PER_LIST, sample: int = SAMPLE, target: float = TARGET,
            query_block: int = QUERY_BLOCK, row_chunk: int = ROW_CHUNK) -> DataFrame:
    """query_id, rank, vec_id, score: for every row that meets the condition ``queries``, its k nearest rows found."""
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id").cast("long").alias("id"), queries.alias("asks"), "embedding", F.size("embedding").alias("dim"))
    dims = rows.groupBy("dim").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "dim").limit(1).collect()
    dim, n = (dims[0]["dim"], dims[0]["n"]) if dims else (0, 0)
    sampled = sample_rows(rows.where(F.col("dim") == dim), sample, original=True) if dims else np.zeros((0, 1))
    longest = float(norms(sampled).max()) if len(sampled) else 0.0
    equal = not len(sampled) or norms(sampled).min() >= (1 - 1e-3) * longest
    centres = spherical_kmeans((unit(sampled) if len(sampled) else sampled) if equal else lifted(sampled, longest), min(max(1, len(sampled) // PER_CENTRE), max(1, n // per_list)))
    probes = calibrate(sampled, centres, k, target)
    turn = rotation(dim) if dim else None

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column("dim").to_numpy()
            lists = -size.astype(np.int64)
            at = np.flatnonzero(size == dim)
            if len(at):
                x = matrix(batch.column("embedding").take(pa.array(at)))
                best = ((unit(x) if equal else lifted(x, longest)) @ centres.T).argmax(axis=1)
                lists[at] = np.where(norms(x) > (1 + 1e-3) * longest, LONG, best)
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.int64()), *(batch.column(c) for c in ("id", "asks", "embedding", "dim"))], names=["list", "id", "asks", "embedding", "dim"])

    vector = rows.schema["embedding"].dataType.simpleString()
    listed = materialise(rows.select("id", "asks", "embedding", "dim").mapInArrow(assign, f"list long, id long, asks boolean, embedding {vector}, dim int"), "lists")
    sizes = {r["list"]: r["n"] for r in listed.groupBy("list").agg(F.count("*").alias("n")).collect()}  # the centroids and the other lengths

    counts = {r["list"]: r["n"] for r in listed.where("asks").groupBy("list").agg(F.count("*").alias("n")).collect()}
    starts = dict(zip(sorted(counts), np.concatenate(([0], np.cumsum([counts[c] for c in sorted(counts)]))).tolist()))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each query's block, and the lists that it probes. Queries of one list are in the same block or in neighbouring ones."""
        held = np.array([sizes.get(c, 0) for c in range(len(centres))])
        for batch in batches:
            size, home = batch.column("dim").to_numpy(), batch.column("list").to_numpy()
            place = np.array([starts[c] + h % counts[c] for c, h in zip(home.tolist(), batch.column("hash").to_numpy().tolist())], np.int64)
            lists: list[np.ndarray] = [np.array([-d], np.int64) for d in size.tolist()]
            at = np.flatnonzero(size == dim)
            if len(at):
                order = np.argsort(-(unit(matrix(batch.column("embedding").take(pa.array(at)))) @ centres[:, :dim].T), axis=1, kind="stable")
                before = np.cumsum(held[order], axis=1) - held[order]
                go = (np.arange(len(centres))[None, :] < probes) | (before < 4 * k + 1)
                for r, o, g in zip(at.tolist(), order, go):
                    lists[r] = np.append(o[g], LONG) if sizes.get(LONG) else o[g]
            yield pa.RecordBatch.from_arrays([pa.array(place // query_block, pa.int64()), batch.column("id"), batch.column("embedding"), pa.array(home, pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                                             names=["j", "id", "embedding", "home", "lists"])

    asked = listed.where("asks").dropDuplicates(["id"]).select("id", "embedding", "dim", "list", F.xxhash64("id").bitwiseAND(F.lit((1 << 62) - 1)).alias("hash"))
    asked = materialise(asked.mapInArrow(probe, f"j long, id long, embedding {vector}, home long, lists array<long>"), "probes")
    # which lists a block of queries needs; those that are home to most of its queries come first
    needs = asked.select("j", "home", F.explode("lists").alias("list")).groupBy("j", "list").agg(F.count_if(F.col("home") == F.col("list")).alias("homes"))
    chunks = max(1, -(-sum(sizes.values()) // row_chunk))
    chunk = F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int")
    none = F.lit(None)
    left = listed.select("list", "id", "embedding").join(materialise(needs, "needs"), "list").select(
        "j", chunk.alias("i"), (-F.col("homes")).alias("late"), "list", "id", "embedding", none.cast("array<long>").alias("lists"))
    right = asked.select("j", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("i"), F.lit(-(1 << 62)).alias("late"), none.cast("long").alias("list"), "id", "embedding", "lists")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A group is a block of queries, then rows, list by list; it streams: held are the queries, their k best and a batch of rows."""
        now, asks, block, owners = None, [], None, {}
        for batch in batches:
            js, is_, lists = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("j", "i", "list"))
            fresh = np.isnan(lists) if lists.dtype.kind == "f" else np.zeros(len(lists), bool)
            lists = np.where(fresh, 0, lists).astype(np.int64)
            new = np.ones(len(js), bool)
            new[1:] = (js[1:] != js[:-1]) | (is_[1:] != is_[:-1]) | (lists[1:] != lists[:-1]) | (fresh[1:] != fresh[:-1])
            edges = np.append(np.flatnonzero(new), len(js)).tolist()
            for s, e in zip(edges, edges[1:]):
                if (js[s], is_[s]) != now:
                    if block is not None:
                        yield _found(block)
                    now, asks, block = (js[s], is_[s]), [], None
                part = batch.slice(s, e - s)
                if fresh[s]:
                    asks.append(part)
                    continue
                if block is None:
                    if not asks:
                        continue
                    t = pa.Table.from_batches(asks)
                    block, owners = _block(t, dim, k, turn), _owners(t.column("lists").to_pylist())
                who, at = owners.get(int(lists[s]), none_), block.get(int(lists[s]) if lists[s] < 0 else -dim)
                if len(who) and at is not None:
                    at[0].add(matrix(part.column("embedding")), part.column("id").to_numpy(), at[1][who])
        if block is not None:
            yield _found(block)

    none_ = np.zeros(0, np.int64)
    parts = left.unionByName(right).repartition("j", "i").sortWithinPartitions("j", "i", "late", "list")
    found = parts.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _owners(lists: list[list[int]]) -> dict[int, np.ndarray]:
    """list -> the queries (numbers) that probe it."""
    who = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    flat = np.array([c for x in lists for c in x], np.int64)
    by = np.argsort(flat, kind="stable")
    flat, who = flat[by], who[by]
    edges = np.append(np.flatnonzero(np.append(True, flat[1:] != flat[:-1])), len(flat)) if len(flat) else np.zeros(1, np.int64)
    return {int(flat[s]): who[s:e] for s, e in zip(edges[:-1].tolist(), edges[1:].tolist())}


def _block(t: pa.Table, dim: int, k: int, turn: np.ndarray | None) -> dict[int, tuple[Scan, np.ndarray]]:
    """Queries of a block, by length (key: minus the length): their scan, and each query's number in it. Only the commonest length has
    lists and a rotation."""
    size = np.array([len(x) for x in t.column("embedding")], np.int64)
    out = {}
    for d in np.unique(size).tolist():
        at = np.flatnonzero(size == d)
        number = np.full(len(size), -1, np.int64)
        number[at] = np.arange(len(at))
        part = t.take(pa.array(at))
        out[-d] = Scan(matrix(part.column("embedding")), part.column("id").to_numpy(), k, turn if d == dim else None), number
    return out


def _found(block: dict[int, tuple[Scan, np.ndarray]]) -> pa.RecordBatch:
    got = [(s.ids[q], ids, score) for s, _ in block.values() for q, ids, score in [s.best()]]
    parts = [np.concatenate(x) for x in zip(*got)]
    return pa.RecordBatch.from_arrays([pa.array(parts[0], pa.int64()), pa.array(parts[1], pa.int64()), pa.array(parts[2], pa.float64())], names=["query_id", "vec_id", "score"])
