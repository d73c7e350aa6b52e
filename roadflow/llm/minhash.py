"""Near-duplicate documents: MinHash bands, sequential Bayesian verification, exact confirmation.

1. Every whole text gives its number of distinct shingles, a hash of its word sequence and a MinHash signature.
   Texts with the same word sequence are one class from here on.
2. Band keys of the class representatives meet in buckets. Each member is paired with its bucket's
   smallest member (linear in the bucket, whatever its size).
3. Signature batches of a pair are compared one after the other; a pair is dropped as soon as the posterior
   probability of similarity >= threshold (uniform prior) is below ``miss``.
4. Survivors are confirmed on their full shingle sets.
5. Buckets that share members form groups. Groups that hold more than one component so far are gone through
   again, in blocks of about ``BLOCK`` members: pairs of different components that share a band are tested as in 3 and
   confirmed in the task, and only links that join two components leave it.

Defined results: null, empty and wordless texts have an empty set and are alone; with fewer words than a
shingle the whole sequence is the one shingle; null ids are the id -1 - (hash of the text), so they
take part; rows with equal ids share one result if their texts are equal, else the texts are linked with nothing through the id alone;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import CHUNK_BYTES, SLICE_ROWS, chunks, discard, lean, lower_ascii, mix64, seeds, shingle_hashes, slices, text_buffers, word_hashes, word_spans
from .common import materialise as _materialise
from .graph import components

ROWS, BANDS, BATCH, BATCHES = 4, 20, 16, 3
HASHES = ROWS * BANDS + BATCH * BATCHES
MISS = 1e-5
BLOCK = 512
FEW_IDS = 1 << 21  # 16 MB of ids are sent to every task, no more
_MULT = (seeds(HASHES, 5000) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def materialise(df: DataFrame, name: str) -> DataFrame:
    return _materialise(df, name, arrow_rows=SLICE_ROWS)


def text_sets(column, n: int) -> Iterator[tuple[int, np.ndarray, bytes]]:
    """(row, sorted distinct shingle hashes, hash of the word sequence) of each text, in order."""
    data, offsets = text_buffers(column)
    for lo, hi in chunks(offsets, CHUNK_BYTES):
        low = lower_ascii(data[offsets[lo]:offsets[hi]])
        starts, ends, rows = word_spans(low, offsets[lo:hi + 1] - offsets[lo])
        words = word_hashes(low, starts, ends)
        shingles, at = shingle_hashes(words, rows, hi - lo, n)
        first = np.concatenate(([0], np.cumsum(np.bincount(rows, minlength=hi - lo))))
        for r in range(hi - lo):
            yield lo + r, np.unique(shingles[at[r]:at[r + 1]]), hashlib.md5(words[first[r]:first[r + 1]].tobytes()).digest()


def signature(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), 1024):
        np.minimum(out, (x[k:k + 1024][None, :] * _MULT[:, None]).min(axis=1), out=out)
    return out


def band_values(sigs: np.ndarray) -> np.ndarray:
    """(n, BANDS) bucket keys of (n, HASHES) signatures."""
    parts = sigs[:, :ROWS * BANDS].reshape(len(sigs), BANDS, ROWS).astype(np.uint64)
    return mix64((parts * seeds(ROWS, 9000)).sum(axis=2, dtype=np.uint64) + np.arange(BANDS, dtype=np.uint64))


def checked_values(sigs: np.ndarray) -> np.ndarray:
    """The hashes that pairs are tested on, cut to 16 bits: equal hashes stay equal, so no pair is lost by that, and what
    passes by chance is confirmed exactly."""
    return sigs[:, ROWS * BANDS:].astype(np.uint16)


def _ident():
    return F.coalesce(F.col("doc_id").cast("long"), -1 - F.abs(F.xxhash64("text") % (1 << 60)))


def node():
    """A text under an id is a node of its own: different texts under one id are linked by nothing."""
    return F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))


def sketch(docs: DataFrame, n: int) -> DataFrame:
    """doc_id, id (``node``), n_shingles, class (hash of the word sequence), bands, sig (see ``band_values``, ``checked_values``), one row
    per row of docs."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sizes, keys, sigs = [], [], []
            for _, shingles, key in text_sets(batch.column(1), n):
                sizes.append(len(shingles))
                keys.append(key)
                sigs.append(signature(shingles)[None, :] if len(shingles) else None)
            bands = [None if x is None else band_values(x)[0].view(np.int64) for x in sigs]
            tests = [None if x is None else checked_values(x).tobytes() for x in sigs]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(tests, pa.binary())],
                                             names=["doc_id", "id", "n_shingles", "class", "bands", "sig"])

    return docs.select(_ident().alias("doc_id"), "text", node().alias("id")).mapInArrow(lean(rows), "doc_id long, id long, n_shingles long, class binary, bands array<long>, sig binary")


def fewest_matches(threshold: float, miss: float = MISS) -> list[int]:
    """After k batches, the fewest matching hashes with P(similarity >= threshold) >= miss. With a
    uniform prior that probability is P(Binomial(n + 1, threshold) <= matches)."""
    out = []
    for k in range(1, BATCHES + 1):
        n, tail = k * BATCH, 0.0
        for m in range(n + 1):
            tail += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if tail >= miss:
                out.append(m)
                break
    return out


def survives(left: np.ndarray, right: np.ndarray, fewest: list[int]) -> np.ndarray:
    """For rows of two arrays of ``checked_values``; hashes of the bands, by which the pair was found, are not among them."""
    alive = np.arange(len(left))
    matches = np.zeros(len(left), np.int64)
    for k in range(BATCHES):
        cols = slice(k * BATCH, (k + 1) * BATCH)
        matches[alive] += (left[alive, cols] == right[alive, cols]).sum(axis=1)
        alive = alive[matches[alive] >= fewest[k]]
    return alive


def verify_sequentially(pairs: DataFrame, threshold: float) -> DataFrame:
    """(a, b) of (a, b, siga, sigb) that survive every batch."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fewest = fewest_matches(threshold)
        for batch in batches:
            left, right = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, BATCH * BATCHES) for c in ("siga", "sigb"))
            yield batch.select(["a", "b"]).take(pa.array(survives(left, right, fewest)))

    return pairs.select("a", "b", "siga", "sigb").mapInArrow(lean(rows), "a long, b long")


def packed_texts(texts: DataFrame) -> DataFrame:
    """(id, packed): whole texts by zstd, as they travel to a join."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([pack((x.as_py() or "").encode()) for x in batch.column(1)], pa.binary())], names=["id", "packed"])

    return texts.select("id", "text").mapInArrow(lean(rows), "id long, packed binary")


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``packed_texts`` of the documents in ``ids`` (a written table of distinct ids). Up to ``FEW_IDS`` of them, 8 bytes each, are
    sent to every task, so that only their texts are packed and travel; beyond that both sides meet by a shuffle."""
    few = ids.count() <= FEW_IDS
    rows = docs.select(node().alias("id"), "text").join(F.broadcast(ids) if few else ids, "id", "left_semi")
    return packed_texts(rows)


def unpacked(column: pa.Array) -> pa.Array:
    import zstandard

    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([unpack(x.as_py()) for x in column], pa.binary()).cast(pa.string())


def confirm(pairs: DataFrame, docs: DataFrame, classes: DataFrame, n: int, threshold: float) -> DataFrame:
    """Pairs whose full shingle sets have similarity >= threshold, compared as integers; a written table."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, keys, sets = batch.column(0).to_numpy(zero_copy_only=False), [], []
            for _, shingles, key in text_sets(unpacked(batch.column(1)), n):
                keys.append(key)
                sets.append(shingles.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(sets, pa.list_(pa.int64()))], names=["id", "class", "shingles"])

    needed = materialise(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "needed")
    texts = texts_of(docs, needed)
    sets = texts.mapInArrow(lean(rows), "id long, class binary, shingles array<long>").join(
        classes.select(F.col("id").alias("rep"), F.col("class").alias("rep_class")),
        (F.col("id") == F.col("rep")) & (F.col("class") == F.col("rep_class")), "left_semi").dropDuplicates(["id"])
    sets = materialise(sets.select("id", "shingles"), "sets")
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("sb"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("sa", "sb"))
    percent = round(threshold * 100)
    links = both.withColumn("common", common).where(
        F.col("common") * 100 >= percent * (F.size("sa") + F.size("sb") - F.col("common"))).select("a", "b")
    links = materialise(links, "links")
    discard(needed, sets)
    return links


def cross_links(mixed: DataFrame, docs: DataFrame, classes: DataFrame, n: int, threshold: float) -> DataFrame:
    """(a, b), a written table: a spanning forest of the confirmed links between different components of one group. ``mixed``: group, size,
    id, component. A group of over BLOCK members is split into blocks; each pair of blocks is a task's work:
    pairs that share a band, then the sequential test, then exact intersections. No pair leaves the task unless it joins
    two components."""
    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            got = list(text_sets(unpacked(batch.column(1)), n))
            sigs = [signature(x)[None, :] for _, x, _ in got]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([k for _, _, k in got], pa.binary()), pa.array([band_values(x).tobytes() for x in sigs], pa.binary()),
                                              pa.array([checked_values(x).tobytes() for x in sigs], pa.binary()), pa.array([x.tobytes() for _, x, _ in got], pa.binary())],
                                             names=["id", "class", "bands", "sig", "shingles"])

    texts = texts_of(docs, mixed.select("id"))
    found = texts.mapInArrow(lean(sets), "id long, class binary, bands binary, sig binary, shingles binary")
    reps = classes.select("id", "class")
    found = materialise(found.join(reps, ["id", "class"], "left_semi").dropDuplicates(["id"]).select("id", "bands", "sig", "shingles"), "sets")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = mixed.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    placed = placed.join(found, "id").select("group", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "id", "component", "bands", "sig", "shingles")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fewest, percent = fewest_matches(threshold), round(threshold * 100)
        for bounds, t in whole_groups(batches, ("group", "i", "j")):
            for s, e in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                g = t.slice(s, e - s)
                a, b = _links(g, fewest, percent)
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    links = placed.repartition("group", "i", "j").sortWithinPartitions("group", "i", "j", "id").mapInArrow(lean(rows), "a long, b long")
    links = materialise(links, "links")
    discard(found)
    return links


def _links(g: pa.Table, fewest: list[int], percent: int) -> tuple[np.ndarray, np.ndarray]:
    ids, comps, block = (g.column(c).to_numpy() for c in ("id", "component", "block"))
    i, j = g.column("i")[0].as_py(), g.column("j")[0].as_py()
    left = np.arange(len(ids)) if i == j else np.flatnonzero(block == i)
    right = left if i == j else np.flatnonzero(block == j)
    sigs = np.frombuffer(b"".join(g.column("sig").to_pylist()), np.uint16).reshape(-1, BATCH * BATCHES)
    bands = np.frombuffer(b"".join(g.column("bands").to_pylist()), np.uint64).reshape(-1, BANDS).T
    met = np.zeros((len(left), len(right)), bool)
    for key in bands:
        met |= key[left][:, None] == key[right][None, :]
    met &= comps[left][:, None] != comps[right][None, :]
    if i == j:
        met = np.triu(met, 1)
    a, b = np.nonzero(met)
    if not len(a):
        return a, b
    ok = survives(sigs[left[a]], sigs[right[b]], fewest)
    a, b = a[ok], b[ok]
    sets = [np.frombuffer(x, np.uint64) for x in g.column("shingles").to_pylist()]
    size = np.array([len(x) for x in sets], np.int64)
    common = common_counts([sets[k] for k in left], [sets[k] for k in right], a, b)
    ok = common * 100 >= percent * (size[left[a]] + size[right[b]] - common)
    a, b = left[a[ok]], right[b[ok]]
    if not len(a):
        return a, b
    # a forest over the components is enough to join them
    names, at = np.unique(comps, return_inverse=True)
    parent, keep = list(range(len(names))), []
    for k, (x, y) in enumerate(zip(at[a].tolist(), at[b].tolist())):
        while parent[x] != x:
            x = parent[x]
        while parent[y] != y:
            y = parent[y]
        if x != y:
            parent[max(x, y)] = min(x, y)
            keep.append(k)
    return ids[a[keep]], ids[b[keep]]


def common_counts(left: list[np.ndarray], right: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the pairs (left[a], right[b]): one by one if few, else as products of 0/1 matrices over
    slices of the shingles."""
    if len(a) < 4 * (len(left) + len(right)):
        return np.array([len(np.intersect1d(left[x], right[y], assume_unique=True)) for x, y in zip(a.tolist(), b.tolist())], np.int64)
    use_l, use_r = np.unique(a), np.unique(b)
    all_l, all_r = np.concatenate([left[k] for k in use_l]), np.concatenate([right[k] for k in use_r])
    shared = np.intersect1d(all_l, all_r)
    row_l, row_r = np.repeat(np.arange(len(use_l)), [len(left[k]) for k in use_l]), np.repeat(np.arange(len(use_r)), [len(right[k]) for k in use_r])
    total = np.zeros((len(use_l), len(use_r)), np.float32)
    for lo in range(0, len(shared), 4096):
        part = shared[lo:lo + 4096]
        m = []
        for values, row, n in ((all_l, row_l, len(use_l)), (all_r, row_r, len(use_r))):
            col = np.minimum(np.searchsorted(part, values), len(part) - 1)
            hit = part[col] == values
            x = np.zeros((n, len(part)), np.float32)
            x[row[hit], col[hit]] = 1
            m.append(x)
        total += m[0] @ m[1].T
    return total[np.searchsorted(use_l, a), np.searchsorted(use_r, b)].astype(np.int64)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[np.ndarray, pa.Table]]:
    """(group bounds, table) of a sorted stream; no group is split between tables."""
    rest = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        t = pa.concat_tables([rest, t]) if rest is not None else t
        if not t.num_rows:
            continue
        bounds = _bounds(t, keys)
        cut = int(bounds[-2])  # the last group may go on
        if cut:
            yield bounds[:-1], t.slice(0, cut).combine_chunks()
        rest = t.slice(cut)
    if rest is not None and rest.num_rows:
        yield _bounds(rest, keys), rest.combine_chunks()


def _bounds(t: pa.Table, keys: tuple[str, ...]) -> np.ndarray:
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for k in keys:
        c = t.column(k).to_numpy()
        new[1:] |= c[1:] != c[:-1]
    return np.append(np.flatnonzero(new), t.num_rows)


def near_duplicates(docs: DataFrame, *, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per row of docs: doc_id, n_shingles, component_id, kept."""
    return near_groups(docs, n=n, threshold=threshold).select("doc_id", "n_shingles", "component_id", "kept")


def near_groups(docs: DataFrame, *, n: int = 5, threshold: float = 0.8) -> DataFrame:
    """As ``near_duplicates``, with id (``node``) and component (a node that stands for the component): two components can have
    the same smallest doc_id."""
    rows = materialise(sketch(docs, n), "sketch")
    classes = rows.where("n_shingles > 0").groupBy("class").agg(F.min("id").alias("id"), F.min("doc_id").alias("low"))
    classes = materialise(classes, "classes")
    sigs = rows.join(classes, (rows["class"] == classes["class"]) & (rows["id"] == classes["id"]), "left_semi")
    sigs = materialise(sigs.dropDuplicates(["id"]).select("id", "bands", "sig"), "signatures")
    keys = sigs.select(F.explode("bands").alias("key"), "id")
    buckets = materialise(keys.groupBy("key").agg(F.min("id").alias("lead"), F.count("*").alias("n")).where("n > 1").select("key", "lead"), "buckets")
    members = keys.join(buckets, "key")

    def tested(pairs: DataFrame) -> DataFrame:
        a = sigs.select(F.col("id").alias("a"), F.col("sig").alias("siga"))
        b = sigs.select(F.col("id").alias("b"), F.col("sig").alias("sigb"))
        return verify_sequentially(pairs.join(a, "a").join(b, "b"), threshold)

    lead_pairs = materialise(members.where("id != lead").select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct(), "leads")
    pairs = materialise(tested(lead_pairs), "pairs")
    discard(buckets, sigs)
    links = confirm(pairs, docs, classes, n, threshold)
    discard(pairs)
    found = components(links)
    # buckets that share members are one group: a document is in one group, whatever its bands
    groups = components(lead_pairs)
    discard(lead_pairs)
    named = groups.select(F.col("node").alias("id"), F.col("component").alias("group")).join(found, F.col("id") == F.col("node"), "left")
    named = materialise(named.select("id", "group", F.coalesce("component", "id").alias("component")), "named")
    mixed = named.groupBy("group").agg(F.min("component").alias("x"), F.max("component").alias("y"), F.count("*").alias("size")).where("x != y")
    mixed = materialise(mixed.select("group", "size"), "mixed")
    members = materialise(named.join(mixed, "group"), "mixed")
    more = cross_links(members, docs, classes, n, threshold)
    found = components(links.unionByName(more))
    of_class = classes.join(found, classes["id"] == found["node"], "left").select("class", F.coalesce("component", "id").alias("component"), "low")
    by_component = materialise(of_class, "components")
    # a written table, so that a large component's rows can be split in the join
    lowest = materialise(by_component.groupBy("component").agg(F.min("low").alias("component_id")), "lowest")
    of_class = materialise(by_component.drop("low").join(lowest, "component"), "components")
    discard(links, more, named, mixed, members, classes, by_component, lowest, groups, found)
    out = rows.join(of_class, "class", "left")
    return out.select("doc_id", "id", "n_shingles", F.coalesce("component", "id").alias("component"), F.coalesce("component_id", "doc_id").alias("component_id"),
                      (F.coalesce("component_id", "doc_id") == F.col("doc_id")).alias("kept"))
