"""Quality classifier: a factorisation machine over hashed words, structure statistics and size.

The pairwise part sum_{i<j} <v_i, v_j> x_i x_j is half of (sum_i v_i x_i)^2 - sum_i (v_i x_i)^2, so a
text is scored in time linear in its distinct features. Words are hashed to ``WORDS`` buckets (unit-length log
counts); shares of bytes and words are one-hot in ``BINS`` fixed bins; the metadata is the text's size, also in bins.

The model is fitted on the driver on at most ``SAMPLE`` labelled rows (the smallest hashes of the id), whatever the
corpus; scoring covers every whole text on the executors.

Defined results: null and empty texts have the structure features of an empty text and get a score; rows without
a label aren't learned from, nor are held-out ids and null ids; without labelled rows every score is 0.5; equal
texts get equal scores; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import chunks, held_out, lean, lower_ascii, materialise, slices, text_buffers, word_hashes, word_spans

WORDS, BINS, RANK = 1 << 14, 16, 8
SAMPLE = 8000
STATS = ("punctuation", "upper", "digits", "lines", "other_bytes", "spaces", "distinct_words", "word_length", "repeated_neighbours", "size")
FEATURES = WORDS + BINS * len(STATS)


def _class(ranges) -> np.ndarray:
    out = np.zeros(256, np.float64)
    for lo, hi in ranges:
        out[lo:hi + 1] = 1
    return out


_CLASSES = {
    "punctuation": _class([(0x21, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7E)]), "upper": _class([(0x41, 0x5A)]),
    "digits": _class([(0x30, 0x39)]), "lines": _class([(0x0A, 0x0A)]), "other_bytes": _class([(0x80, 0xFF)]), "spaces": _class([(0x20, 0x20)]),
}


def features(column) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per chunk: rows lo, hi, and the sorted features (row - lo, index, value)."""
    data, offsets = text_buffers(column)
    for lo, hi in chunks(offsets):
        raw, at = data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        n, size = hi - lo, np.maximum(np.diff(at), 1).astype(float)
        low = lower_ascii(raw)
        starts, ends, rows = word_spans(low, at)
        words = word_hashes(low, starts, ends)
        count = np.bincount(rows, minlength=n)
        bucket = (words >> np.uint64(50)).astype(np.int64)
        key, times = np.unique(rows * WORDS + bucket, return_counts=True)
        row, value = key // WORDS, np.log1p(times)
        value = value / np.sqrt(np.maximum(np.bincount(row, value * value, minlength=n), 1e-12))[row]
        stats = np.zeros((n, len(STATS)))
        for k, name in enumerate(STATS[:6]):
            run = np.concatenate(([0.0], np.cumsum(_CLASSES[name][raw])))
            share = (run[at[1:]] - run[at[:-1]]) / size
            stats[:, k] = np.sqrt(share)  # finer bins for small shares
        stats[:, 6] = np.bincount(row, minlength=n) / np.maximum(count, 1)
        stats[:, 7] = np.bincount(rows, ends - starts, minlength=n) / np.maximum(count, 1) / 16
        if len(words) > 1:
            same = (words[1:] == words[:-1]) & (rows[1:] == rows[:-1])
            stats[:, 8] = np.sqrt(np.bincount(rows[1:], same, minlength=n) / np.maximum(count, 1))
        stats[:, 9] = np.log2(1 + np.diff(at)) / 20
        bins = np.clip((stats * BINS).astype(np.int64), 0, BINS - 1) + WORDS + BINS * np.arange(len(STATS))
        rows_all = np.concatenate((row, np.repeat(np.arange(n), len(STATS))))
        index = np.concatenate((key % WORDS, bins.ravel()))
        values = np.concatenate((value, np.full(bins.size, 0.5)))
        by = np.argsort(rows_all, kind="stable")
        yield lo, hi, rows_all[by], index[by], values[by].astype(np.float32)


def raw_scores(model: dict, rows: np.ndarray, index: np.ndarray, values: np.ndarray, n: int):
    """Margin of each of n rows (every row has features), and the row sums of v x."""
    vx = model["v"][index] * values[:, None]
    first = np.searchsorted(rows, np.arange(n))
    total = np.add.reduceat(vx, first, axis=0)
    linear = np.add.reduceat(model["w"][index] * values, first)
    return model["bias"] + linear + 0.5 * ((total ** 2).sum(axis=1) - np.add.reduceat((vx ** 2).sum(axis=1), first)), total


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def train(rows: np.ndarray, index: np.ndarray, values: np.ndarray, labels: np.ndarray, *, epochs: int = 12, batch: int = 256,
          rate: float = 0.02, decay: float = 2e-4, seed: int = 3) -> dict:
    """Adam on the logistic loss. rows: sorted row numbers 0 .. len(labels) - 1."""
    rng = np.random.default_rng(seed)
    model = {"bias": np.float32(0), "w": np.zeros(FEATURES, np.float32), "v": (rng.standard_normal((FEATURES, RANK)) * 0.02).astype(np.float32)}
    n = len(labels)
    if not n:
        return model
    share = float(np.clip(labels.mean(), 0.02, 0.98))
    model["bias"] = np.float32(np.log(share / (1 - share)))
    moments = {k: [np.zeros_like(model[k]), np.zeros_like(model[k])] for k in ("bias", "w", "v")}
    edges, step = np.searchsorted(rows, np.arange(n + 1)), 0
    for _ in range(epochs):
        order = rng.permutation(n)
        for lo in range(0, n, batch):
            picked = order[lo:lo + batch]
            take = np.concatenate([np.arange(edges[r], edges[r + 1]) for r in picked])
            at = np.repeat(np.arange(len(picked)), edges[picked + 1] - edges[picked])
            i, x = index[take], values[take]
            margin, total = raw_scores(model, at, i, x, len(picked))
            g = ((sigmoid(margin) - labels[picked]) / len(picked)).astype(np.float32)
            used, inverse = np.unique(i, return_inverse=True)
            gw = np.bincount(inverse, g[at] * x, minlength=len(used)).astype(np.float32) + decay * model["w"][used]
            each = (g[at] * x)[:, None] * (total[at] - model["v"][i] * x[:, None])
            gv = np.zeros((len(used), RANK), np.float32)
            for f in range(RANK):
                gv[:, f] = np.bincount(inverse, each[:, f], minlength=len(used))
            gv += decay * model["v"][used]
            step += 1
            for k, grad, where in (("w", gw, used), ("v", gv, used), ("bias", g.sum(), ...)):
                m, s = moments[k]
                m[where] = 0.9 * m[where] + 0.1 * grad
                s[where] = 0.999 * s[where] + 0.001 * grad ** 2
                move = rate * (m[where] / (1 - 0.9 ** step)) / (np.sqrt(s[where] / (1 - 0.999 ** step)) + 1e-8)
                if k == "bias":
                    model[k] = np.float32(model[k] - move)
                else:
                    model[k][where] -= move
    return model


def fit(docs: DataFrame, labels: DataFrame, *, label: str = "quality", sample: int = SAMPLE) -> dict:
    """The model of a bounded sample of the rows that may be learned from."""
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    # at most ``sample`` (id, label) pairs: small enough to send to every task
    known = known.select(F.col("doc_id").alias("id"), F.col(label).cast("int").alias("y")).orderBy(F.xxhash64("doc_id"), "doc_id", label).limit(sample)
    rows = docs.select("doc_id", "text").join(F.broadcast(materialise(known, "labels")), F.col("doc_id") == F.col("id")).select("id", "y", "text")

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, row, index, values in features(batch.column(2)):
                edges = np.searchsorted(row, np.arange(hi - lo + 1)).astype(np.int32)
                part = batch.slice(lo, hi - lo)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.ListArray.from_arrays(edges, pa.array(index, pa.int32())),
                                                  pa.ListArray.from_arrays(edges, pa.array(values, pa.float32()))], names=["id", "y", "index", "values"])

    got = rows.mapInArrow(lean(extract), "id long, y int, index array<int>, values array<float>").toArrow().sort_by([("id", "ascending"), ("y", "ascending")])
    sizes = got.column("index").combine_chunks()
    index, values = (np.concatenate([np.zeros(0), *[c.flatten().to_numpy() for c in got.column(k).chunks]]) for k in ("index", "values"))
    counts = np.array([len(x) for x in sizes], np.int64)
    return train(np.repeat(np.arange(len(counts)), counts), index.astype(np.int64), values.astype(np.float32), got.column("y").to_numpy().astype(np.float32))


def score(docs: DataFrame, model: dict, *keep: str, text_at: int | None = None) -> DataFrame:
    """The columns ``keep`` of docs, and ``score``. ``text_at``: the text is that field of the first kept column, a
    struct, and does not travel a second time."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # FEATURES * (RANK + 1) numbers

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = np.full(batch.num_rows, 0.5)
            text = batch.column(len(keep)) if text_at is None else batch.column(0).field(text_at)
            for lo, hi, row, index, values in features(text):
                out[lo:hi] = sigmoid(raw_scores(shared.value, row, index, values, hi - lo)[0].astype(float))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], pa.array(out)], names=[*keep, "score"])

    picked = docs.select(*keep, *([F.col("text").alias("scored_text")] if text_at is None else []))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:len(keep)]) + ", score double"
    return picked.mapInArrow(lean(rows), schema)


def good_documents(docs: DataFrame, labels: DataFrame, *, least: float = 0.3, **options) -> DataFrame:
    """docs without those that score below ``least``."""
    model = fit(docs, labels, **options)
    rows = docs.select(F.struct(*docs.columns).alias("row"))
    at = [name.lower() for name in docs.columns].index("text")
    return score(rows, model, "row", text_at=at).where(F.col("score") >= least).select("row.*")
