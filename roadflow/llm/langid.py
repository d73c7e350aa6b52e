"""Language ID for mixed-language text: script ranges, per-word scores, Viterbi with a switching penalty.

A word is a run of letters. Its script (by code point ranges) leaves only the languages that were learned
with at least ``SHARE`` of their words in that script; its score for a language is the sum of the
log probabilities of its character trigrams (with word ends), hashed to ``BUCKETS`` per language. The Viterbi path
over a text's words pays ``PENALTY`` for each change of language; its runs are the labelled spans. Texts of
a batch are stepped through together, so each step is a few array operations.

Counts cover all documents that may be learned from; what reaches the driver is one table of ``BUCKETS``
numbers per language.

Defined results: a null text, or one without letters, is ``und`` with score 0; a script that no language
was learned with leaves all languages; ties go to the language first in code-point order; null languages, null
ids and held-out ids are not learned from; if nothing was learned all is ``und``; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import held_out, mix64, seeds

BUCKETS, PENALTY, SHARE, SMOOTH = 1 << 16, 12.0, 0.01, 0.5
CHUNK = 4 << 20  # characters
# fixed values: code point ranges of the larger scripts
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF)], "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)], "cyrillic": [(0x400, 0x52F)],
    "armenian": [(0x530, 0x58F)], "hebrew": [(0x590, 0x5FF)], "arabic": [(0x600, 0x6FF), (0x750, 0x77F)], "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)], "tamil": [(0xB80, 0xBFF)], "thai": [(0xE00, 0xE7F)], "georgian": [(0x10A0, 0x10FF)], "hangul": [(0x1100, 0x11FF), (0xAC00, 0xD7A3)],
    "kana": [(0x3040, 0x30FF)], "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FA1F)],
}
_MULT = seeds(3, 7000)
_tables: dict[str, np.ndarray] = {}


def _char_tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: is it a letter; its script (0: other)."""
    if not _tables:
        letters = np.zeros(0x110000, bool)
        everything = "".join(map(chr, range(0xD800))) + "".join(map(chr, range(0xE000, 0x110000)))
        for m in regex.finditer(r"[\p{L}\p{M}]+", everything):
            lo, hi = (x if x < 0xD800 else x + 0x800 for x in m.span())
            letters[lo:hi] = True
        script = np.zeros(0x110000, np.int64)
        for k, ranges in enumerate(SCRIPTS.values(), 1):
            for lo, hi in ranges:
                script[lo:hi + 1] = k
        _tables.update(letters=letters, script=script)
    return _tables["letters"], _tables["script"]


def text_chunks(texts: list[str | None]) -> Iterator[tuple[int, int, list[str]]]:
    lo, size = 0, 0
    for k, t in enumerate(texts):
        if size and size + len(t or "") > CHUNK:
            yield lo, k, [x or "" for x in texts[lo:k]]
            lo, size = k, 0
        size += len(t or "")
    if lo < len(texts):
        yield lo, len(texts), [x or "" for x in texts[lo:]]


def words_of(texts: list[str]):
    """Code points' words: (row, start and end in the text, script, trigram buckets, word of each trigram).

    Lower-casing that changes a text's length would shift the spans, so such a text keeps its case."""
    letters, script = _char_tables()
    low = [y if len(y := x.lower()) == len(x) else x for x in texts]
    points = np.frombuffer(("\n".join(low) + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.concatenate(([0], np.cumsum([len(x) + 1 for x in low])))
    inside = letters[points]
    edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    rows = np.searchsorted(at[1:], starts, side="right")
    # a trigram around every letter, blanks beyond the word
    c = np.where(inside, points, np.uint32(32)).astype(np.uint64)
    left, right = np.roll(c, 1), np.roll(c, -1)
    where = np.flatnonzero(inside)
    left[0], right[-1] = 32, 32
    h = mix64(left[where] * _MULT[0] + c[where] * _MULT[1] + right[where] * _MULT[2])
    word = np.repeat(np.arange(len(starts)), ends - starts)
    return rows, starts - at[rows], ends - at[rows], script[points[starts]] if len(starts) else starts, (h >> np.uint64(48)).astype(np.int64), word


def learn(docs: DataFrame) -> dict:
    """langs, logp (BUCKETS x langs), allowed (scripts x langs)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n_scripts = len(SCRIPTS) + 1
        counts: dict[str, np.ndarray] = defaultdict(lambda: np.zeros(BUCKETS + n_scripts, np.int64))
        for batch in batches:
            langs = batch.column(0).to_pylist()
            for lo, hi, texts in text_chunks(batch.column(1).to_pylist()):
                row, _, _, script, bucket, word = words_of(texts)
                names, code = np.unique(np.array(langs[lo:hi], dtype=object).astype(str), return_inverse=True)
                for k, name in enumerate(names):
                    mine = code[row] == k
                    counts[str(name)][:BUCKETS] += np.bincount(bucket[mine[word]], minlength=BUCKETS)
                    counts[str(name)][BUCKETS:] += np.bincount(script[mine], minlength=n_scripts)
        for name, c in counts.items():
            used = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(used), pa.string()), pa.array(used, pa.int32()), pa.array(c[used], pa.int64())], names=["lang", "bucket", "n"])

    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    got = known.select("lang", "text").mapInArrow(rows, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(got["lang"].unique())
    c = np.zeros((BUCKETS + len(SCRIPTS) + 1, max(1, len(langs))))
    c[got["bucket"].to_numpy(int), np.searchsorted(langs, got["lang"].to_numpy(str)) if langs else np.zeros(0, int)] = got["n"]
    grams, scripts = c[:BUCKETS], c[BUCKETS:]
    logp = np.log((grams + SMOOTH) / (grams.sum(axis=0) + SMOOTH * BUCKETS))
    allowed = scripts >= SHARE * np.maximum(scripts.sum(axis=0), 1)
    allowed[~allowed.any(axis=1)] = True
    return {"langs": langs, "logp": logp.astype(np.float32), "allowed": allowed}


def viterbi(scores: np.ndarray, rows: np.ndarray, n_rows: int, penalty: float) -> np.ndarray:
    """The best language of every word; words of a row are in order. All rows advance together, the
    longest first, so the rows still running are always the first ones."""
    counts = np.bincount(rows, minlength=n_rows)
    first = np.concatenate(([0], np.cumsum(counts)))[:-1]
    order = np.argsort(-counts, kind="stable")
    first, counts = first[order], counts[order]
    n_langs = scores.shape[1]
    back = np.zeros(scores.shape, np.uint8 if n_langs < 256 else np.uint32)
    best = np.zeros((n_rows, n_langs))
    same = np.arange(n_langs)
    running = np.searchsorted(-counts, -np.arange(counts[0] if n_rows else 0), side="left")  # rows with more than t words
    for t, k in enumerate(running):
        at = first[:k] + t
        if t:
            top = best[:k].argmax(axis=1)
            other = best[np.arange(k), top][:, None] - penalty
            stay = best[:k] >= other
            back[at] = np.where(stay, same, top[:, None])
            best[:k] = np.where(stay, best[:k], other)
        best[:k] += scores[at]
    out = np.zeros(len(scores), np.int64)
    now = best.argmax(axis=1)
    for t in range(len(running) - 1, -1, -1):
        k = running[t]
        at = first[:k] + t
        out[at] = now[:k]
        if t:
            now[:k] = back[at, now[:k]]
    return out


def label_spans(docs: DataFrame, model: dict, *keep: str, penalty: float = PENALTY) -> DataFrame:
    """The columns ``keep``, lang_pred, score (share of the letters in spans of that language), and
    spans array<struct<start, stop, lang>> in characters."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        langs, logp, allowed = (shared.value[k] for k in ("langs", "logp", "allowed"))
        for batch in batches:
            preds, scores, spans = [], [], []
            for lo, hi, texts in text_chunks(batch.column(batch.num_columns - 1).to_pylist()):
                n = hi - lo
                row, start, end, script, bucket, word = words_of(texts)
                if not len(row) or not langs:
                    preds += ["und"] * n
                    scores += [0.0] * n
                    spans += [[]] * n
                    continue
                s = np.stack([np.bincount(word, logp[bucket, k], minlength=len(row)) for k in range(len(langs))], axis=1)
                s = np.where(allowed[script], s, -1e6).astype(np.float32)
                label = viterbi(s, row, n, penalty)
                share = np.bincount(row * len(langs) + label, end - start, minlength=n * len(langs)).reshape(n, -1)
                total, top = share.sum(axis=1), share.argmax(axis=1)
                preds += [langs[k] if t else "und" for k, t in zip(top, total)]
                scores += (share.max(axis=1) / np.maximum(total, 1)).tolist()
                edge = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (label[1:] != label[:-1]))))
                last = np.append(edge[1:], len(row)) - 1
                own: list[list] = [[] for _ in range(n)]
                for a, b in zip(edge.tolist(), last.tolist()):
                    own[row[a]].append({"start": int(start[a]), "stop": int(end[b]), "lang": langs[label[a]]})
                spans += own
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(preds, pa.string()), pa.array(scores, pa.float64()),
                                              pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("lang", pa.string())])))],
                                             names=[*keep, "lang_pred", "score", "spans"])

    picked = docs.select(*keep, F.col("text").alias("labelled_text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1])
    return picked.mapInArrow(rows, f"{schema}, lang_pred string, score double, spans array<struct<start: int, stop: int, lang: string>>")
