"""Removal of repeated passages by suffix arrays (two-stage sorting) over bytes.

A byte goes if a ``length``-byte string covers it that also starts earlier (smaller document, or
earlier in the same one). All suffixes of a corpus don't fit one sort, so strings are dealt out by content first:

1. Every ``length``-byte string is assigned to its anchor, the smallest hash among its ``GRAM``-byte
   substrings (leftmost if tied). Equal strings have equal anchors, so strings whose
   anchor hash occurs once in the corpus occur once themselves. The strings of one anchor
   form a run; a task keeps the first of runs with equal bytes and resolves the others on the spot.
2. Runs whose anchor occurs more than once are cut out of their documents and grouped by anchor hash.
   Anchors of over ``HOT`` runs (a line that is in a third of all documents) are dealt out string by string.
3. Each task sorts the suffixes of the distinct runs of its groups: only suffixes smaller than their
   successors are sorted directly, by words of eight bytes; the rest are induced by scanning the buckets of first
   bytes in order. Suffixes that start no string and induce none that does are left out. Adjacent common prefixes of at least ``length`` bytes join equal strings; all but the earliest repeat.
4. Spans are united per document and cut out.

Sorting and prefixes stop at ``length`` bytes, which is all that the rule asks for. Neither step depends on
the size of the corpus other than by the number of tasks.

Defined results: null texts are empty; texts shorter than ``length`` bytes keep everything; a null id counts
after all others; among texts with equal ids the order is that of a hash of the text; rows equal in id and
text are one document (equal results); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import SLICE_ROWS, chunks, discard, lean, materialise, mix64, prefix_hash, slices, text_buffers
from .minhash import whole_groups

LENGTH, GRAM, HOT = 100, 24, 2000
SORT_BYTES = 1 << 18
_LAST = (1 << 63) - 1


# --- anchors -------------------------------------------------------------------------------------

def anchor_runs(data: np.ndarray, offsets: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, ...]:
    """Runs of strings with one anchor: (row, start in row, number of strings, anchor hash, hash of all their bytes)."""
    none = np.zeros(0, np.int64)
    n = len(data) - gram + 1
    fits = offsets[1:] - offsets[:-1] >= length
    if n <= 0 or not fits.any():
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    run, inverse = prefix_hash(data)
    h = mix64((run[gram:] - run[:n]) * inverse[:n])
    bits = np.uint64(max(1, int(n).bit_length()))
    low = (h >> bits << bits) | np.arange(n, dtype=np.uint64)
    width, step = length - gram + 1, 1
    while step * 2 <= width:
        low = np.minimum(low[:-step], low[step:])
        step *= 2
    if step < width:
        low = np.minimum(low[:step - width], low[width - step:])
    change = np.zeros(len(data) + 1, np.int32)
    np.add.at(change, offsets[:-1][fits], 1)
    np.add.at(change, offsets[1:][fits] - length + 1, -1)
    strings = np.flatnonzero(np.cumsum(change)[:len(low)] > 0)
    at = (low[strings] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    number = np.diff(np.append(first, len(at)))
    starts, anchors = strings[first], at[first]
    ends = starts + number + length - 1
    rows = np.searchsorted(offsets[1:], starts, side="right")
    content = mix64((run[ends] - run[starts]) * inverse[starts] + number.astype(np.uint64))
    return rows, starts - offsets[rows], number, h[anchors], content


_BITS = 31  # of a number of strings; a run has at most length - gram + 1, a resolved span at most its document's


def find_runs(keyed: DataFrame, length: int, gram: int) -> DataFrame:
    """anchor (a hash; of resolved spans: of their place), doc, place (start * 2^31 + number of strings; negative: resolved),
    from (doc, ord, text). Resolved runs that follow one another are one span."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, order = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            data, offsets = text_buffers(batch.column(2))
            parts = []
            for lo, hi in chunks(offsets):
                r, *more = anchor_runs(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo], length, gram)
                parts.append((r + lo, *more))
            if not parts:
                continue
            r, start, number, anchor, content = (np.concatenate(x) for x in zip(*parts))
            # of equal runs in this batch the earliest stays, the others repeat it
            by = np.lexsort((start, doc[r], order[r], content))
            same = np.zeros(len(by), bool)
            same[1:] = content[by[1:]] == content[by[:-1]]
            head = by[np.maximum.accumulate(np.where(same, 0, np.arange(len(by))))]
            again = same & (doc[r[by]] == doc[r[head]]) & (start[by] == start[head])  # the same row twice
            kind = np.zeros(len(by), np.int8)
            kind[by[same]] = 1
            kind[by[again]] = 2
            open_, done = np.flatnonzero(kind == 0), np.flatnonzero(kind == 1)
            joins = np.zeros(len(done), bool)
            joins[1:] = (r[done[1:]] == r[done[:-1]]) & (start[done[1:]] == start[done[:-1]] + number[done[:-1]])
            first = np.flatnonzero(~joins)
            total = np.add.reduceat(number[done], first) if len(done) else done
            done = done[first]
            places = np.concatenate((start[open_] << _BITS | number[open_], ~(start[done] << _BITS | total)))
            docs = np.concatenate((doc[r[open_]], doc[r[done]]))
            keys = np.concatenate((anchor[open_], mix64(doc[r[done]].view(np.uint64) + start[done].astype(np.uint64))))
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(docs, pa.int64()), pa.array(places, pa.int64())], names=["anchor", "doc", "place"])

    return keyed.select("doc", "ord", "text").mapInArrow(lean(rows), "anchor long, doc long, place long")


def compressed(keyed: DataFrame) -> DataFrame:
    """(doc, ord, packed): the texts as they travel, by zstd."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([pack((x.as_py() or "").encode()) for x in batch.column(2)], pa.binary())], names=["doc", "ord", "packed"])

    return keyed.select("doc", "ord", "text").mapInArrow(lean(rows), "doc long, ord long, packed binary")


def cut_runs(texts: DataFrame, length: int, hot: int) -> DataFrame:
    """(key, ord, doc, start, number, bytes) of the open runs in ``marks``; bytes null: the strings repeat others of the batch."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in slices(batches):
            marks = batch.column(3)
            edges, flat = marks.offsets.to_numpy(), marks.flatten()
            anchor, place, times = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            edges = edges - edges[0]
            owner = np.repeat(np.arange(batch.num_rows), np.diff(edges))
            use = np.flatnonzero((place >= 0) & (times <= hot))
            start, number = place >> _BITS, place & ((1 << _BITS) - 1)
            doc, order = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            hot_runs = np.flatnonzero((place >= 0) & (times > hot))
            cuts: list[bytes] = []
            strings: list[tuple] = []
            at_hot = 0
            needed = np.zeros(batch.num_rows, bool)
            needed[owner[use]] = True
            needed[owner[hot_runs]] = True
            per = np.searchsorted(owner[use], np.arange(batch.num_rows + 1))
            s_list, e_list = start[use].tolist(), (start[use] + number[use] + length - 1).tolist()
            for k in np.flatnonzero(needed).tolist():
                raw = unpack(batch.column(2)[k].as_py())
                for m in range(per[k], per[k + 1]):
                    cuts.append(raw[s_list[m]:e_list[m]])
                while at_hot < len(hot_runs) and owner[hot_runs[at_hot]] == k:
                    h = int(hot_runs[at_hot])
                    for x in range(int(start[h]), int(start[h] + number[h])):
                        strings.append((int(order[k]), int(doc[k]), x, raw[x:x + length], int(anchor[h])))
                    at_hot += 1
            for lo in range(0, len(use), 20_000):
                u = use[lo:lo + 20_000]
                yield _strings(anchor[u], order[owner[u]], doc[owner[u]], start[u], number[u], cuts[lo:lo + 20_000])
            firsts: dict[bytes, tuple] = {}
            out = []
            for o, d, x, raw, a in sorted(strings):
                head = firsts.setdefault(raw, (o, d, x))
                own = hashlib.blake2b(raw, digest_size=8, key=a.to_bytes(8, "little", signed=True)).digest()
                if head == (o, d, x):
                    out.append((int.from_bytes(own, "little", signed=True), o, d, x, 1, raw))
                else:  # dealt out by its place: it needs no company
                    out.append((hash((d, x)), o, d, x, 1, None))
            for lo in range(0, len(out), 20_000):
                yield _strings(*zip(*out[lo:lo + 20_000]))

    return texts.select("doc", "ord", "packed", "marks").mapInArrow(lean(rows), "key long, ord long, doc long, start long, number int, bytes binary")


def _strings(*cols) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], names=["key", "ord", "doc", "start", "number", "bytes"])


# --- two-stage suffix sorting --------------------------------------------------------------------

def suffix_array(text: np.ndarray, depth: int, wanted: np.ndarray | None = None, words: np.ndarray | None = None) -> np.ndarray:
    """Positions of all suffixes in order of their first ``depth`` values (bytes; 0 ends a string: what
    follows it doesn't count). ``wanted`` flags the positions that the caller needs: others are left out unless
    a wanted one is induced from them. ``words``: the text's ``word_table``.

    Suffixes smaller than their successors are sorted directly. The others follow in one pass over the
    buckets of first bytes in ascending order: the predecessors of a finished bucket's suffixes, in the
    bucket's order, are the next entries of their own buckets; runs of one byte extend their own bucket."""
    n = len(text)
    if not n:
        return np.zeros(0, np.int64)
    after = np.append(text[1:], 0).astype(np.int16) - text
    # equal neighbours: the type of the next position
    decided = np.where(after != 0, np.arange(n), n)
    decided = np.minimum.accumulate(decided[::-1])[::-1]
    smaller = np.append(after, -1)[decided] > 0
    needed = np.ones(n, bool) if wanted is None else _with_sources(wanted, smaller)
    direct = np.flatnonzero(smaller & (text != 0) & needed)
    direct = _sort_directly(word_table(text) if words is None else words, direct, depth)
    induce = ~smaller & needed
    first = text[direct]
    bounds = np.searchsorted(first, np.arange(257))  # sorted by first byte already
    induced: list[list[np.ndarray]] = [[] for _ in range(256)]
    out: list[np.ndarray] = []
    for c in range(256):
        if c == 0:
            mine = np.flatnonzero(text == 0)
            done = [mine]
        else:
            done = induced[c]
            wave = np.concatenate(done) if done else np.zeros(0, np.int64)
            done = [wave]
            while len(wave):  # a run of one byte: predecessors in the same bucket
                back = wave[wave > 0] - 1
                wave = back[(text[back] == c) & induce[back]]
                done.append(wave)
            done.append(direct[bounds[c]:bounds[c + 1]])
        bucket = np.concatenate(done)
        induced[c] = []
        out.append(bucket)
        back = bucket[bucket > 0] - 1
        values = text[back]
        take = (values > c) & induce[back]
        back, values = back[take], values[take]
        if len(back):
            by = np.argsort(values, kind="stable")
            back, values = back[by], values[by]
            edges = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1])))
            for s, e in zip(edges, np.append(edges[1:], len(values))):
                induced[int(values[s])].append(back[s:e])
    return np.concatenate(out)


def _with_sources(wanted: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """``wanted`` and what its suffixes are induced from: on from each one that is not smaller than its successor,
    up to the next that is (inclusive)."""
    n = len(wanted)
    stop = np.minimum.accumulate(np.where(smaller, np.arange(n), n - 1)[::-1])[::-1]
    change = -np.bincount(stop[wanted] + 1, minlength=n + 1)
    change[:n] += wanted
    return np.cumsum(change)[:n] > 0


def word_table(text: np.ndarray) -> np.ndarray:
    """Eight bytes from each position as one big-endian number; bytes after a 0 count as 0."""
    n = len(text)
    padded = np.concatenate((text, np.zeros(8, np.uint8))).astype(np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | padded[k:k + n]
    end = np.where(text == 0, np.arange(n), n)
    left = np.minimum.accumulate(end[::-1])[::-1] - np.arange(n)  # bytes before the next 0
    near = np.flatnonzero(left < 8)
    drop = (8 - left[near]).astype(np.uint64) * np.uint64(8)
    out[near] = np.where(drop >= 64, np.uint64(0), out[near] >> np.minimum(drop, np.uint64(63)) << np.minimum(drop, np.uint64(63)))
    return np.concatenate((out, np.zeros(1, np.uint64)))


def _sort_directly(words: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
    """Sorts by eight bytes, then resorts only what is still tied by the next eight."""
    if not len(at):
        return at
    n, own = len(words) - 1, words[at]
    by = np.argsort(own, kind="stable")
    at, own = at[by], own[by]
    new = np.ones(len(at), bool)
    new[1:] = own[1:] != own[:-1]
    open_ = (own & np.uint64(0xFF)) != 0  # a string that ended is settled
    for k in range(8, depth, 8):
        tied = ~new
        tied[:-1] |= ~new[1:]
        where = np.flatnonzero(tied & open_)
        if not len(where):
            break
        group = np.cumsum(new)[where]
        own = words[np.minimum(at[where] + k, n)]
        by = np.lexsort((own, group))
        at[where] = at[where][by]
        own, group = own[by], group[by]
        split = np.ones(len(where), bool)
        split[1:] = (own[1:] != own[:-1]) | (group[1:] != group[:-1])
        new[where] |= split
        open_[where] = (own & np.uint64(0xFF)) != 0
    return at


def common_prefixes(text: np.ndarray, order: np.ndarray, depth: int, words: np.ndarray | None = None) -> np.ndarray:
    """Of each suffix with the one before it in ``order``: the length of the common prefix, ``depth`` at most.
    A 0 ends a prefix."""
    words = word_table(text) if words is None else words
    n = len(text)
    out = np.zeros(len(order), np.int64)
    live = np.arange(1, len(order))
    for k in range(0, depth, 8):
        if not len(live):
            break
        a, b = words[np.minimum(order[live] + k, n)], words[np.minimum(order[live - 1] + k, n)]
        x = a ^ b
        same = x == 0
        whole = same & ((a & np.uint64(0xFF)) != 0)
        part = np.flatnonzero(~whole)
        # equal leading bytes, not counting ends
        count = np.zeros(len(part), np.int64)
        for j in range(1, 9):
            top = x[part] >> np.uint64(64 - 8 * j) if j < 8 else x[part]
            byte = a[part] >> np.uint64(64 - 8 * j) & np.uint64(0xFF)
            count += (top == 0) & (byte != 0)
        out[live[part]] += count
        out[live[whole]] += 8
        live = live[whole]
    return np.minimum(out, depth)


def repeated_strings(runs: list[bytes], numbers: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For distinct runs and their places (rank of the earliest occurrence, by ``order``): flags, per string of
    every run in turn, that the same string is in an earlier place."""
    sizes = np.array([len(r) for r in runs], np.int64)
    begins = np.concatenate(([0], np.cumsum(sizes + 1)))
    text = np.zeros(begins[-1], np.uint8)
    joined = np.frombuffer(b"\0".join(runs) + b"\0", np.uint8)
    inside = np.ones(len(text), bool)
    inside[begins[1:] - 1] = False
    text[inside] = joined[inside] + 1  # UTF-8 has no byte 255, so 0 is free for the ends
    run_of = np.repeat(np.arange(len(runs)), sizes + 1)
    within = np.arange(len(text)) - begins[run_of]
    starts_string = within < numbers[run_of]
    words = word_table(text)
    s = suffix_array(text, length, starts_string, words)
    s = s[starts_string[s]]
    group = np.cumsum(common_prefixes(text, s, length, words) < length)
    place = order[run_of[s]] + within[s]  # later in the run, later in the document
    by = np.lexsort((place, group))
    s, group = s[by], group[by]
    later = np.zeros(len(s), bool)
    later[1:] = group[1:] == group[:-1]
    flags = np.zeros(len(text), bool)
    flags[s[later]] = True
    return flags[starts_string]


def sort_groups(runs: DataFrame, length: int) -> DataFrame:
    """(doc, start, stop): spans that repeat, from (key, ord, doc, start, number, bytes) grouped by key."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bounds, t in whole_groups(batches, ("key",)):
            size = pc.fill_null(pc.binary_length(t.column("bytes")), 0).to_numpy().astype(np.int64)
            total = np.concatenate(([0], np.cumsum(size)))
            lo = 0
            while lo < len(bounds) - 1:
                hi = lo + 1
                while hi < len(bounds) - 1 and total[bounds[hi + 1]] - total[bounds[lo]] <= SORT_BYTES:
                    hi += 1
                yield _sorted(t.slice(int(bounds[lo]), int(bounds[hi] - bounds[lo])), length)
                lo = hi

    parts = runs.repartition("key").sortWithinPartitions("key")
    return parts.mapInArrow(lean(rows), "doc long, start long, stop long")


def _sorted(t: pa.Table, length: int) -> pa.RecordBatch:
    key, order, doc, start, number = (t.column(c).to_numpy() for c in ("key", "ord", "doc", "start", "number"))
    number = number.astype(np.int64)
    raw = t.column("bytes").to_pylist()
    # places in one ordering: a document's rank and the start in it
    by = np.lexsort((start, doc, order))
    new_doc = np.ones(len(by), bool)
    new_doc[1:] = (doc[by[1:]] != doc[by[:-1]]) | (order[by[1:]] != order[by[:-1]])
    place = np.zeros(len(by), np.int64)
    place[by] = (np.cumsum(new_doc) - 1) * (int(start.max()) + int(number.max()) + 2) + start[by]
    head: dict[bytes, int] = {}
    of = np.empty(len(by), np.int64)
    for i in by.tolist():
        x = raw[i]
        of[i] = i if x is None else head.setdefault(x, i)
    heads = np.fromiter(head.values(), np.int64, len(head))
    copy = np.array([x is None for x in raw], bool) | (place != place[of])  # equal places: the same row twice
    copies = np.flatnonzero(copy)
    if not len(heads):
        return _spans(doc[copies], start[copies], start[copies] + number[copies] + length - 1)
    flags = repeated_strings([raw[i] for i in heads], number[heads], place[heads], length)
    first = np.concatenate(([0], np.cumsum(number[heads])))
    edge = np.zeros(len(flags) + 1, bool)
    edge[first[:-1]] = True
    before = np.concatenate(([False], flags[:-1]))
    begin = np.flatnonzero(flags & (~before | edge[:-1]))
    after = np.append(flags[1:], False)
    end = np.flatnonzero(flags & (~after | edge[1:] | (np.arange(len(flags)) == len(flags) - 1)))
    run = np.searchsorted(first[1:], begin, side="right")
    base = start[heads[run]] - first[run] if len(run) else np.zeros(0, np.int64)
    none = np.zeros(0, np.int64)
    return _spans(np.concatenate((doc[copies], doc[heads[run]] if len(run) else none)), np.concatenate((start[copies], begin + base)),
                  np.concatenate((start[copies] + number[copies] + length - 1, end + base + length)))


def _spans(doc, start, stop) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (doc, start, stop)], names=["doc", "start", "stop"])


# --- the operator --------------------------------------------------------------------------------

def cut(raw: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left, and the maximal removed spans."""
    merged: list[list[int]] = []
    for s, e in sorted(spans):
        if merged and s <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], e)
        else:
            merged.append([s, e])
    kept, at = [], 0
    for s, e in merged:
        kept.append(raw[at:s])
        at = e
    return b"".join([*kept, raw[at:]]), [(s, e) for s, e in merged]


def doc_key():
    return F.xxhash64(F.col("doc_id"), F.col("text"))


def repeats(docs: DataFrame, *, length: int = LENGTH, gram: int = GRAM, hot: int = HOT) -> DataFrame:
    """(doc, kept binary, spans array<struct<start, stop>>) of the documents that lose bytes; doc is ``doc_key()``."""
    keyed = docs.select(doc_key().alias("doc"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("ord"), "text")
    runs = written = materialise(find_runs(keyed, length, gram), "runs", SLICE_ROWS)
    # how often an anchor occurs: partial counts first, so no anchor's runs meet in one task
    times = runs.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1").withColumnRenamed("anchor", "of")
    runs = runs.join(times, runs["anchor"] == times["of"], "left").withColumn("times", F.coalesce("times", F.lit(1))).where("times > 1 OR place < 0")
    marks = runs.groupBy("doc").agg(F.sort_array(F.collect_list(F.struct("place", "anchor", "times"))).alias("marks"))
    marks = marks.withColumn("marks", F.transform("marks", lambda m: F.struct(m["anchor"].alias("anchor"), m["place"].alias("place"), m["times"].alias("times"))))
    texts = materialise(compressed(keyed).join(marks, "doc"), "texts", SLICE_ROWS)
    discard(written)
    found = materialise(sort_groups(cut_runs(texts, length, hot), length), "spans", SLICE_ROWS)
    spans = found.groupBy("doc").agg(F.collect_list(F.struct("start", "stop")).alias("found"))
    resolved = F.filter("marks.place", lambda p: p < 0)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            docs_, kept, merged = [], [], []
            for doc, packed, places, more in zip(*(c.to_pylist() for c in batch.columns)):
                own = [(x["start"], x["stop"]) for x in more or ()]
                own += [(~p >> _BITS, (~p >> _BITS) + (~p & ((1 << _BITS) - 1)) + length - 1) for p in places]
                if own:
                    k, m = cut(unpack(packed), own)
                    docs_.append(doc)
                    kept.append(k)
                    merged.append([{"start": s, "stop": e} for s, e in m])
            yield pa.RecordBatch.from_arrays([pa.array(docs_, pa.int64()), pa.array(kept, pa.binary()),
                                              pa.array(merged, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())])))], names=["doc", "kept", "spans"])

    both = texts.select("doc", "packed", resolved.alias("resolved")).join(spans, "doc", "left").where("found IS NOT NULL OR size(resolved) > 0")
    return both.select("doc", "packed", "resolved", "found").mapInArrow(lean(rows), "doc long, kept binary, spans array<struct<start: long, stop: long>>")


def without_repeats(docs: DataFrame, **options) -> DataFrame:
    """docs with the repeats cut out of ``text`` (a character of which any byte goes, goes) and n_chars set anew."""
    lost = repeats(docs, **options).dropDuplicates(["doc"])
    rows = docs.select(F.struct(*docs.columns).alias("row"), doc_key().alias("key"))
    rows = rows.join(lost, rows["key"] == lost["doc"], "left")
    text = F.when(F.col("kept").isNull(), F.col("row.text")).otherwise(valid_utf8(F.col("kept")))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(F.col("kept").isNull(), F.col("row.n_chars")).otherwise(F.length(text).cast("long"))
    return rows.select(*[changed.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def valid_utf8(raw):
    """Bytes as text; what a cut has left of a character is dropped (an U+FFFD that stood in the text goes too)."""
    return F.regexp_replace(F.make_valid_utf8(raw.cast("string")), "�", "")
