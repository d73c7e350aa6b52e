"""Helpers shared by the operators of this subpackage.

* ``materialise`` cuts lineage with a written table in the shared folder that the
  session names (``spark.checkpoint.dir``), so a lost executor costs a re-read, never a
  recomputation of what came before.
* The text helpers work on whole Arrow batches: every document of a batch is a slice of
  one UTF-8 buffer, and words, word hashes and shingles are found for all of them at
  once, in chunks of a few megabytes (a longer document is a chunk of its own).
"""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import delete_path, scratch_dir

CHUNK_BYTES = 1 << 19
WORD_BLOCK = 1 << 17
SLICE_ROWS = 1000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_U64 = np.uint64


def materialise(df: DataFrame, name: str, arrow_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back (schema kept, also when empty).

    The written table stands for all that came before it, so Spark removes the write's shuffle files as soon
    as the write is done, not when the driver's collector happens to find them unused. ``arrow_rows``: rows handed to
    Python at a time in that write."""
    spark = df.sparkSession
    path = f"{scratch_dir(spark, f'llm-{name}')}/table"
    schema = df.schema
    wanted = {SHUFFLE_CLEANUP: "true"} | ({ARROW_ROWS: str(arrow_rows)} if arrow_rows else {})
    before = {key: spark.conf.get(key, None) for key in wanted}
    for key, value in wanted.items():
        spark.conf.set(key, value)
    try:
        df.write.parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value) if value is not None else spark.conf.unset(key)
    out = spark.read.schema(schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``materialise`` wrote, once everything that reads them has been written itself."""
    for table in tables:
        if path := getattr(table, "written_to", None):
            delete_path(table.sparkSession, path)


def lean(rows: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``rows`` for ``mapInArrow``, giving memory back when its task is done. Workers are used again by later stages, and some
    wait idle beside them: what a task has freed must not stay with its worker."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from rows(batches)
        finally:
            give_back()

    return run


def give_back() -> None:
    for key in _powers:
        _powers[key] = _powers[key][:WORD_BLOCK].copy()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 5, is 0. A null id counts as held out: nothing is learned from it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def text_buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """One byte buffer and n + 1 offsets; a null text is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], pa.string())
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type)
                         or pa.types.is_large_binary(column.type) else pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = column.buffers()
    offsets = np.frombuffer(offs, np.int64)[column.offset:column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows, at most SLICE_ROWS at a time, where a row's work is much larger than the row."""
    for batch in batches:
        for k in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(k, SLICE_ROWS)


def chunks(offsets: np.ndarray, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [lo, hi) of at most ``most`` bytes, or of one row."""
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(offsets, offsets[lo] + most, side="right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 (fixed constants of that public generator)."""
    x = (x ^ (x >> _U64(30))) * _U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U64(27))) * _U64(0x94D049BB133111EB)
    return x ^ (x >> _U64(31))


def seeds(n: int, start: int) -> np.ndarray:
    """n reproducible odd 64-bit numbers."""
    return mix64(np.arange(start, start + n, dtype=np.uint64) * _U64(0x9E3779B97F4A7C15)) | _U64(1)


_BASE = 0xD6E8FEB86659FD93
_BASE_INV = pow(_BASE, -1, 1 << 64)
_BYTE = seeds(256, 1)
_powers: dict[str, np.ndarray] = {"p": np.ones(1, np.uint64), "q": np.ones(1, np.uint64)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers["p"]) < n:
        for key, base in (("p", _BASE), ("q", _BASE_INV)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.cumprod(steps, dtype=np.uint64)
    return _powers["p"][:n], _powers["q"][:n]


def prefix_hash(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Running polynomial hash (mod 2^64) and inverse powers: the hash of data[s:e] is
    (run[e] - run[s]) * inverse[s], wherever the bytes stand."""
    p, q = _power_tables(len(data) + 1)
    run = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * p[:-1], out=run[1:])
    return run, q


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def lower_ascii(data: np.ndarray) -> np.ndarray:
    return _LOWER[data]


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and row numbers of all words ``[^\\x20\\x09-\\x0D]+``; words don't cross rows."""
    inside = ~_SPACE[data]
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside
    after = before.copy()
    before[offsets[:-1]] = False  # a row starts: nothing of a word before it
    starts = np.flatnonzero(inside & ~before[:-1])
    tail = np.zeros(len(data) + 1, bool)
    tail[:-1] = inside
    tail[offsets[1:]] = False  # a row ends
    ends = np.flatnonzero(after[1:] & ~tail[1:]) + 1
    return starts, ends, np.searchsorted(offsets[1:], starts, side="right")


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of data[starts:ends], found over blocks of about WORD_BLOCK bytes: a hash does not depend on where
    its bytes stand, so the tables needed stay as small as a block (or its longest word)."""
    out = np.zeros(len(starts), np.uint64)
    lo = 0
    while lo < len(starts):
        at = starts[lo]
        hi = max(lo + 1, int(np.searchsorted(ends, at + WORD_BLOCK, side="right")))
        run, inverse = prefix_hash(data[at:ends[hi - 1]])
        s, e = starts[lo:hi] - at, ends[lo:hi] - at
        out[lo:hi] = (run[e] - run[s]) * inverse[s]
        lo = hi
    return mix64(out)


def shingle_hashes(words: np.ndarray, rows: np.ndarray, n_rows: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n-word shingles in word order, and n_rows + 1 offsets. A row of fewer
    than n words (but some) has its whole sequence as its one shingle."""
    mult = seeds(n + 1, 1000)
    counts = np.bincount(rows, minlength=n_rows)
    first = np.concatenate(([0], np.cumsum(counts)))
    total = np.zeros(len(words), np.uint64)
    for j in range(min(n, len(words))):
        total[:len(words) - j] += words[j:] * mult[j]
    full = np.arange(len(words)) + n <= first[rows + 1]
    short = np.flatnonzero((counts > 0) & (counts < n))
    keep = full
    if len(short):
        keep = full.copy()
        keep[first[short]] = True
        for r in short.tolist():
            part = words[first[r]:first[r + 1]]
            total[first[r]] = np.append(part * mult[:len(part)], mult[n:] * _U64(len(part))).sum(dtype=np.uint64)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    return mix64(total[keep]), np.concatenate(([0], np.cumsum(sizes)))
