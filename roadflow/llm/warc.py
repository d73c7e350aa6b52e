"""WARC archives with a two-level capture index.

Writing: one gzip member per record, in files of at most ``FILE_BYTES``, straight from the tasks to the shared
folder (``pyarrow.fs``; a retried task writes files of its own, and the index names only those of the attempt
that counted). Of records with equal payloads the one with the largest id is the response, the
others are revisits that refer to it.

Index: entries sorted by reversed-host key in gzip blocks of ``BLOCK`` lines. A sparse directory of two levels lies in the archive: a line per
block beside each index file (first and last key, place), and a line per index file in one file above them. ``lookup`` takes a table
of urls: tasks find the keys' blocks by binary search in both levels, range-read each block found, search it for the keys, and
range-read the records in file order, neighbours in one range. ``read_all`` decodes all blocks instead.

Defined results: a null payload is empty; a null url has the key ``-)/``; a null id is written as
``none``, refers to its group's response like any other, and is a response where the whole group has no id; rows with equal
ids and payloads are all responses if their id is the largest; payloads of under ``least_bytes`` are all responses; an
empty table gives an empty archive; other columns are ignored.
"""

from __future__ import annotations

import base64
import bisect
import gzip
import hashlib
import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, functions as F

from ..session import scratch_dir
from .common import materialise

FILE_BYTES, BLOCK, RANGE = 256 << 20, 1000, 4 << 20
PLACE, OUT_ROWS = "key string, file string, offset long, length long", 20_000
ENTRY = "key string, id long, file string, offset long, length long"
TOP, BLOCKS = "directory.top", ".blocks"  # names of the directory's upper level, and of an index file's part of the lower one
HELD = 64  # index files whose part of the directory a task keeps
DIRECTORY = "first string, last string, file string, offset long, length long, n int"


def reversed_host_key(url: str | None) -> str:
    """``https://www.Example.com:80/a?b`` -> ``com,example,www:80)/a?b``; the fragment and the scheme don't count."""
    url = (url or "").strip()
    try:
        parts = urlsplit(url if "://" in url else f"//{url}")
        host, port = (parts.hostname or "-"), parts.port
    except ValueError:  # not a url: as it stands
        return f"-)/{url}"
    path = (parts.path or "/") + (f"?{parts.query}" if parts.query else "")
    return ",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + (path if path[0] == "/" else f"/{path}")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(ident: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    uri = "".join(c if 0x20 < ord(c) != 0x7F else f"%{ord(c):02X}" for c in url or "")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:page:{'none' if ident is None else ident}>", f"WARC-Date: {date}",
            f"WARC-Target-URI: {uri}", "Content-Type: application/http; msgtype=response", f"WARC-Payload-Digest: sha1:{digest(payload)}"]
    if revisit:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(raw: bytes) -> dict:
    """The fields of one record; a response's payload is checked against its digest."""
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(x.split(": ", 1) for x in lines[1:] if ": " in x)
    block = rest[:int(fields["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
    kind, want = fields["WARC-Type"], fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != size or digest(payload) != want):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
    number = lambda x: None if x is None or x == "<urn:page:none>" else int(x[len("<urn:page:"):-1])
    return {"id": number(fields["WARC-Record-ID"]), "url": fields.get("WARC-Target-URI", ""), "type": kind, "payload_bytes": size, "payload_digest": want,
            "refers_to": number(fields.get("WARC-Refers-To")) if kind == "revisit" else None, "payload": payload if kind == "response" else None}


def _open(path: str):
    return pafs.FileSystem.from_uri(path)


@dataclass
class Archive:
    """A written archive: its folder and the directory of its index (one row per block)."""

    folder: str
    directory: DataFrame


def with_originals(pages: DataFrame, least_bytes: int) -> DataFrame:
    """id, url, payload, revisit, refers_to. Only payloads that occur more than once are joined back."""
    rows = pages.select(F.col("page_id").cast("long").alias("id"), "url", F.coalesce(F.col("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    groups = rows.where(F.octet_length("payload") >= least_bytes).groupBy("digest").agg(F.max("id").alias("original"), F.count("*").alias("n"))
    groups = materialise(groups.where("n > 1 AND original IS NOT NULL").select("digest", "original"), "payloads")
    rows = rows.join(groups, "digest", "left")
    revisit = F.col("original").isNotNull() & ~F.col("id").eqNullSafe(F.col("original"))
    return rows.select("id", "url", "payload", revisit.alias("revisit"), F.when(revisit, F.col("original")).alias("refers_to"))


def write_archive(pages: DataFrame, folder: str | None = None, *, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z",
                  file_bytes: int = FILE_BYTES, block: int = BLOCK) -> Archive:
    """Archives, index blocks and directory of (page_id, url, html)."""
    spark = pages.sparkSession
    folder = folder or scratch_dir(spark, "llm-warc")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        fs.create_dir(root, recursive=True)
        out, name, at = None, "", 0
        try:
            for batch in batches:
                entries = []
                for ident, url, payload, revisit, refers in zip(*(c for c in batch.columns)):
                    if out is None or at >= file_bytes:
                        if out is not None:
                            out.close()
                        name, at = f"{uuid.uuid4().hex}.warc.gz", 0
                        out = fs.open_output_stream(f"{root}/{name}", compression=None)
                    raw = gzip.compress(record(ident.as_py(), url.as_py(), payload.as_py(), refers.as_py(), revisit.as_py(), date), 3, mtime=0)
                    out.write(raw)
                    entries.append((reversed_host_key(url.as_py()), ident.as_py(), name, at, len(raw)))
                    at += len(raw)
                yield _batch(entries, ENTRY)
        finally:
            if out is not None:
                out.close()

    entries = materialise(with_originals(pages, least_bytes).mapInArrow(write, ENTRY), "entries")

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        name, at, lines, out, rows = f"{uuid.uuid4().hex}.cdx.gz", 0, [], None, []
        # this task's part of the directory lies beside its blocks

        def flush():
            nonlocal at, out, lines
            out = out or fs.open_output_stream(f"{root}/{name}", compression=None)
            raw = gzip.compress("".join(json.dumps(x) + "\n" for x in lines).encode(), 6, mtime=0)
            out.write(raw)
            rows.append((lines[0][0], lines[-1][0], name, at, len(raw), len(lines)))
            at, lines = at + len(raw), []

        for batch in batches:
            for e in zip(*(c.to_pylist() for c in batch.columns)):
                lines.append(e)
                if len(lines) >= block:
                    flush()
        if lines:
            flush()
        if out is not None:
            out.close()
        if rows:
            with fs.open_output_stream(f"{root}/{name}{BLOCKS}", compression=None) as f:
                f.write("".join(json.dumps([*r[:2], *r[3:5]]) + "\n" for r in rows).encode())
            yield _batch(rows, DIRECTORY)

    # equal keys spread over files and places, so no key is too large for one range
    ordered = entries.repartitionByRange("key", "file", "offset").sortWithinPartitions("key", "file", "offset")
    directory = materialise(ordered.mapInArrow(index, DIRECTORY), "directory")
    _write_top(folder, directory)
    return Archive(folder, directory)


def _write_top(folder: str, directory: DataFrame) -> None:
    """The upper level of the directory: a line per index file, with its first and last key, in order. Rows pass through the driver one by one."""
    fs, root = _open(folder)
    fs.create_dir(root, recursive=True)
    files = directory.groupBy("file").agg(F.min("first").alias("first"), F.max("last").alias("last")).orderBy("first", "last", "file")
    with fs.open_output_stream(f"{root}/{TOP}", compression=None) as out:
        for r in files.toLocalIterator():
            out.write((json.dumps([r["first"], r["last"], r["file"]]) + "\n").encode())


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [x.split() for x in schema.split(", ")]
    cols = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(cols, fields)], names=[n for n, _ in fields])


def _range(fs, path: str, offset: int, length: int) -> bytes:
    with fs.open_input_file(path) as f:
        return f.read_at(length, offset)


def index_entries(archive: Archive) -> DataFrame:
    """Every entry of the index, decoded from its blocks."""
    folder = archive.folder

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        for batch in batches:
            for b in batch.to_pylist():
                lines = gzip.decompress(_range(fs, f"{root}/{b['file']}", b["offset"], b["length"])).decode().splitlines()
                yield _batch([tuple(json.loads(x)) for x in lines], ENTRY)

    return archive.directory.mapInArrow(rows, ENTRY)


RECORD = "id long, url string, payload_bytes long, payload_digest string, type string, refers_to long"


def read_all(archive: Archive) -> DataFrame:
    """``RECORD`` of every record that the index names."""
    return read_records(archive, index_entries(archive))


def read_records(archive: Archive, entries: DataFrame, payload: bool = False) -> DataFrame:
    """``RECORD`` (and the payload; null for revisits) of the entries (file, offset, length). Ranges that touch are read at once, up to RANGE bytes."""
    folder = archive.folder
    schema = RECORD + ", payload binary" * payload
    names = [x.split()[0] for x in schema.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        for batch in batches:
            group: list[tuple[int, int]] = []
            name, end = None, 0
            for file, offset, length in zip(*(batch.column(c).to_pylist() for c in ("file", "offset", "length"))):
                if group and (file != name or offset != end or end - group[0][0] >= RANGE):
                    yield read(fs, f"{root}/{name}", group)
                    group = []
                group.append((offset, length))
                name, end = file, offset + length
            if group:
                yield read(fs, f"{root}/{name}", group)

    def read(fs, path: str, group: list[tuple[int, int]]) -> pa.RecordBatch:
        start = group[0][0]
        raw = _range(fs, path, start, group[-1][0] + group[-1][1] - start)
        out = []
        for offset, length in group:
            r = parse(zlib.decompress(raw[offset - start:offset - start + length], 31))
            out.append(tuple(r[n] for n in names))
        return _batch(out, schema)

    return entries.repartitionByRange("file", "offset").sortWithinPartitions("file", "offset").mapInArrow(rows, schema)


def spans_of(firsts: list[str], lasts: list[str], key: str) -> range:
    """Which of the sorted stretches [first, last] can hold the key: two binary searches. Stretches follow one another, and only
    share keys at their ends."""
    return range(bisect.bisect_left(lasts, key), bisect.bisect_right(firsts, key))


class _Search:
    """The two levels of the directory, as a task sees them: the upper one, and the parts of the lower one that it has met."""

    def __init__(self, folder: str):
        self.fs, self.root = _open(folder)
        rows = [json.loads(x) for x in self._read(TOP)]
        self.firsts, self.lasts, self.files = ([r[k] for r in rows] for k in range(3))
        self.parts: dict[str, tuple] = {}

    def _read(self, name: str) -> list[str]:
        with self.fs.open_input_file(f"{self.root}/{name}") as f:
            return f.read().decode().splitlines()

    def _part(self, file: str) -> tuple:
        if file not in self.parts:
            if len(self.parts) >= HELD:
                self.parts.clear()
            rows = [json.loads(x) for x in self._read(file + BLOCKS)]
            self.parts[file] = tuple([r[k] for r in rows] for k in range(4))
        return self.parts[file]

    def blocks(self, key: str) -> Iterator[tuple[str, int, int]]:
        """(file, offset, length) of the blocks that can hold the key."""
        for k in spans_of(self.firsts, self.lasts, key):
            firsts, lasts, offsets, lengths = self._part(self.files[k])
            for b in spans_of(firsts, lasts, key):
                yield self.files[k], offsets[b], lengths[b]


def find_entries(archive: Archive, urls: DataFrame) -> DataFrame:
    """``ENTRY`` rows of all captures of the urls (column ``url``). Keys are searched in sorted order, and their blocks are read
    each once, wherever the keys came from: a key of many captures is as many blocks, in as many tasks."""
    folder = archive.folder

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        directory = _Search(folder)
        for batch in batches:
            rows = []
            for key in sorted({reversed_host_key(u) for u in batch.column(0).to_pylist()}):
                for block in directory.blocks(key):
                    rows.append((key, *block))
                    if len(rows) >= OUT_ROWS:
                        yield _batch(rows, PLACE)
                        rows = []
            yield _batch(rows, PLACE)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _open(folder)
        now, lines, keys = None, [], []
        for batch in batches:
            out = []
            for key, *place in zip(*(c.to_pylist() for c in batch.columns)):
                if place != now:
                    now, (file, offset, length) = place, place
                    lines = [json.loads(x) for x in gzip.decompress(_range(fs, f"{root}/{file}", offset, length)).decode().splitlines()]
                    keys = [x[0] for x in lines]
                out += lines[bisect.bisect_left(keys, key):bisect.bisect_right(keys, key)]
            yield _batch(out, ENTRY)

    found = urls.select("url").distinct().sortWithinPartitions("url").mapInArrow(search, PLACE).distinct()
    found = found.repartition("file", "offset").sortWithinPartitions("file", "offset", "key")
    return found.select("key", "file", "offset", "length").mapInArrow(read, ENTRY)


def lookup(archive: Archive, urls: DataFrame, payload: bool = True) -> DataFrame:
    """The records of the urls (column ``url``), each once: binary search in the directory, range reads of the blocks found, binary search in
    them, range reads of the records."""
    return read_records(archive, find_entries(archive, urls), payload)
