"""SentencePiece (BPE) encoding that keeps source offsets, and decoding.

A text is normalised by the model's compiled character map: at each place the longest key of the map (a double-array
trie) is replaced, else one character is copied. Every byte of the normalised text records the source byte that it
came from, so each piece can be projected to the span of original bytes that it covers. Pieces that stand for one
unknown character byte by byte follow the library's convention: the last of them has the character's span.

Pieces are found segment by segment: a segment is a run of the space symbol and the characters up to the next, or a
newline. No piece of the vocabulary crosses such a border (checked when the model is read; if one does, the whole
text is one segment), so merges in one segment never depend on another and each distinct segment is merged once per
worker. The cache is bounded: when it is full it is emptied.

Defined results: null texts are empty and have no pieces; texts are whole, whatever their length; byte pieces that
form no character decode to U+FFFD each; repeated rows are encoded each; an empty table gives an empty result; other
columns are kept, and a column named like one of the new ones is replaced. The model must be of type BPE, without unused
or user-defined pieces and without a map for decoding (an error otherwise).
"""

from __future__ import annotations

import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import lean

MODEL = "piece_bpe_32k.model"
MOST, MOST_IDS, LONGEST = 300_000, 3_000_000, 200  # segments kept by a worker, their ids; characters of a short one
OUT_BYTES = 1 << 20
SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
_NEVER = float("inf")
UNKNOWN_SURFACE = " ⁇ "  # fixed value of the library
_models: dict[str, "PieceModel"] = {}


def fields(raw: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protocol-buffer message, in order."""
    def varint(at: int) -> tuple[int, int]:
        value = shift = 0
        while True:
            value |= (raw[at] & 127) << shift
            at, shift = at + 1, shift + 7
            if raw[at - 1] < 128:
                return value, at

    at = 0
    while at < len(raw):
        key, at = varint(at)
        if key & 7 == 0:
            value, at = varint(at)
        else:
            size, at = varint(at) if key & 7 == 2 else (8 if key & 7 == 1 else 4, at)
            value, at = raw[at:at + size], at + size
        yield key >> 3, value


class Normaliser:
    """Longest-prefix replacement through a compiled character map, with the source of every byte."""

    def __init__(self, spec: bytes):
        found = dict(fields(spec))
        self.dummy, self.squeeze, self.escape = (bool(found.get(k, 1)) for k in (3, 4, 5))
        blob = found.get(2, b"")
        self.units, self.texts = np.zeros(0, np.uint32), b""
        if blob:
            size = struct.unpack("<I", blob[:4])[0]
            self.units = np.frombuffer(blob[4:4 + size], np.uint32)
            self.texts = blob[4 + size:]
        self.trie = self.units.tolist()
        self.starts: dict[str, bool] = {}  # characters that begin a key

    def longest(self, raw: bytes, at: int) -> tuple[int, int]:
        """(length, value) of the longest key at raw[at:]; length 0 if none."""
        trie, node, best = self.trie, 0, (0, 0)
        unit = trie[0]
        node ^= unit >> 10 << ((unit & 512) >> 6)
        for k in range(at, len(raw)):
            node ^= raw[k]
            unit = trie[node]
            if unit & 0x800000FF != raw[k]:
                break
            node ^= unit >> 10 << ((unit & 512) >> 6)
            if unit >> 8 & 1:
                best = (k - at + 1, trie[node] & 0x7FFFFFFF)
        return best

    def _prefixes(self, raw: bytes) -> Iterator[tuple[bytes, int]]:
        """(replacement, source bytes) from the start to the end."""
        at, n = 0, len(raw)
        while at < n:
            first = raw[at]
            size = 1 if first < 0x80 else 2 if first < 0xE0 else 3 if first < 0xF0 else 4
            char = raw[at:at + size]
            if self.starts.get(char, True):
                length, value = self.longest(raw, at)
                if length:
                    yield self.texts[value:self.texts.index(b"\0", value)], length
                    at += length
                    continue
                # no key at this place: remembered only if no key begins with the character at all
                self.starts[char] = self._begins(char)
            yield char, size
            at += size

    def _begins(self, char: bytes) -> bool:
        trie, unit = self.trie, self.trie[0]
        node = unit >> 10 << ((unit & 512) >> 6)
        for b in char:
            node ^= b
            unit = trie[node]
            if unit & 0x800000FF != b:
                return False
            node ^= unit >> 10 << ((unit & 512) >> 6)
        return True

    def __call__(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes (and its end) the source byte it came from."""
        raw = text.encode()
        if not self.trie and not self.squeeze:
            return self._plain(text, raw)
        parts, weights, sources = [], [], []
        space = SPACE.encode() if self.escape else b" "
        at, end = 0, len(raw)
        steps = self._prefixes(raw) if self.trie else ((c.encode(), len(c.encode())) for c in text)
        skipping = squeezed = self.squeeze
        started = False
        for new, size in steps:
            if not started:
                if skipping and new == b" ":
                    at += size
                    continue
                started = True
                if self.dummy:
                    parts.append(space)
                    weights.append(len(space))
                    sources.append(at)
            if squeezed:
                new = new.lstrip(b" ")
            if new:
                squeezed = self.squeeze and new.endswith(b" ")
                if self.escape:
                    new = new.replace(b" ", space)
                parts.append(new)
                weights.append(len(new))
                sources.append(at)
            at += size
        if not parts:
            return "", np.zeros(1, np.int64)
        joined = b"".join(parts)
        origin = np.append(np.repeat(np.array(sources, np.int64), weights), end)
        if self.squeeze:
            while joined.endswith(space):
                joined = joined[:-len(space)]
                origin = origin[:len(joined) + 1]
        return joined.decode(), origin

    def _plain(self, text: str, raw: bytes) -> tuple[str, np.ndarray]:
        """No map, no squeezing: spaces become the space symbol."""
        if not raw:
            return "", np.zeros(1, np.int64)
        data = np.frombuffer(raw, np.uint8)
        wide = len(SPACE.encode()) if self.escape else 1
        times = np.where(data == 0x20, wide, 1)
        head = wide if self.dummy else 0
        origin = np.concatenate((np.zeros(head, np.int64), np.repeat(np.arange(len(raw)), times), [len(raw)]))
        text = " " * bool(self.dummy) + text
        return text.replace(" ", SPACE) if self.escape else text, origin


class PieceModel:
    def __init__(self, name: str = MODEL):
        if "/" not in name:
            import public_tokenizers

            name = public_tokenizers.path(name)
        with open(name, "rb") as f:
            parts = list(fields(f.read()))
        pieces = [dict(fields(v)) for k, v in parts if k == 1]
        trainer, spec, back = (next((v for k, v in parts if k == want), b"") for want in (2, 3, 5))
        trainer = dict(fields(trainer))
        self.normalise = Normaliser(spec)
        self.types = [p.get(3, NORMAL) for p in pieces]
        if trainer.get(3, 1) != 2 or trainer.get(24, 0) or {USER, UNUSED} & {*self.types} or dict(fields(back)).get(2):
            raise ValueError(f"{name}: not a BPE model of the kind that this operator encodes")
        self.names = [p[1].decode() for p in pieces]
        scores = [struct.unpack("<f", p.get(2, b"\0\0\0\0"))[0] for p in pieces]
        self.ids = {n: k for k, (n, t) in enumerate(zip(self.names, self.types)) if t == NORMAL}
        self.ranks = {n: -scores[k] for n, k in self.ids.items()}
        self.unknown = self.types.index(UNKNOWN)
        self.bytes = {int(n[3:5], 16): k for k, (n, t) in enumerate(zip(self.names, self.types)) if t == BYTE} if trainer.get(35, 0) else {}
        crosses = any(SPACE in n.lstrip(SPACE) or "\n" in n for n in self.ids)
        self.segments = re.compile(r".+" if crosses else rf"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+", re.S)
        self.forget()
        self.decoded = [b"" if t == CONTROL else UNKNOWN_SURFACE.encode() if t == UNKNOWN else n.replace(SPACE, " ").encode() for n, t in zip(self.names, self.types)]
        self.byte_of = {k: b for b, k in self.bytes.items()} | {k: int(n[3:5], 16) for k, (n, t) in enumerate(zip(self.names, self.types)) if t == BYTE}
        for k, b in self.byte_of.items():
            self.decoded[k] = bytes([b])
        self.controls = {k for k, t in enumerate(self.types) if t == CONTROL}
        self.strips = self.normalise.dummy or self.normalise.squeeze
        self._tables()

    @classmethod
    def shared(cls, name: str = MODEL) -> "PieceModel":
        if name not in _models:
            _models[name] = cls(name)
        return _models[name]

    # --- encoding

    def merged(self, segment: str) -> list[str]:
        """Pieces of a segment: the pair with the best score merges first, the leftmost of equal ones."""
        if len(segment) > LONGEST:
            return self._merged_long(segment)
        symbols, score, none = list(segment), self.ranks.get, _NEVER
        ranks = [score(a + b, none) for a, b in zip(segment, segment[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            k = ranks.index(best)
            symbols[k] += symbols[k + 1]
            del symbols[k + 1], ranks[k]
            if k < len(ranks):
                ranks[k] = score(symbols[k] + symbols[k + 1], none)
            if k:
                ranks[k - 1] = score(symbols[k - 1] + symbols[k], none)
        return symbols

    def _merged_long(self, segment: str) -> list[str]:
        """The same with a heap."""
        symbols: list[str | None] = list(segment)
        n, ranks = len(symbols), self.ranks
        following, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[a + b], k, a + b) for k, (a, b) in enumerate(zip(segment, segment[1:])) if a + b in ranks]
        heapq.heapify(heap)
        while heap:
            _, k, pair = heapq.heappop(heap)
            right = following[k]
            if symbols[k] is None or right >= n or symbols[k] + symbols[right] != pair:
                continue
            symbols[k], symbols[right] = pair, None
            after = following[k] = following[right]
            if after < n:
                before[after] = k
                if (new := pair + symbols[after]) in ranks:
                    heapq.heappush(heap, (ranks[new], k, new))
            left = before[k]
            if left >= 0 and (new := symbols[left] + pair) in ranks:
                heapq.heappush(heap, (ranks[new], left, new))
        return [s for s in symbols if s is not None]

    def _segment(self, segment: str) -> tuple[list[int], list[int]]:
        """ids, and where each piece ends in the segment's bytes."""
        ids, ends, at = [], [], 0
        for piece in self.merged(segment):
            raw = piece.encode()
            own = self.ids.get(piece)
            if own is None and self.bytes:
                ids += [self.bytes[b] for b in raw]
                ends += [at] * (len(raw) - 1)
            else:
                ids.append(self.unknown if own is None else own)
            at += len(raw)
            ends.append(at)
        return ids, ends

    def forget(self) -> None:
        """An empty cache: ``known`` numbers the segments, whose pieces follow one another in ``pool``."""
        self.known: dict[str, int] = {}
        self.pool = {k: np.zeros(0, np.int32) for k in ("ids", "ends", "counts", "bytes")}
        self.first = np.zeros(0, np.int64)

    def _keep(self, segments: list[str], ids: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> None:
        self.known.update(zip(segments, range(len(self.known), len(self.known) + len(segments))))
        new = {"ids": ids, "ends": ends, "counts": counts, "bytes": ends[np.cumsum(counts) - 1]}
        self.pool = {k: np.concatenate((self.pool[k], x)).astype(np.int32) for k, x in new.items()}
        self.first = np.cumsum(self.pool["counts"], dtype=np.int64) - self.pool["counts"]

    def learn(self, segments: list[str]) -> None:
        """Merges many distinct segments at once, round by round: in each round every open segment merges its best pair."""
        short = [x for x in segments if len(x) <= LONGEST]
        codes = np.frombuffer("".join(short).encode("utf-32-le"), np.uint32)
        owner = np.repeat(np.arange(len(short)), np.array([len(x) for x in short], np.int64))
        symbols = self.of_char[codes]
        strange = np.zeros(len(short), bool)  # with a character that the vocabulary lacks
        strange[owner[symbols < 0]] = True
        alone = [x for x in segments if len(x) > LONGEST] + [short[k] for k in np.flatnonzero(strange).tolist()]
        if alone:
            ids, ends = zip(*[self._segment(x) for x in alone])
            counts = np.array([len(x) for x in ids], np.int32)
            self._keep(alone, *[np.array(list(chain.from_iterable(x)), np.int32) for x in (ids, ends)], counts)
        plain = np.flatnonzero(~strange)
        if not len(plain):
            return
        use = ~strange[owner]
        symbols, owner = symbols[use], (np.cumsum(~strange) - 1)[owner[use]]
        merged, ranks = self._lookup(symbols, np.append(symbols[1:], 0), np.append(owner[1:] == owner[:-1], False))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(symbols):
            start = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            best = np.repeat(np.minimum.reduceat(ranks, start), np.diff(np.append(start, len(owner))))
            open_ = best < _NEVER
            if not open_.all():
                done.append((owner[~open_], symbols[~open_]))
                symbols, owner, merged, ranks, best = (x[open_] for x in (symbols, owner, merged, ranks, best))
            at = np.flatnonzero(ranks == best)
            at = at[np.append(True, owner[at[1:]] != owner[at[:-1]])] if len(at) else at  # the leftmost
            symbols[at] = merged[at]
            stay = np.ones(len(symbols), bool)
            stay[at + 1] = False
            symbols, owner, merged, ranks = symbols[stay], owner[stay], merged[stay], ranks[stay]
            at = at - np.arange(len(at))
            touched = np.zeros(len(symbols), bool)
            touched[at] = True
            touched[at[at > 0] - 1] = True
            again = np.flatnonzero(touched)
            follow = np.minimum(again + 1, len(symbols) - 1)
            merged[again], ranks[again] = self._lookup(symbols[again], symbols[follow], (owner[again] == owner[follow]) & (follow > again))
        owner, symbols = (np.concatenate([d[k] for d in done]) for k in range(2))
        by = np.argsort(owner, kind="stable")
        owner, symbols = owner[by], symbols[by]
        counts = np.bincount(owner, minlength=len(plain))
        ends = np.cumsum(self.sizes[symbols])
        before = np.concatenate(([0], ends))[np.cumsum(counts) - counts]
        self._keep([short[k] for k in plain.tolist()], symbols, ends - np.repeat(before, counts), counts)

    def _lookup(self, left: np.ndarray, right: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left * len(self.names) + right
        k = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        hit = joined & (self.pair_keys[k] == key)
        new = np.where(hit, self.pair_ids[k], 0)
        return new, np.where(hit, self.rank_of[new], _NEVER)

    def _tables(self) -> None:
        """The vocabulary as arrays: pieces of characters and of pairs of pieces."""
        self.of_char = np.full(0x110000, -1, np.int64)
        for n, k in self.ids.items():
            if len(n) == 1:
                self.of_char[ord(n)] = k
        self.sizes = np.array([len(n.encode()) for n in self.names], np.int64)
        self.rank_of = np.array([self.ranks.get(n, _NEVER) for n in self.names])
        pairs = {}
        for n, k in self.ids.items():
            for cut in range(1, len(n)):
                a, b = self.ids.get(n[:cut]), self.ids.get(n[cut:])
                if a is not None and b is not None:
                    pairs[a * len(self.names) + b] = k
        self.pair_keys = np.array(sorted(pairs) or [-1], np.int64)
        self.pair_ids = np.array([pairs.get(k, 0) for k in self.pair_keys.tolist()], np.int64)

    def encode_many(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, ends, edges): of the pieces of all texts, one after the other, with the spans of original bytes; those of text k
        are edges[k] to edges[k + 1]."""
        normed, origins = zip(*[self.normalise(t) for t in texts]) if texts else ((), ())
        found = [self.segments.findall(x) for x in normed]
        many = np.array([len(f) for f in found], np.int64)
        found = list(chain.from_iterable(found))
        if not found:
            none = np.zeros(0, np.int32)
            return none, none, none, np.zeros(len(texts) + 1, np.int64)
        missing = {*found}.difference(self.known)
        if len(self.known) + len(missing) > MOST or len(self.pool["ids"]) > MOST_IDS:
            missing = {*found}
            self.forget()
        if missing:
            self.learn(list(missing))
        which = np.fromiter(map(self.known.__getitem__, found), np.int64, len(found))
        counts, sizes = self.pool["counts"][which].astype(np.int64), self.pool["bytes"][which].astype(np.int64)
        place = np.repeat(self.first[which] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        ids = self.pool["ids"][place]
        text_of = np.repeat(np.arange(len(texts)), many)
        # a text's part of the joined origins has one entry more than its normalised bytes
        ends = self.pool["ends"][place] + np.repeat(np.cumsum(sizes) - sizes + text_of, counts)
        owner = np.repeat(text_of, counts)
        if not self.bytes:  # neighbouring unknown pieces are one
            last = np.append((ids[1:] != self.unknown) | (ids[:-1] != self.unknown) | (owner[1:] != owner[:-1]), True)
            ids, ends, owner = ids[last], ends[last], owner[last]
        stops = np.concatenate(origins)[ends].astype(np.int32)
        begins = np.append(0, stops[:-1]).astype(np.int32)
        edges = np.searchsorted(owner, np.arange(len(texts) + 1))
        heads = np.flatnonzero(np.diff(edges))
        begins[edges[heads]] = [origins[k][0] for k in heads.tolist()]
        return ids, begins, stops, edges

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, and the span [begin, end) of original bytes of each piece."""
        return self.encode_many([text])[:3]

    # --- decoding

    def decode(self, ids: list[int]) -> str:
        """The text of ids, as the library's ``decode``: without the space that the encoding put first."""
        table, bytes_, types = self.decoded, self.byte_of, self.types
        at, head = 0, b""
        while self.strips and at < len(ids):  # the first piece that isn't control loses a leading space
            k = ids[at]
            if types[k] == CONTROL:
                at += 1
                continue
            if types[k] == NORMAL:
                at += 1
                head = table[k]
                if head.startswith(b" "):
                    head = head[1:]
                    if self.normalise.squeeze and not head:
                        continue
            break
        if self.controls.isdisjoint(ids):
            try:
                return (head + b"".join([table[k] for k in ids[at:]])).decode()
            except UnicodeDecodeError:
                pass
        out, run = [head.decode()], bytearray()
        for k in ids[at:]:
            if k in bytes_:
                run.append(bytes_[k])
                continue
            out += [_bytes_text(run), table[k].decode()]
            run.clear()
        return "".join([*out, _bytes_text(run)])


def _bytes_text(run: bytearray) -> str:
    """Characters of byte pieces; a byte that belongs to none is U+FFFD."""
    out, at = [], 0
    while at < len(run):
        size = 1 if run[at] < 0x80 else 2 if run[at] < 0xE0 else 3 if run[at] < 0xF0 else 4
        try:
            out.append(run[at:at + size].decode())
            at += size
        except UnicodeDecodeError:
            out.append("�")
            at += 1
    return "".join(out)


# --- over a table --------------------------------------------------------------------------------

def encode(docs: DataFrame, *, model: str = MODEL, text: str = "text") -> DataFrame:
    """docs, with ids, begins and ends (arrays of int) in place of ``text``: the pieces and the spans of original bytes that they cover."""
    new = ("ids", "begins", "ends")
    others = [c for c in docs.columns if c != text and c not in new]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*[f"`{c}`" for c in others]).schema], *[f"{c} array<int>" for c in new]])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PieceModel.shared(model)

        def packed(batch: pa.RecordBatch, lo: int, got: list[str]) -> pa.RecordBatch:
            *parts, edges = coder.encode_many(got)
            lists = [pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(x, pa.int32())) for x in parts]
            return pa.RecordBatch.from_arrays([*[batch.column(k).slice(lo, len(got)) for k in range(len(others))], *lists], names=[*others, *new])

        for batch in batches:
            lo, got, size = 0, [], 0
            for x in batch.column(len(others)):
                value = x.as_py() or ""
                got.append(value)
                size += len(value)
                if size >= OUT_BYTES:
                    yield packed(batch, lo, got)
                    lo, got, size = lo + len(got), [], 0
            if got:
                yield packed(batch, lo, got)

    return docs.select(*[F.col(f"`{c}`") for c in others], F.col(f"`{text}`").alias("__text")).mapInArrow(lean(rows), schema)


def decode(rows: DataFrame, *, model: str = MODEL, ids: str = "ids", text: str = "text") -> DataFrame:
    """rows, with the text of ``ids`` as ``text``; null ids have the empty text."""
    others = [c for c in rows.columns if c != text]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*[f"`{c}`" for c in others]).schema], f"`{text}` string"])

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = PieceModel.shared(model)
        for batch in batches:
            column = batch.column(others.index(ids))
            edges, flat = column.offsets.to_numpy().tolist(), column.values.to_numpy(zero_copy_only=False)
            lo, out, size = 0, [], 0
            for k in range(batch.num_rows):
                out.append(coder.decode(flat[edges[k]:edges[k + 1]].tolist()))
                size += len(out[-1])
                if size >= OUT_BYTES or k == batch.num_rows - 1:
                    yield pa.RecordBatch.from_arrays([*[c.slice(lo, len(out)) for c in batch.columns], pa.array(out, pa.string())], names=[*others, text])
                    lo, out, size = lo + len(out), [], 0

    return rows.select(*[F.col(f"`{c}`") for c in others]).mapInArrow(lean(texts), schema)
