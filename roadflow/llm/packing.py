"""Best-fit packing of tokenized documents into fixed-length sequences.

The histogram of piece lengths (at most ``size`` numbers, whatever the corpus) defines a
configuration linear program: a configuration is a multiset of lengths that fits one
sequence, and the fewest sequences cover every length as often as it occurs. The program is solved as a covering
problem by multiplicative weights with knapsack dynamic programming as its oracle (``solve_program``). The averaged solution
is scaled, rounded down, and what is left is placed best-fit, longest first, on counts, never on rows. It is taken unless it
needs more sequences than best-fit decreasing alone; the better of the dual and the volume bound is reported with the plan.

The plan (length, ordinal range -> sequence, offset) goes to the executors as a table
whose size depends on ``size`` and the number of rounds only. Pieces get ordinals within their
length from counts per (length, salt), so a length that holds a third of all pieces is split.

Defined results: null and empty texts are the single end id; longer documents are cut into
pieces of ``size`` ids (the last may be shorter); an empty table gives an empty result; equal
rows are packed separately; other columns are ignored.
"""

from __future__ import annotations

import logging
import math
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import lean, materialise
from .tokens import WordTokenizer

logger = logging.getLogger(__name__)

SIZE = 4096
ROUNDS = 240
PHASES = (0.3, 0.1, 0.03, 0.015)  # eps
STEPS = 60_000  # in all phases
TOLERANCE = 0.0005
SALTS = 64

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def tokenize_pieces(docs: DataFrame, tokenizer: str = "word_bpe_49k.json", end_id: int = 1, size: int = SIZE) -> DataFrame:
    """Rows ``PIECES``: the ids of each text and ``end_id``, cut every ``size`` ids."""
    import zlib

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = WordTokenizer.shared(tokenizer)
        end = int(end_id).to_bytes(4, "little")
        for batch in batches:
            ids, rows = batch.column(0).to_pylist(), []
            for doc_id, text in zip(ids, batch.column(1)):
                raw = encode.id_bytes(text.as_py() or "") + end
                for k in range(0, len(raw), 4 * size):
                    part = raw[k:k + 4 * size]
                    rows.append((doc_id, k // (4 * size), k // 4, len(part) // 4, zlib.crc32(part)))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(pieces), PIECES)


def price_knapsack(lengths: np.ndarray, values: np.ndarray, most: np.ndarray, size: int) -> Counter:
    """The configuration of largest value: dynamic programming over capacities; each length at most ``most`` times (split in powers of two)."""
    best = np.zeros(size + 1)
    steps: list[tuple[int, int, np.ndarray]] = []
    for k in np.argsort(-lengths, kind="stable").tolist():
        length, left, times = int(lengths[k]), int(min(most[k], size // lengths[k])), 1
        while left > 0:
            n = min(times, left)
            w = n * length
            if w > size:
                break
            with_it = best[:-w] + n * values[k]
            take = with_it > best[w:] + 1e-12
            np.copyto(best[w:], with_it, where=take)
            steps.append((k, n, take))
            left, times = left - n, times * 2
    room, used = size, Counter()
    for k, n, take in reversed(steps):
        w = n * int(lengths[k])
        if room >= w and take[room - w]:
            used[k] += n
            room -= w
    return used


def solve_program(histogram: dict[int, int], size: int, rounds: int = ROUNDS, known: list[tuple[dict[int, int], int]] | None = None) -> tuple[list[tuple[dict[int, int], float]], float, float]:
    """Multiplicative weights on the configuration program as a covering problem over all counts: the averaged and scaled
    solution (configuration, times) that covers every count, its number of sequences, and the best dual bound.

    A length's weight is exp(-eps * coverage) / count, where coverage is how often its count is covered so far. Each step adds
    the most valuable known configuration until some length of it is covered once more; the known ones are those of
    best-fit decreasing and what the knapsack finds, which prices the weights ``rounds`` times in all, evenly over the phases, and the
    averaged weights when a phase ends. Prices over the knapsack's value are a dual solution. A phase ends when every coverage
    has reached log(m) / eps^2; its first quarter, in which the weights find their level, is left out of the average.
    The next phase has a smaller eps, until a solution is within ``TOLERANCE`` of the bound. The first solution, which the
    phases have to better, is ``known`` (best-fit decreasing)."""
    lengths = np.array(sorted(histogram), np.int64)
    counts = np.array([histogram[int(x)] for x in lengths], float)
    m = len(lengths)
    if not m:
        return [], 0.0, 0.0
    most = np.minimum(counts, size // lengths).astype(np.int64)
    place = {int(x): i for i, x in enumerate(lengths)}
    where: list[np.ndarray] = []  # the known configurations: which lengths, how many
    held: list[np.ndarray] = []
    met: dict[tuple, int] = {}
    pool = np.zeros((m, 64), np.int16)  # the same by length

    def add(config: dict[int, int]) -> None:
        nonlocal pool
        key = tuple(sorted(config.items()))
        if key in met:
            return
        k = met[key] = len(where)
        if k == pool.shape[1]:
            pool = np.hstack((pool, np.zeros_like(pool)))
        where.append(np.array([i for i, _ in key], np.int64))
        held.append(np.array([c for _, c in key], float))
        pool[where[k], k] = held[k]

    def values(weight: np.ndarray) -> np.ndarray:
        return np.array([h @ weight[at] for at, h in zip(where, held)])

    def price(weight: np.ndarray) -> None:
        nonlocal bound
        top = weight.max()
        used = price_knapsack(lengths, weight / top, most, size)
        # the knapsack takes smaller gains for none
        bound = max(bound, float(counts @ weight) / (sum(c * weight[i] for i, c in used.items()) + 1e-9 * top))
        add({int(i): int(c) for i, c in used.items()})

    known = best_fit_decreasing(histogram, size) if known is None else known
    whole = sum(t for _, t in known)
    for contents, _ in known:
        add({place[x]: c for x, c in contents.items()})
    # best-fit decreasing is the first solution; only a better one takes its place
    best, bound = np.zeros(len(where)), float((counts * lengths).sum()) / size
    for contents, n in known:
        best[met[tuple(sorted((place[x], c) for x, c in contents.items()))]] += n
    least = float(whole)
    for eps in PHASES:
        goal = max(1.0, math.log(m + 1)) / eps ** 2
        every = max(1, int(min(m * goal, STEPS) / max(1, rounds // len(PHASES))))
        covered, times, weight, mean = np.zeros(m), np.zeros(pool.shape[1]), 1 / counts, np.zeros(m)
        base, begun, low = None, np.zeros(m), 0.0
        for step in range(STEPS):
            if step % every == 0:
                price(weight)
                times = np.append(times, np.zeros(pool.shape[1] - len(times)))
                worth, low = values(weight), float(covered.min())
                if base is None and low >= goal / 4:
                    base, begun, mean = times.copy(), covered.copy(), np.zeros(m)
                if low >= goal:
                    break
            k = int(worth.argmax())
            at = where[k]
            n = float((counts[at] / held[k]).min())
            mean += weight / worth[k]
            times[k] += n
            covered[at] += held[k] * n / counts[at]
            fallen = np.exp(-eps * covered[at]) / counts[at]
            worth -= (weight[at] - fallen) @ pool[at, :len(worth)]
            weight[at] = fallen
        price(mean)
        for t, c in ((times, covered), (times - np.append(base, np.zeros(len(times) - len(base))), covered - begun) if base is not None else (times, covered)):
            if c.min() > 0 and t.sum() / c.min() < least:
                best, least = t / c.min(), float(t.sum() / c.min())
        if least <= max(bound * (1 + TOLERANCE), math.ceil(bound - 1e-6)):
            break
    order = [k for k in np.argsort(-best, kind="stable").tolist() if best[k] > 1e-9]
    return [({int(lengths[i]): int(c) for i, c in zip(where[k], held[k])}, float(best[k])) for k in order], least, bound


def rounded(program: list[tuple[dict[int, int], float]], histogram: dict[int, int]) -> list[tuple[dict[int, int], int]]:
    """The solution rounded down; what it covers beyond a length's count is left out of the configurations."""
    left, out = dict(histogram), []
    for config, times in program:
        whole = int(times + 1e-9)
        if whole:
            fits = {x: min(n, left[x] // whole) for x, n in config.items()}
            fits = {x: n for x, n in fits.items() if n}
            if fits:
                out.append((fits, whole))
                for x, n in fits.items():
                    left[x] -= n * whole
    return out


def solve_configurations(histogram: dict[int, int], size: int, rounds: int) -> list[tuple[dict[int, int], int]]:
    """(configuration, times) of the rounded solution, never covering a length beyond its count."""
    return rounded(solve_program(histogram, size, rounds)[0], histogram)


def best_fit_decreasing(left: dict[int, int], size: int, begun: list[tuple[dict[int, int], int]] = ()) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing on counts: groups of equal sequences, split when only some get the next length. Sequences that
    are ``begun`` are filled up too."""
    rooms: dict[int, list[list]] = defaultdict(list)  # free room -> groups [contents, times]
    open_rooms = np.zeros(size + 1, np.int64)
    for contents, times in begun:
        room = size - sum(x * n for x, n in contents.items())
        rooms[room].append([contents, times])
        open_rooms[room] += times
    for length in sorted((x for x, n in left.items() if n > 0), reverse=True):
        n = left[length]
        while n > 0:
            fits = np.flatnonzero(open_rooms[length:])
            if not len(fits):  # new sequences, filled with as many of this length as fit
                per = min(size // length, n)
                room, times = size - per * length, n // per
                rooms[room].append([{length: per}, times])
                open_rooms[room] += times
                n -= times * per
                continue
            room = length + int(fits[0])
            contents, times = rooms[room].pop()
            per = min(room // length, n)
            use = min(times, n // per)
            open_rooms[room] -= use
            if use < times:
                rooms[room].append([contents, times - use])
            grown = dict(contents)
            grown[length] = grown.get(length, 0) + per
            rooms[room - per * length].append([grown, use])
            open_rooms[room - per * length] += use
            n -= use * per
    return [(c, t) for groups in rooms.values() for c, t in groups if t]


def plan_sequences(histogram: dict[int, int], size: int = SIZE, rounds: int = ROUNDS) -> pd.DataFrame:
    """length, first ordinal, end ordinal, per (of this length in each sequence), sequence (first number),
    offset (of the first of them). Every ordinal below the length's count is in exactly one range. Its ``attrs`` hold the number
    of ``sequences`` and the ``bound`` that no packing can be under."""
    left = {int(k): int(v) for k, v in histogram.items()}
    final: list[tuple[dict[int, int], int]] = []
    if size in left:
        final.append(({size: 1}, left.pop(size)))
    whole = sum(t for _, t in final)
    alone = best_fit_decreasing(left, size)
    fewest = sum(t for _, t in alone)
    program, _, dual = solve_program(left, size, rounds, known=alone)
    bound = max(-(-sum(x * c for x, c in left.items()) // size), math.ceil(dual - 1e-6))
    begun = rounded(program, left)
    rest = Counter(left)
    for config, times in begun:
        rest.subtract({x: c * times for x, c in config.items()})
    packed = best_fit_decreasing(rest, size, begun)
    if sum(t for _, t in packed) > fewest:
        packed = alone
    fewest = sum(t for _, t in packed)
    final += packed
    rows, sequence, done = [], 0, Counter()
    for config, times in final:
        offset = 0
        for x in sorted(config, reverse=True):
            n = config[x]
            rows.append((x, done[x], done[x] + n * times, n, sequence, offset))
            done[x] += n * times
            offset += n * x
        sequence += times
    plan = pd.DataFrame(rows, columns=["length", "first", "end", "per", "sequence", "offset"]).astype("int64")
    plan.attrs.update(sequences=whole + fewest, bound=whole + bound)
    logger.info("%d sequences, at least %d are needed", whole + fewest, whole + bound)
    return plan


def pack(docs: DataFrame, *, tokenizer: str = "word_bpe_49k.json", size: int = SIZE, rounds: int = ROUNDS) -> DataFrame:
    """Every piece with its sequence and place in it."""
    pieces = materialise(tokenize_pieces(docs, tokenizer, size=size), "pieces")
    return pack_pieces(pieces, size=size, rounds=rounds)


def pack_pieces(pieces: DataFrame, *, size: int = SIZE, rounds: int = ROUNDS) -> DataFrame:
    """Packs rows with a ``length`` (1 to ``size``); adds sequence_id and offset."""
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(SALTS)).cast("int"))
    per_salt = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    counts = per_salt.toPandas()  # at most size * SALTS numbers
    counts = counts.sort_values(["length", "salt"])
    counts["base"] = counts.groupby("length")["n"].cumsum() - counts["n"]
    histogram = counts.groupby("length")["n"].sum().to_dict()
    plan = plan_sequences(histogram, size, rounds).sort_values(["length", "first"])
    base = {(int(a), int(b)): int(c) for a, b, c in counts[["length", "salt", "base"]].itertuples(index=False)}
    base_table = np.full((size + 1, SALTS), 0, np.int64)
    for (a, b), c in base.items():
        base_table[a, b] = c
    p = {c: plan[c].to_numpy() for c in plan.columns}
    begins = np.searchsorted(p["length"], np.arange(size + 2))
    shared = pieces.sparkSession.sparkContext.broadcast((base_table, p, begins))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bases, plan_, begin = shared.value
        # one increasing key for both columns finds the range by a single binary search
        span = int(plan_["end"].max()) + 1 if len(plan_["end"]) else 1
        keys = plan_["length"] * span + plan_["first"]
        for batch in batches:
            length = batch.column("length").to_numpy()
            order = bases[length, batch.column("salt").to_numpy()] + batch.column("rank").to_numpy() - 1
            at = np.searchsorted(keys, length * span + order, side="right") - 1
            k = order - plan_["first"][at]
            sequence = plan_["sequence"][at] + k // plan_["per"][at]
            offset = plan_["offset"][at] + (k % plan_["per"][at]) * length
            names = [c for c in batch.schema.names if c not in ("salt", "rank")]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in names), pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                                             names=[*names, "sequence_id", "offset"])

    rank = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")).cast("long")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields) + ", sequence_id long, offset long"
    return salted.withColumn("rank", rank).mapInArrow(lean(place), schema)
