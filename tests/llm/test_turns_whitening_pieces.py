"""Conversation repair, whitening and SentencePiece against brute force and the library, through the registered queries."""
import functools
import hashlib
import itertools
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from roadflow.llm import queries, turns
from roadflow.llm.pieces import Normaliser, PieceModel, decode, encode
from roadflow.llm.whitening import refined_eigenvectors, whiten

WHITE = " \t\n\x0b\x0c\r"
TURNS = T.StructType([T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()), T.StructField("text", T.StringType())])
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])


# --- conversations

def least_audit(letters):
    """(cost, ASCII-least audit) over an automaton of the grammar, with whole audits compared."""
    n = len(letters)

    @functools.cache
    def go(i, state, inserted):  # 0: nothing yet, 1: after s, 2: after u, 3: after a
        ways = [(0, "")] if i == n and state in (0, 3) else []
        after, want = (2, "u") if state != 2 else (3, "a")

        def edit(price, letter, rest):
            ways.append((price + rest[0], letter + rest[1]))

        if i < n:
            edit(2, "D", go(i + 1, state, 0))
            c = letters[i]
            if c != "-":
                extra = 5 * c.isupper()
                if c.lower() == want:
                    edit(extra, "K", go(i + 1, after, 0))
                if c.lower() == "s" and state == 0:
                    edit(extra, "K", go(i + 1, 1, 0))
                edit(1 + extra, "R", go(i + 1, after, 0))
        if inserted < 3:
            edit(5, "I", go(i, after, inserted + 1))
        return min(ways, default=(10 ** 9, "~"))

    return go(0, 0, 0)


def expected_conversation(rows):
    """The contract, read row by row: rows of one conversation after the damage, in order."""
    seen, letters, counts = set(), "", [0, 0, 0]
    for _, role, text in rows:
        end = text.rstrip(WHITE)
        initial = role[:1] if role[:1] in ("s", "u", "a") else "o"
        fault = 0 if not end else 1 if (role, text) in seen else 2 if end[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        letters += "-" if fault in (0, 1) else initial.upper() if fault == 2 else initial
    numbers = [t for t, _, _ in rows if t is not None]
    gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = least_audit(letters)
    total, out, given = len(audit) - audit.count("D"), [], iter(rows)
    for e in audit:
        row = next(given) if e != "I" else None
        if e == "D":
            continue
        left = total - len(out)
        role = row[1] if e == "K" else "assistant" if left % 2 else "user"
        out.append(f"{role}:{row[2] if row else ''}")
    return (gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def after_damage(rows):
    out, ids = defaultdict(list), set()
    for conv, turn, role, text in rows:
        ids.add(conv)
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out[conv] += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return ids, {c: sorted(out[c], key=lambda r: (r[0] is not None, r[0] or 0)) for c in ids}


def random_turns(seed, conversations=120):
    rng = random.Random(seed)
    rows = []
    for c in range(conversations):
        for t in range(rng.randint(1, 14)):
            role = rng.choice(["user", "assistant"]) if rng.random() < 0.3 else ["user", "assistant"][t % 2]
            role = rng.choice(["system", "tool", "", None]) if rng.random() < 0.1 else role
            text = rng.choice([f"Say {t}.", f"Say {t}!\n", "Yes.", "Yes.", "cut off", "  ", "", None, "é? \t", f"long {'x ' * 50}."])
            rows.append((c, t + (t > 3) * rng.randint(0, 3), role, text))
    seen, unique = set(), []
    for r in rows:  # equal numbers in a conversation have no order of their own
        if (r[0], r[1]) not in seen:
            seen.add((r[0], r[1]))
            unique.append(r)
    return unique


def test_conversation_query_equals_brute_force(spark, tmp_path):
    rows = random_turns(5) + [(None, 1, "user", "Hello."), (None, 2, "assistant", "Hi."), (900, None, "user", "A."), (901, None, None, None),
                              (902, 5, "system", "Only."), (903, -(1 << 62), "user", "a."), (903, 1 << 61, "assistant", "b.")]
    df = spark.createDataFrame(rows, TURNS).withColumns({c: F.lit("x") for c in ("seq", "place", "audit", "letters", "same")})
    df.repartition(5).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in queries.op11_conversation_repair(spark, str(tmp_path)).collect()}
    ids, damaged = after_damage(rows)
    assert got.keys() == ids
    for c in ids:
        assert got[c] == expected_conversation(damaged[c]), (c, damaged[c])


def test_conversations_without_rows(spark, tmp_path):
    dropped = [(c, 0, "user", "A.") for c in range(60)]
    spark.createDataFrame(dropped, TURNS).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: tuple(r)[1:] for r in queries.op11_conversation_repair(spark, str(tmp_path)).collect()}
    gone = [c for c in range(60) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    assert len(got) == 60 and gone
    assert all(got[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone)
    spark.createDataFrame([], TURNS).write.parquet(f"{tmp_path}/none/conversations.parquet")
    assert queries.op11_conversation_repair(spark, f"{tmp_path}/none").collect() == []


def test_repeated_rows_and_equal_turns(spark):
    """Equal rows are duplicates of each other; turns of one number come by role, whatever the input order."""
    rows = [(1, 0, "user", "A."), (1, 0, "user", "A."), (2, 0, "user", "Q."), (2, 0, "assistant", "R."), (2, 0, "system", "S.")]
    for parts in (1, 4):
        done = turns.repair(spark.createDataFrame(rows, TURNS).repartition(parts))
        got = {r.conv_id: r for r in done.audits.collect()}
        assert (got[1].duplicate, got[1].audit, got[1].cost) == (1, "DD", 4)
        assert got[2].audit == turns.cheapest("asu")[1] and got[2].illegal == 1


def test_alignment_equals_brute_force_for_all_short_strings():
    for n in range(5):
        for letters in map("".join, itertools.product("-suaoSUA", repeat=n)):
            assert turns.cheapest(letters)[:2] == least_audit(letters), letters


@pytest.mark.parametrize("cells", [1 << 22, 8])
def test_alignment_of_longer_strings(monkeypatch, cells):
    """Also where only some rows of the table are kept."""
    monkeypatch.setattr(turns, "TABLE_CELLS", cells)
    rng = random.Random(cells)
    for _ in range(250):
        letters = "".join(rng.choice("uauauaua-sSUAo") for _ in range(rng.randint(5, 40)))
        cost, audit, roles = turns._cheapest(letters)
        assert (cost, audit) == least_audit(letters), letters
        assert re.fullmatch("(s?(ua)+)?", roles) and turns.incumbent(letters) >= cost


def test_one_conversation_of_many_turns(spark):
    """One conversation holds most rows: its turns are ordered by many tasks, and its text streams."""
    rows = [(7, t, ["user", "assistant"][t % 2 if t % 50 else 1], f"turn {t}.") for t in range(6000)] + [(c, 0, "user", "x.") for c in range(100, 200)]
    done = turns.repair(spark.createDataFrame(rows, TURNS).repartition(8))
    got = {r.conv_id: r for r in turns.digests(done).collect()}
    letters = "".join(["u", "a"][t % 2 if t % 50 else 1] for t in range(6000))
    assert (got[7].cost, got[7].audit) == turns.cheapest(letters)[:2] and len(got) == 101


# --- whitening

def test_whitening_query_equals_a_dense_solution(spark, tmp_path):
    rng = np.random.default_rng(4)
    x = (rng.normal(size=(400, 24)) * np.linspace(0.05, 1, 24)).astype(np.float32)
    rows = [(k, [float(v) for v in x[k]], 1) for k in range(400)] + [(1000 + k, [float(v) for v in x[k % 7]], 2) for k in range(200)]
    bad = [(5000, None, 1), (5001, [None] * 24, 1), (5002, [float("nan")] * 24, 1), (5003, [float("inf")] * 24, 1), (5004, [], 1), (5005, [1.0] * 8, 1)]
    df = spark.createDataFrame(rows + bad + rows[:1], VECTORS).withColumns({c: F.lit(0) for c in ("x", "n", "cell", "component")})
    df.repartition(6).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = queries.op12_embedding_whitening(spark, str(tmp_path)).collect()
    ints = np.floor(64 * np.array([r[1] for r in rows], np.float32).astype(np.float64)).astype(np.int64) + 1_000_000
    fit = np.unique(ints, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = fit - total / n
    value, vector = np.linalg.eigh(centred.T @ centred / n)
    value, vector = value[::-1][:16], vector[:, ::-1][:, :16]
    want = (ints - total / n) @ vector / np.sqrt(value)
    place = {r[0]: k for k, r in enumerate(rows)}
    assert len(got) == (len(rows) + 1) * 16
    out = np.zeros_like(want)
    for r in got:
        k = place[r.vec_id]
        out[k, r.component - 1] = r.whitened
        assert r.n == n and r.deviation == int(((n * ints[k] - total) ** 2).sum()) and r.identity_error < 1e-10
        assert abs(r.explained - value[r.component - 1] / np.trace(centred.T @ centred / n)) < 1e-12
    signs = np.sign((out * want).sum(axis=0))
    assert np.abs(out * signs - want).max() < 1e-8


def test_whitening_is_the_same_under_any_partitioning(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(k, [float(v) for v in rng.normal(size=6)], 0) for k in range(300)], VECTORS)
    first, second = (sorted(map(tuple, whiten(df.repartition(p), components=3).collect())) for p in (1, 7))
    assert [r[:4] + r[5:6] for r in first] == [r[:4] + r[5:6] for r in second]
    assert np.abs(np.array([r[4] for r in first]) - np.array([r[4] for r in second])).max() < 1e-13


def test_whitening_of_odd_tables(spark):
    assert whiten(spark.createDataFrame([], VECTORS)).collect() == []
    assert whiten(spark.createDataFrame([(1, None, 0), (2, [], 0)], VECTORS)).collect() == []
    same = whiten(spark.createDataFrame([(k, [1.0, 2.0], 0) for k in range(5)], VECTORS)).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in same] == [(1, 0, 0.0, 0.0, 0.0)] * 10
    zero = whiten(spark.createDataFrame([(1, [0.0, 0.0], 0), (2, [1.0, 0.0], 0), (None, [0.0, 0.0], 0)], VECTORS)).collect()
    assert {(r.vec_id, r.component, abs(r.whitened)) for r in zero} == {(i, c, 1.0 if c == 1 else 0.0) for i in (1, 2, None) for c in (1, 2)}
    huge = whiten(spark.createDataFrame([(k, [3e38 * (k % 2), 1e30 * k, float(k)], 0) for k in range(6)], VECTORS)).collect()
    assert len(huge) == 18 and all(np.isfinite(r.whitened) for r in huge) and max(r.deviation for r in huge) == (1 << 63) - 1


@pytest.mark.parametrize("values", [[10.0] * 8 + [1.0] * 8, [10 + 1e-9 * k for k in range(16)], [1.0] * 12, [1e6, 1e6 + 1e-3, 1, 1e-3, 1e-9, 0, 0], [5.0], [100 * 0.5 ** k for k in range(30)],
                                    [7 + 1e-13 * k for k in range(5)] + [3 + 1e-6 * k for k in range(5)] + [0.5, 0.1]])
def test_refinement_handles_clusters(values):
    rng = np.random.default_rng(len(values))
    q = np.linalg.qr(rng.normal(size=(len(values),) * 2))[0].astype(np.longdouble)
    for _ in range(4):
        q = q + q @ (np.eye(len(q)) - q.T @ q) / 2
    v = (q * np.array(values, np.longdouble)) @ q.T
    v = (v + v.T) / 2
    e, x = refined_eigenvectors(v)
    assert np.abs(x.T @ x - np.eye(len(v))).max() < 1e-17
    assert np.abs(v @ x - x * e).max() / np.abs(v).max() < 1e-15
    assert np.abs(e - np.sort(np.array(values, np.longdouble))[::-1]).max() < 1e-15 * max(values)


# --- SentencePiece

ODD = ["", None, " ", "  ", "a", "\n\n x", "▁", "▁▁ a", "<s>", "<0x41>", "a\0b", "日本語テキスト", "👩‍👩‍👧 x", "x" * 5000, "é" * 300, " " * 100, "\t \r\n", "ﬁ①", "a  b   c    d",
       "</s> <unk>", "ab▁cd", "🙂▁🙂 ", "ß�\U0010ffff" + " " * 37 + "z", "\n", " \n ", "▁ ▁\n▁", "word " * 30_000, "nospace" * 20_000]


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def random_texts(alphabet, count, seed, most=40):
    rng = random.Random(seed)
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, most))) for _ in range(count)]


def test_piece_query_equals_the_library(spark, tmp_path, make_docs, library):
    texts = ODD + random_texts("ab e▁\n é日🙂<s>0\t́.,THEingtion", 400, 1)
    df = make_docs([*enumerate(texts), (3, texts[3]), (None, "a null id")]).withColumns({c: F.lit("x") for c in ("ids", "begins", "ends", "__text")})
    df.write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_sentencepiece(spark, str(tmp_path)).collect()
    assert len(got) == len(texts) + 2
    for r in got:
        text = "a null id" if r.doc_id is None else texts[r.doc_id] or ""
        ids = library.encode(text)
        assert r.n_tokens == len(ids), text[:50]
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids).encode()).hexdigest()


def test_pieces_are_projected_to_source_bytes(library):
    model = PieceModel()
    for text in [t or "" for t in ODD] + random_texts("ab e▁\n é日🙂<s>0\t́", 1500, 2):
        ids, begins, ends = model.encode(text)
        proto = library.encode(text, return_type="proto").pieces
        assert (ids.tolist(), begins.tolist(), ends.tolist()) == ([p.id for p in proto], [p.begin for p in proto], [p.end for p in proto]), text[:80]


def test_a_full_cache_is_emptied(monkeypatch, library):
    monkeypatch.setattr("roadflow.llm.pieces.MOST", 20)
    model = PieceModel()
    for k in range(30):
        texts = random_texts("abcde fghi\n", 12, k)
        ids, _, _, edges = model.encode_many(texts)
        assert [ids[a:b].tolist() for a, b in zip(edges[:-1], edges[1:])] == [library.encode(t) for t in texts]
        assert len(model.known) <= 400


def test_decoding_of_any_ids_equals_the_library(library):
    model, rng = PieceModel(), random.Random(6)
    usual = [0, 1, 2, 3, 4, 200, 230, 240, 258, 29871, 259, 268]
    for _ in range(3000):
        ids = [rng.choice([*usual, rng.randrange(32_000), rng.randrange(3, 259)]) for _ in range(rng.randint(0, 12))]
        assert model.decode(ids) == library.decode(ids), ids


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "nfkc_cf", "identity"])
@pytest.mark.parametrize("squeeze", [True, False])
def test_normalisation_through_compiled_maps_equals_the_library(rule, squeeze):
    import sentencepiece

    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule, remove_extra_whitespaces=squeeze)
    own = Normaliser(theirs.serialized_normalizer_spec())
    starts = lambda x: np.concatenate(([0], np.cumsum([len(c.encode()) for c in x]))).astype(int)
    for text in [t or "" for t in ODD[:-2]] + random_texts("abＡＢ　  ﬁ①é́e が゛がｶﾞ¨\t\n①²ßİ​̈\0ﷺ가가̈", 800, 3, 20):
        norm, origin = own(text)
        expected, offsets = theirs.normalize(text, with_offsets=True)
        assert norm == expected, text
        if norm:  # offsets of characters there, of bytes here
            assert origin[starts(norm)].tolist() == starts(text)[offsets].tolist(), text


def test_round_trip_over_a_table(spark, make_docs):
    texts = [t for t in ODD if t and not t.startswith("▁") and "▁" not in t]
    coded = encode(make_docs(list(enumerate(texts))))
    assert coded.columns == ["doc_id", "lang", "source", "n_chars", "ids", "begins", "ends"]
    got = {r.doc_id: r.text for r in decode(coded).collect()}
    assert got == dict(enumerate(texts))
    assert encode(make_docs([])).collect() == []
