"""The registered queries themselves, over small whole tables with odd rows: against their SQL, or row by row against brute force."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F, types as T
from tokenizers import Tokenizer

from roadflow.llm import queries
from roadflow.plans.check import compare

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])
PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])
LANG = {"en": "the of and to in is it that for was".split(), "de": "der die und in den von zu das mit sich".split()}


def _texts(rng):
    base = []
    for k in range(60):
        words = LANG["en" if k % 2 else "de"]
        base.append((" ".join(rng.choice(words) + rng.choice(["", "", "s", "en"]) for _ in range(rng.randint(5, 160))) + ".", "en" if k % 2 else "de"))
    rows = [(k, t, lang, f"s{k % 4}") for k, (t, lang) in enumerate(base)]
    for k in range(40):
        text, lang = rng.choice(base)
        words = text.split()
        for _ in range(rng.choice([0, 0, 1, 2, 8])):
            words[rng.randrange(len(words))] = "changed"
        rows.append((100 + k, " ".join(words), lang, "copies"))
    passage = base[3][0][:300] + "é" * 60
    rows += [(200 + k, f"{rng.random()} {passage} {rng.random()}", "en", None) for k in range(6)]
    odd = [None, "", " \t\n", "one", "ONE", "two words", "Two\nWords", "x" * 5000, "ä " * 400, "日本語のテキスト", "1234 5678", "a\0b c", "long " * 9000, "-----" * 50]
    return rows + [(300 + k, t, None, "odd") for k, t in enumerate(odd)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, make_docs):
    path, rng = str(tmp_path_factory.mktemp("tables")), random.Random(11)
    extra = {c: F.lit("x") for c in ("id", "key", "size", "w", "class", "word", "score", "list", "cell")}
    rows = _texts(rng)
    make_docs(rows, 4).withColumns(extra).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] % 3 > 0)) for r in rows[:90]], "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    gen = np.random.default_rng(3)
    x = gen.standard_normal((260, 12)).astype(np.float32)
    for k in range(150, 260):
        x[k] = x[gen.integers(0, 12)] + gen.choice([0, 0.02, 0.3]) * gen.standard_normal(12)
    vectors = [(k, [float(v) for v in x[k]], int(k % 2)) for k in range(260)]
    vectors += [(900, None, 1), (901, [], 1), (902, [0.0] * 12, 1), (903, [float("nan")] * 12, 1), (904, [1.0] * 11 + [None], 1), (905, vectors[0][1], None), (920, [2.0, 1.0], 0), (921, [4.0, 2.0], 0)]
    spark.createDataFrame(vectors, VECTORS).repartition(3).withColumns(extra).write.parquet(f"{path}/embeddings.parquet")
    pages = [(k, f"http://h{k % 5}.org/{k}", rng.choice(["same", None, "", f"<p>{k}</p>", "ü" * (k % 9)])) for k in range(200)] + [(500, None, "same"), (501, "", "z" * 200_000)]
    spark.createDataFrame(pages, PAGES).repartition(3).withColumns(extra).write.parquet(f"{path}/pages.parquet")
    return path


@pytest.fixture(scope="module")
def con(folder):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "pages"):
        con.execute(f"create view {table} as select * from '{folder}/{table}.parquet/*.parquet'")
    return con


def _documents(con):
    return {d: (t, s) for d, t, s in con.execute("select doc_id, text, source from documents").fetchall()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_equal_their_sql(spark, folder, con, name):
    result = compare(queries.QUERIES[name](spark, folder).toPandas(), con.execute(queries.ORACLE_SQL[name]).df())
    assert result["ok"], result


def test_op1_pieces_and_places(spark, folder, con):
    coder = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = set()
    for doc, (text, _) in _documents(con).items():
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, 1]
        for k in range(0, len(ids), 4096):
            part = ids[k:k + 4096]
            want.add((doc, k // 4096, k, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = queries.op1_best_fit_packing(spark, folder).collect()
    assert len(got) == len(want) and {(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got} == want
    places = defaultdict(list)
    for r in got:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        ends = 0
        for offset, length in sorted(own):
            assert offset == ends
            ends += length
        assert ends <= 4096
    assert len(places) <= math.ceil(sum(w[3] for w in want) / 4096) + 1


def test_op3_scores_every_document(spark, folder, con):
    got = {r.doc_id: r for r in queries.op3_quality_classifier(spark, folder).collect()}
    assert got.keys() == _documents(con).keys()
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)


def test_op4_sizes_targets_and_takes(spark, folder, con):
    docs = _documents(con)
    sizes = {d: len(WORD.findall(t or "")) for d, (t, _) in docs.items()}
    per = Counter()
    for d, (_, s) in docs.items():
        per[s] += sizes[d]
    names = sorted(s for s in per if s is not None) + [None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(names)}
    target, free, total = {}, set(names), 1.5 * sum(per.values())
    while free:
        rate = (total - sum(target.values())) / sum(weight[s] for s in free)
        full = {s for s in free if rate * weight[s] >= 2 * per[s]}
        target |= {s: 2 * per[s] for s in full} if full else {s: rate * weight[s] for s in free}
        free = free - full if full else set()
    got = {r.doc_id: r for r in queries.op4_source_mixing(spark, folder).collect()}
    assert got.keys() == docs.keys()
    taken = Counter()
    for d, r in got.items():
        s = docs[d][1]
        assert (r.size, r.source_size) == (sizes[d], per[s]) and math.isclose(r.target, target[s]) and 0 <= r.taken <= 2 * r.size
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) < 1 for s in names)


def test_op8_equals_a_full_search(spark, folder, con):
    vectors = {i: np.array(v, np.float64) for i, v in con.execute("select vec_id, embedding from embeddings where len(embedding) > 0").fetchall()
               if None not in v and np.isfinite(v).all() and np.any(v)}
    got = defaultdict(list)
    for r in sorted(queries.op8_nearest_neighbours(spark, folder).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    queried = [i for i in vectors if i % 20 == 0]
    assert sorted(got) == sorted(queried)
    for q in queried:
        near = sorted(((-float(np.einsum("i,i->", v, vectors[q])), i) for i, v in vectors.items() if i != q and len(v) == len(vectors[q])))[:20]
        assert [i for i, _ in got[q]] == [i for _, i in near] and np.allclose([s for _, s in got[q]], [-s for s, _ in near], rtol=0, atol=1e-12)


def test_op10_languages(spark, folder, con):
    got = {r.doc_id: r for r in queries.op10_language_id(spark, folder).collect()}
    docs = dict(con.execute("select doc_id, text from documents").fetchall())
    truth = dict(con.execute("select doc_id, lang from documents").fetchall())
    assert got.keys() == docs.keys()
    for d, r in got.items():
        letters = any(c.isalpha() for c in docs[d] or "")
        assert r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) and 0 <= r.score <= 1
        assert (r.lang_pred == "und") == (not letters) and r.lang_pred in {"en", "de", "und"}
    known = [d for d in docs if truth[d]]
    assert sum(got[d].lang_pred == truth[d] for d in known) >= 0.95 * len(known)


def test_all_queries_are_registered():
    assert sorted(queries.QUERIES) == sorted(f for f in dir(queries) if re.match(r"op\d+_", f)) and len(queries.QUERIES) == 13
