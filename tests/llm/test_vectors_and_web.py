"""Embeddings and WARC against brute force."""
import base64
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F, types as T

from roadflow.llm.ann import Scan, calibrate, nearest, rotation
from roadflow.llm.vecdedup import linked
from roadflow.llm.vectors import spherical_kmeans, unit
from roadflow.llm.warc import lookup, parse, read_all, record, reversed_host_key, spans_of, write_archive

VECTORS = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())), T.StructField("label", T.IntegerType())])
BAD = [(9000, None, 1), (9001, [], 1), (9002, [0.0] * 8, 1), (9003, [float("nan")] * 8, 1), (9004, [float("inf")] + [1.0] * 7, 1), (9005, [1.0, None] + [1.0] * 6, 1), (9006, [1.0] * 8, None),
       (9007, [1.0, 2.0], 1), (9008, [2.0, 4.0], 1)]


def table(n=700, seed=3):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, 8)).astype(np.float32)
    for k in range(n // 3, n):  # copies and near copies
        x[k] = x[rng.integers(0, 20)] + rng.choice([0, 0.02, 0.1, 0.3]) * rng.standard_normal(8)
    return [(i, [float(v) for v in x[i]], int(rng.integers(0, 3))) for i in range(n)] + [(n, [float(v) for v in x[0]], 0), (n + 1, [float(3 * v) for v in x[0]], 0)]


@pytest.mark.parametrize("per_cell,block", [(20_000, 512), (60, 32)])
def test_links_equal_brute_force(spark, per_cell, block):
    rows = table()
    df = spark.createDataFrame(rows + BAD, VECTORS).repartition(4).withColumn("n", F.lit("x")).withColumn("id", F.lit(0)).withColumn("cell", F.lit(1))
    got = {r.vec_id: r for r in linked(df, per_cell=per_cell, block=block).collect()}
    x, lab = unit(np.array([r[1] for r in rows], np.float64)), np.array([r[2] for r in rows])
    link = (x @ x.T >= 0.98) & (lab[:, None] == lab[None, :])
    np.fill_diagonal(link, False)
    root = np.arange(len(rows))
    while True:
        new = np.array([min(root[i], root[link[i]].min() if link[i].any() else root[i]) for i in range(len(rows))])
        if (new == root).all():
            break
        root = new
    for i, r in enumerate(rows):
        assert (got[r[0]].n_links, got[r[0]].component_id, got[r[0]].kept) == (link[i].sum(), root[i], root[i] == i)
    for r in BAD[:7]:
        assert (got[r[0]].n_links, got[r[0]].component_id) == (0, r[0])
    assert got[9007].n_links == got[9008].n_links == 1 and got[9008].component_id == 9007


def test_linked_empty_table_repeated_rows_null_ids(spark):
    assert linked(spark.createDataFrame([], VECTORS)).collect() == []
    out = linked(spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [0.0, 1.0], 1)], VECTORS)).collect()
    assert sorted((r.vec_id, r.n_links) for r in out) == [(-1, 0), (1, 1), (1, 1)]


@pytest.mark.parametrize("per_list", [4000, 100])
def test_nearest_recall_and_scores(spark, per_list):
    rows = table(900, 5)
    df = spark.createDataFrame(rows + [b for b in BAD if b[0] != 9006] + [rows[0]], VECTORS).repartition(4).withColumn("id", F.lit(0)).withColumn("list", F.lit(1))
    out = nearest(df, F.col("vec_id") % 20 == 0, per_list=per_list).collect()
    x = np.array([r[1] for r in rows], np.float32).astype(np.float64)
    hit = total = 0
    for q in range(0, len(rows), 20):
        mine = sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 21)) and q not in {r.vec_id for r in mine}
        score = np.einsum("ij,j->i", x, x[q])
        assert all(abs(r.score - score[r.vec_id]) < 1e-12 for r in mine)
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)
        order = [i for i in np.lexsort((np.arange(len(rows)), -score)) if i != q][:20]
        want = {round(float(score[i]), 9) for i in order}
        hit += len({round(r.score, 9) for r in mine} & want)
        total += len(want)
    assert hit >= 0.9 * total
    assert {r.query_id for r in out} == set(range(0, len(rows), 20))


def test_nearest_of_unequal_norms_over_several_lists(spark):
    rng = np.random.default_rng(7)
    x = (rng.standard_normal((60, 24))[rng.integers(0, 60, 6000)] + 0.5 * rng.standard_normal((6000, 24)))
    x = (x / np.linalg.norm(x, axis=1, keepdims=True) * rng.lognormal(0, 1.0, (6000, 1))).astype(np.float32).astype(np.float64)
    table = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(x)], VECTORS).repartition(4)
    out = nearest(table, F.col("vec_id") % 20 == 0, k=20, per_list=300).collect()
    hit = 0
    for q in range(0, 6000, 20):
        score = x @ x[q]
        score[q] = -np.inf
        hit += len({r.vec_id for r in out if r.query_id == q} & set(np.argsort(-score)[:20].tolist()))
    assert hit >= 0.95 * 20 * 300


def test_nearest_in_many_small_groups(spark):
    """Blocks of few queries, chunks of few rows, several lists: the same neighbours as in one group."""
    rng = np.random.default_rng(8)
    centre = rng.standard_normal((10, 16)) * 2
    x = (centre[rng.integers(0, 10, 1500)] + rng.standard_normal((1500, 16))).astype(np.float32)
    df = spark.createDataFrame([(k, [float(v) for v in x[k]], 0) for k in range(1500)] + [(20, [float(v) for v in x[20]], 0), (40, [1.0, 2.0], 0), (41, [2.0, 2.0], 0)], VECTORS).repartition(5)
    got = [sorted(map(tuple, nearest(df.where("vec_id != 40 OR size(embedding) = 2"), F.col("vec_id") % 20 == 0, k=5, per_list=150, **more).collect()))
           for more in ({}, {"query_block": 7, "row_chunk": 200})]
    assert [r[:3] for r in got[0]] == [r[:3] for r in got[1]]
    assert [r for r in got[0] if r[0] == 40] == [(40, 1, 41, 6.0)]
    score = x.astype(np.float64) @ x.astype(np.float64).T
    hit = 0
    for q in range(0, 1500, 20):
        want = [i for i in np.argsort(-score[q], kind="stable") if i not in (q, 40)][:5]
        hit += len({r[2] for r in got[0] if r[0] == q} & set(want))
    assert hit >= 0.9 * 5 * 74


def test_nearest_with_few_rows_and_none(spark):
    assert nearest(spark.createDataFrame([], VECTORS), F.col("vec_id") % 20 == 0).collect() == []
    out = nearest(spark.createDataFrame([(0, [1.0, 0.0], 1), (1, [0.5, 0.5], 1), (2, [1.0, 0.0], 1), (20, [0.0, 1.0], 2)], VECTORS), F.col("vec_id") % 20 == 0).collect()
    assert [(r.query_id, r.vec_id) for r in sorted(out, key=lambda r: (r.query_id, r["rank"]))] == [(0, 2), (0, 1), (0, 20), (20, 1), (20, 0), (20, 2)]


def test_adaptive_scan_finds_what_a_full_scan_finds():
    rng = np.random.default_rng(2)
    q, x = rng.standard_normal((30, 64)), rng.standard_normal((3000, 64))
    ids = np.arange(3000)
    a, b = (Scan(q, np.arange(5000, 5030), 10, turn) for turn in (rotation(64), None))
    for lo in range(0, 3000, 700):  # several lists, one after the other
        a.add(x[lo:lo + 700], ids[lo:lo + 700])
        b.add(x[lo:lo + 700], ids[lo:lo + 700])
    a, b = a.best(), b.best()
    truth = np.argsort(-(q @ x.T), axis=1, kind="stable")[:, :10]
    assert [b[1][b[0] == k].tolist() for k in range(30)] == truth.tolist()
    same = len(set(zip(a[0].tolist(), a[1].tolist())) & set(zip(b[0].tolist(), b[1].tolist())))
    assert same >= 0.99 * 300
    sample = unit(x)
    assert 1 <= calibrate(sample, spherical_kmeans(sample, 8), 10, 0.98) <= 8


PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()), T.StructField("html", T.StringType())])


def test_archive_round_trip(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, f"http://www.h{i % 7}.Example.com/p{i}?q=é", rng.choice(["<p>same</p>", "ü" * rng.randint(1, 50), f"<b>{i}</b>\r\n\r\nx"])) for i in range(300)]
    rows += [(1000, None, None), (1001, "", ""), (None, "http://n.org/", "<p>same</p>"), (1002, "not a url [", "z" * 300_000), (5, rows[5][1], rows[5][2]), (None, "http://m.org/", "only")]
    pages = spark.createDataFrame(rows, PAGES).repartition(5).withColumn("key", F.lit(1)).withColumn("digest", F.lit("x"))
    archive = write_archive(pages, f"file://{tmp_path}/warc", block=20, file_bytes=5000)
    got = read_all(archive).collect()
    best = {}
    for i, _, h in rows:
        best[h or ""] = max(best.get(h or "", -1), -1 if i is None else i)
    want = []
    for i, _, h in rows:
        raw = (h or "").encode()
        original = best[h or ""] if best[h or ""] >= 0 else None
        revisit = original is not None and i != original
        want.append((i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", original if revisit else None))
    key = lambda t: tuple((x is None, x if x is not None else 0) for x in t)
    assert sorted(((r.id, r.payload_bytes, r.payload_digest, r.type, r.refers_to) for r in got), key=key) == sorted(want, key=key)
    asked = [(rows[7][1],), (rows[150][1],), ("http://nowhere.example/",), (rows[7][1],), ("not a url [",)]
    found = lookup(archive, spark.createDataFrame(asked, "url string")).collect()
    assert sorted(r.id for r in found) == sorted(i for i, u, _ in rows if (u,) in asked)
    assert [r.payload for r in found if r.id == 1002] == [b"z" * 300_000]
    for batch in (pages, pages.limit(0)):
        want = sorted(str(r) for r in got) if batch is pages else []
        assert sorted(str(r) for r in lookup(archive, batch, payload=False).collect()) == want
    firsts = [r["first"] for r in archive.directory.orderBy("first").collect()]
    assert len(firsts) > 10


def test_small_payloads_are_all_responses_and_an_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/", "x"), (2, "http://b/", "x"), (3, "http://c/", "y" * 50), (4, "http://d/", "y" * 50)], PAGES)
    got = {r.id: r.type for r in read_all(write_archive(pages, f"file://{tmp_path}/a", least_bytes=10)).collect()}
    assert got == {1: "response", 2: "response", 3: "revisit", 4: "response"}
    assert read_all(write_archive(spark.createDataFrame([], PAGES), f"file://{tmp_path}/b")).collect() == []


def test_a_key_of_many_blocks_and_files(spark, tmp_path):
    """One url has most captures: its entries fill many blocks of several index files, and each is found once."""
    rows = [(i, "http://hot.org/", f"<p>{i}</p>") for i in range(600)] + [(1000 + i, f"http://{c}.org/{i}", "x") for i, c in enumerate("abcxyz" * 10)]
    archive = write_archive(spark.createDataFrame(rows, PAGES).repartition(6), f"file://{tmp_path}/hot", block=7)
    assert archive.directory.where("first = last").count() > 50
    assert sorted(r.id for r in lookup(archive, spark.createDataFrame([("http://hot.org/",), ("https://www.hot.org",)], "url string")).collect()) == list(range(600))
    assert sorted(r.id for r in lookup(archive, spark.createDataFrame(rows, PAGES)).collect()) == sorted(i for i, _, _ in rows)


def test_directory_search_is_exact():
    firsts, lasts = ["a", "c", "c", "f"], ["b", "c", "e", "k"]
    for key in "abcdefgkz":
        assert list(spans_of(firsts, lasts, key)) == [i for i in range(4) if firsts[i] <= key <= lasts[i]]


def test_keys_and_a_broken_record():
    assert reversed_host_key("https://www.Example.com:80/a?b#c") == "com,example,www:80)/a?b"
    assert reversed_host_key(None) == "-)/" and reversed_host_key("http://x.org") == "org,x)/"
    raw = record(1, "http://a/", b"hello", None, False, "2024-01-01T00:00:00Z")
    assert parse(raw)["payload"] == b"hello"
    with pytest.raises(ValueError):
        parse(raw.replace(b"hello", b"jello"))
