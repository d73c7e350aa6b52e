import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from roadflow.llm.mixing import first_words, mix, mixed_documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fill(sizes, weights=(3.0, 1.0, 2.0), share=1.5, most=2.0):
    """Plain resharing over a dict source -> size."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    total, target, free = share * sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(target.values())
        rate = left / sum(w[s] for s in free)
        full = [s for s in free if w[s] * rate >= most * sizes[s]]
        if not full:
            target |= {s: w[s] * rate for s in free}
            break
        for s in full:
            target[s] = most * sizes[s]
            free.discard(s)
    return target


def rows_of(seed=1):
    rng = random.Random(seed)
    rows = [(i, " ".join(rng.choice("ab cd efg ü 日本".split()) for _ in range(rng.randint(0, 60))), "en",
             rng.choice(["s1", "s10", "s2", "Z", "é", None] + ["s1"] * 4)) for i in range(400)]
    rows += [(900, None, None, "s2"), (901, "", None, "s2"), (902, " \t\n\v\f\r ", None, "empty"), (903, "w " * 4000, None, "s1"),
             (5, rows[5][1], "en", rows[5][3]), (None, "a b c", None, None), (None, "x y", None, "s1")]
    return rows


def test_targets_and_budgets(make_docs):
    rows = rows_of()
    out = mix(make_docs(rows)).collect()
    assert len(out) == len(rows)
    sizes, taken = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r[3]] += len(WORD.findall(r[1] or ""))
    target = fill(sizes)
    for r in out:
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 2 * r.size and r.source_size == sizes[r.source]
        assert abs(r.target - target[r.source]) < 1e-6 * max(1, target[r.source])
    for s in sizes:
        assert abs(taken[s] - target[s]) < 1
    assert sorted((r.doc_id or -1, r.size) for r in out) == sorted((r[0] or -1 if r[0] != 0 else 0, len(WORD.findall(r[1] or ""))) if r[0] else (-1, len(WORD.findall(r[1] or ""))) for r in rows)


def test_fractional_pass_is_a_prefix_of_the_keys(make_docs):
    rows = [(i, "w " * (1 + i % 7), None, "ab"[i % 2]) for i in range(500)]
    out = mix(make_docs(rows), quality=F.lit(1.0)).collect()
    for s in "ab":
        part = [r for r in out if r.source == s]
        border = [r for r in part if 0 < r.part < r.size]
        assert len(border) <= 1
        left = sum(r.part for r in part)
        assert left == int(part[0].target) - part[0].epochs * part[0].source_size


def test_reruns_and_partitions_agree(make_docs):
    a = {(r.doc_id, r.row_hash): r.taken for r in mix(make_docs(rows_of(), 2)).collect()}
    b = {(r.doc_id, r.row_hash): r.taken for r in mix(make_docs(rows_of(), 7)).collect()}
    assert a == b


@pytest.mark.parametrize("weight", [None, 0.01])
def test_borders_are_cut_until_they_fit(make_docs, weight):
    """Low weights put all keys into the last bucket; cutting it again and again changes no row's take."""
    docs = make_docs(rows_of())
    quality = F.lit(weight) if weight else None
    a = sorted(map(tuple, mix(docs, quality=quality).collect()), key=str)
    for border in (1, 10):
        assert sorted(map(tuple, mix(docs, quality=quality, border_rows=border).collect()), key=str) == a


def test_repeated_rows_come_as_often_as_they_are_taken(make_docs):
    rows = [(1, "a b c", "en", "s")] * 7 + [(2, "d e", "en", "s"), (2, "d e", "en", "s"), (3, "f", "en", "s"), (4, "g h i j", "en", "t")]
    for share in (0.4, 0.9, 1.5):
        docs = make_docs(rows)
        want = sum(r.taken for r in mix(docs, share=share).collect())
        assert sum(len(r.text.split()) for r in mixed_documents(docs, share=share).collect()) == want > 0


def test_quality_weight_prefers_good_documents(make_docs):
    rows = [(i, ("w " if i % 2 else "# ") * 10, None, "big") for i in range(2000)] + [(9000 + i, "w " * 10, None, "a") for i in range(2000)]
    out = [r for r in mix(make_docs(rows), share=0.6).collect() if r.source == "big"]
    good = sum(r.taken for r in out if r.weight > 0.9)
    bad = sum(r.taken for r in out if r.weight < 0.9)
    assert good > 1.5 * bad


def test_empty_table(make_docs):
    assert mix(make_docs([])).collect() == []
    assert mixed_documents(make_docs([])).collect() == []


def test_all_null_sources_and_extra_columns(make_docs):
    docs = make_docs([(1, "a b", None, None), (2, "c", None, None)]).withColumn("size", F.lit("x")).withColumn("key", F.lit(1)).withColumn("part", F.lit(2))
    assert sum(r.taken for r in mix(docs).collect()) == 4
    out = mixed_documents(docs)
    assert out.columns == docs.columns and sum(len(r.text.split()) for r in out.collect()) == 4


def test_mixed_documents_hold_the_taken_words(make_docs):
    docs = make_docs(rows_of(3))
    want = sum(r.taken for r in mix(docs.dropDuplicates(["doc_id", "text"])).collect())
    got = sum(len(WORD.findall(r.text or "")) for r in mixed_documents(docs.dropDuplicates(["doc_id", "text"])).collect())
    assert got == want


def test_first_words(spark):
    df = spark.createDataFrame([(" a\tb\n\nc d ", 3), ("x", 1)], "t string, n int")
    assert [r[0] for r in df.select(first_words(F.col("t"), F.col("n"))).collect()] == ["a b c", "x"]
