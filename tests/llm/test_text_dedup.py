"""MinHash near-dedup and suffix-array dedup against brute force."""
import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadflow.llm.minhash import BLOCK, common_counts, fewest_matches, near_duplicates
from roadflow.llm.suffix import common_prefixes, doc_key, repeats, suffix_array, without_repeats

WORD = re.compile(r"[^\x20\x09-\x0D]+")
VOCAB = "alpha beta gamma delta eps zeta eta theta iota kappa lam mu nu xi omi pi rho sig tau ups".split()


def corpus(seed=4):
    rng = random.Random(seed)
    base = [" ".join(rng.choice(VOCAB) + str(rng.randint(0, 30)) for _ in range(rng.randint(20, 120))) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(base)]
    for k in range(120):  # copies and near copies
        words = rng.choice(base).split()
        for _ in range(rng.choice([0, 0, 1, 2, 4, 9])):
            words[rng.randrange(len(words))] = rng.choice(VOCAB)
        rows.append((100 + k, " ".join(words)))
    rows += [(300, None), (301, ""), (302, " \t\n"), (303, "one"), (304, "ONE"), (305, "two words"), (306, "Two\nWords"), (307, "ä " * 300), (308, "Ä " * 300),
             (309, base[0].upper()), (310, "x" * 5000), (311, "long " * 6000), (0, base[0])]
    return rows


def shingle_sets(rows, n):
    out = {}
    for d, x in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in x or ""))
        out[d] = {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    return out


def classes(sets, percent):
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[i + 1:]:
            c = len(sets[a] & sets[b])
            if c and 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {d: find(d) for d in ids}


@pytest.mark.parametrize("n,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(make_docs, n, percent):
    rows = corpus()
    docs = make_docs(rows).withColumn("id", F.lit(7)).withColumn("class", F.lit("x")).withColumn("key", F.lit(1))
    out = near_duplicates(docs, n=n, threshold=percent / 100).collect()
    sets = shingle_sets(rows, n)
    want = classes(sets, percent)
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_shingles, r.component_id, r.kept) == (len(sets[r.doc_id]), want[r.doc_id], want[r.doc_id] == r.doc_id), r.doc_id


def test_texts_under_one_id_are_documents_of_their_own(spark, make_docs):
    from corpus_pipeline import near_dedup

    rng = random.Random(6)
    text = [" ".join(rng.choice(VOCAB) + str(rng.randint(0, 30)) for _ in range(60)) for _ in range(6)]
    near = [t + " end" for t in text]
    # under 5: a copy of 1's text, and two texts that lead groups of their own; the near copies of both are under larger ids
    rows = [(1, text[0]), (5, text[0]), (5, text[1]), (5, text[2]), (8, near[1]), (9, near[2]), (6, text[3]), (6, near[3]), (6, near[3]), (7, None), (7, text[4]), (None, text[5])]
    got = [(r.doc_id, r.component_id, r.kept) for r in near_duplicates(make_docs(rows)).collect()]
    assert sorted(x for x in got if x[0] in (1, 5, 8, 9)) == [(1, 1, True), (5, 1, False), (5, 5, True), (5, 5, True), (8, 5, False), (9, 5, False)]
    kept = near_dedup(spark, make_docs(rows), "")
    assert kept.columns == make_docs(rows).columns
    kept = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(kept) == len(set(kept)) == 7
    assert {(1, text[0]), (5, text[1]), (5, text[2]), (7, None), (7, text[4]), (None, text[5])} < set(kept)
    assert sum(x[0] == 6 for x in kept) == 1


def test_a_group_larger_than_a_block(make_docs, monkeypatch):
    monkeypatch.setattr("roadflow.llm.minhash.BLOCK", 16)
    rng = random.Random(9)
    base = [rng.choice(VOCAB) + str(i) for i in range(60)]
    rows = []
    for k in range(90):
        w = list(base)
        for _ in range(rng.randint(0, 4)):
            w[rng.randrange(60)] = f"n{rng.randint(0, 9)}"
        rows.append((k, " ".join(w)))
    got = {r.doc_id: r.component_id for r in near_duplicates(make_docs(rows), n=3, threshold=0.85).collect()}
    assert got == classes(shingle_sets(rows, 3), 85) and BLOCK == 512


def test_near_duplicates_of_an_empty_table_and_null_ids(make_docs):
    assert near_duplicates(make_docs([])).collect() == []
    out = near_duplicates(make_docs([(None, "a b c d e f"), (3, "a b c d e f"), (None, None)])).collect()
    assert len(out) == 3 and len({r.component_id for r in out}) == 2


def test_intersections_as_products_equal_sets():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(12)]
    a, b = np.nonzero(np.ones((12, 12), bool))
    got = common_counts(sets, sets, a, b)
    assert got.tolist() == [len(set(sets[x].tolist()) & set(sets[y].tolist())) for x, y in zip(a, b)]
    assert common_counts(sets, sets, a[:3], b[:3]).tolist() == got[:3].tolist()


def test_sequential_bounds_keep_similar_pairs():
    for k, m in enumerate(fewest_matches(0.85), 1):
        assert m <= 0.85 * 16 * k


def test_suffix_array_and_prefixes_by_definition():
    rng = random.Random(1)
    for _ in range(150):
        t = np.array([rng.choice([0, 1, 1, 2, 2, 3]) for _ in range(rng.randint(0, 60))] + [0], np.uint8)
        strings = [bytes(t[i:])[:bytes(t[i:]).index(0)] for i in range(len(t))]
        order = suffix_array(t, 100)
        assert sorted(order.tolist()) == list(range(len(t)))
        assert [strings[i] for i in order] == sorted(strings)
        prefix = common_prefixes(t, order, 100)
        for j in range(1, len(order)):
            a, b, k = strings[order[j]], strings[order[j - 1]], 0
            while k < min(len(a), len(b)) and a[k] == b[k]:
                k += 1
            assert prefix[j] == k


def cut_by_definition(rows, length):
    seen, out = set(), {}
    for d, x in sorted(rows, key=lambda r: r[0]):
        raw = (x or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            if raw[i:i + length] in seen:
                gone[i:i + length] = b"\1" * length
            seen.add(raw[i:i + length])
        out[d] = (bytes(c for c, g in zip(raw, gone) if not g), sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1])))
    return out


@pytest.mark.parametrize("hot", [2000, 3])
def test_repeats_equal_the_definition(make_docs, hot):
    rng = random.Random(6)
    rows = [r for r in corpus(8) if r[0] not in (0, 311)] + [(0, corpus(8)[0][1])]
    rows += [(400 + k, "head %d " % k + "a passage shared by many, ä ö ü ß " * 4 + str(rng.random())) for k in range(40)]
    rows += [(500, "q" * 400), (501, "ab" * 300), (502, "\0" * 150 + "\x01" * 150)]
    docs = make_docs(rows).withColumn("doc", F.lit(1)).withColumn("spans", F.lit(2)).withColumn("anchor", F.lit(3))
    want = cut_by_definition(rows, 100)
    keys = {r.k: r.doc_id for r in docs.select(doc_key().alias("k"), "doc_id").collect()}
    got = {keys[r.doc]: (r.kept, len(r.spans)) for r in repeats(docs, hot=hot).collect()}
    for d, (kept, spans) in want.items():
        k, n = got.get(d, (None, 0))
        assert n == spans and (k is None or bytes(k) == kept), d
    if hot == 2000:
        out = without_repeats(docs)
        assert out.columns == docs.columns
        for r in out.collect():
            assert (r.text or "") == want[r.doc_id][0].decode(errors="ignore")
            assert r.n_chars == (None if r.text is None else len(r.text))


def test_repeats_of_repeated_rows_null_ids_and_an_empty_table(make_docs):
    assert repeats(make_docs([])).collect() == []
    t = hashlib.sha512(b"x").hexdigest()
    docs = make_docs([(1, t), (1, t), (2, t), (None, t), (None, None), (3, "short")])
    got = {(r.doc_id, r.text) for r in without_repeats(docs).collect()}
    assert got == {(1, t), (2, ""), (None, ""), (None, None), (3, "short")}


def test_wanted_suffixes_keep_their_order():
    rng = np.random.default_rng(5)
    for letters in (1, 2, 4):
        t = rng.integers(1, 1 + letters, 400).astype(np.uint8)
        t[[90, 91, 250, 399]] = 0
        wanted = (rng.random(400) < 0.3) & (t != 0)
        some, every = suffix_array(t, 100, wanted), suffix_array(t, 100)
        assert some[wanted[some]].tolist() == every[wanted[every]].tolist()
