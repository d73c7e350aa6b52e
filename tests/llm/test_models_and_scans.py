"""Quality classifier, language ID, license scan, pipeline."""
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from roadflow.llm.langid import label_spans, learn, viterbi
from roadflow.llm.licenses import MARKS, NOTICES, WORDINGS, band_probability, full_texts, license_of, notices, scan, templates
from roadflow.llm.quality import FEATURES, RANK, fit, good_documents, raw_scores, score, train

LANGS = {"en": "the of and thing house water there with from which", "de": "der die und wasser haus nicht schon mit durch straße", "el": "και το σπίτι νερό δεν με από", "fr": "le la les des maison où très été eau avec"}


def sentences(seed=1, n=300):
    rng = random.Random(seed)
    return [(i, " ".join(rng.choice(LANGS[lang].split()) for _ in range(rng.randint(5, 40))), lang) for i in range(n) for lang in [rng.choice(list(LANGS))]]


def test_language_of_held_out_texts_and_spans(make_docs):
    rows = sentences() + [(900, None, "en"), (901, "", "en"), (902, "12 !? 3", "de"), (903, "the house " * 8 + "και το σπίτι " * 8, None), (904, "the water " * 20 + "nicht straße durch " * 20, None),
                          (905, "日本語", None), (None, "the house", "de"), (906, "the " * 30_000, None)]
    docs = make_docs(rows).withColumn("score", F.lit(1)).withColumn("spans", F.lit(2))
    model = learn(docs)
    assert model["langs"] == sorted(LANGS)
    got = {r.doc_id: r for r in label_spans(docs, model, "doc_id").collect()}
    held = [r for r in rows[:300] if zlib.crc32(str(r[0]).encode()) % 5 == 0]
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.97 * len(held)
    for i in (900, 901, 902):
        assert (got[i].lang_pred, got[i].score, got[i].spans) == ("und", 0.0, [])
    assert [s.lang for s in got[903].spans] == ["en", "el"] and [s.lang for s in got[904].spans] == ["en", "de"]
    text = rows[[r[0] for r in rows].index(904)][1]
    assert text[got[904].spans[1].start:got[904].spans[1].stop].startswith("nicht")
    assert got[905].lang_pred in LANGS and got[906].lang_pred == "en"
    assert got[904].score == pytest.approx(16 * 20 / (16 * 20 + 8 * 20))  # letters


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(3)
    import itertools
    for _ in range(20):
        sizes = rng.integers(0, 6, 5)
        rows = np.repeat(np.arange(5), sizes)
        s = rng.normal(size=(len(rows), 3)) * 3
        got = viterbi(s, rows, 5, 2.0)
        for r in range(5):
            at = np.flatnonzero(rows == r)
            if len(at):
                cost = lambda p: sum(s[i, c] for i, c in zip(at, p)) - 2.0 * sum(a != b for a, b in zip(p, p[1:]))
                best = max(cost(p) for p in itertools.product(range(3), repeat=len(at)))
                assert abs(cost(got[at].tolist()) - best) < 1e-6


def test_languages_of_an_empty_table(make_docs):
    model = learn(make_docs([]))
    assert model["langs"] == [] and label_spans(make_docs([]), model, "doc_id").collect() == []
    assert label_spans(make_docs([(1, "abc")]), model, "doc_id").first().lang_pred == "und"


def quality_rows(n=600):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(n):
        words = [rng.choice(LANGS["en"].split()) + rng.choice("aeiou") for _ in range(rng.randint(10, 80))]
        good = rng.random() < 0.7
        rows.append((i, " ".join(words) + "." if good else " ".join(w + rng.choice(["$$$", "###", "&&&"]) for w in words).upper()))
        labels.append((i, int(good)))
    return rows, labels


def test_quality_of_held_out_texts(spark, make_docs):
    rows, labels = quality_rows()
    rows += [(1000, None), (1001, ""), (None, "the house"), (3, rows[3][1]), (1002, "word " * 50_000)]
    docs = make_docs(rows).withColumn("score", F.lit(9)).withColumn("y", F.lit(1))
    table = spark.createDataFrame(labels + [(2000, None)], "doc_id long, quality int")
    out = score(docs, fit(docs, table), "doc_id").collect()
    got, truth = {r.doc_id: r.score for r in out}, dict(labels)
    assert len(out) == len(rows) and all(0 <= r.score <= 1 for r in out)
    held = [i for i in truth if zlib.crc32(str(i).encode()) % 5 == 0]
    assert all((got[i] >= 0.3) == bool(truth[i]) for i in held)
    kept = good_documents(docs, table)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} >= {i for i in held if truth[i]}


def test_quality_without_labels_or_rows(spark, make_docs):
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert score(make_docs([]), fit(make_docs([]), none), "doc_id").collect() == []
    assert score(make_docs([(1, "a b")]), fit(make_docs([(1, "a b")]), none), "doc_id").first().score == pytest.approx(0.5, abs=0.01)


def test_pairwise_part_equals_the_double_sum():
    rng = np.random.default_rng(0)
    model = {"bias": 0.3, "w": rng.normal(size=FEATURES), "v": rng.normal(size=(FEATURES, RANK))}
    rows, index, x = np.array([0, 0, 0, 1, 1]), np.array([5, 9, 7, 1, 9]), rng.normal(size=5)
    got, _ = raw_scores(model, rows, index, x, 2)
    for r in range(2):
        at = np.flatnonzero(rows == r)
        want = 0.3 + sum(model["w"][index[i]] * x[i] for i in at)
        want += sum(model["v"][index[i]] @ model["v"][index[j]] * x[i] * x[j] for k, i in enumerate(at) for j in at[k + 1:])
        assert abs(got[r] - want) < 1e-9
    assert train(np.zeros(0, int), np.zeros(0, int), np.zeros(0), np.zeros(0))["bias"] == 0


def shingled(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return [tuple(w[i:i + n]) for i in range(len(w) - n + 1)] if len(w) >= n else ([tuple(w)] if w else [])


def test_licenses_equal_brute_force(spark, make_docs):
    rng = random.Random(8)
    names = list(NOTICES)
    rows = []
    for i in range(150):
        filler = [rng.choice(LANGS["en"].split()) for _ in range(rng.randint(0, 50))]
        if rng.random() < 0.6:
            notice = NOTICES[rng.choice(names)].split()
            for _ in range(rng.choice([0, 0, 1, 2])):
                notice[rng.randrange(len(notice))] = "changed"
            k = rng.randint(0, len(filler))
            filler[k:k] = notice
        rows.append((i, rng.choice(["\n", " ", "\t "]).join(filler)))
    rows += [(500, None), (501, ""), (502, "Released"), (503, ("the " * 3000) + NOTICES["MIT"] + " of" * 3000), (504, NOTICES["GPL-3.0"].upper()), (505, f"{NOTICES['MIT']} {NOTICES['MIT']}")]
    docs = make_docs(rows).withColumn("w", F.lit(1)).withColumn("span", F.lit(2)).withColumn("template", F.lit(3))
    templates = notices(spark).union(spark.createDataFrame([("none", None), ("short", "all rights")], "template_id string, text string"))
    got = {(r.doc_id, r.template_id): r for r in scan(docs, templates).collect()}
    want = {}
    for d, t in rows:
        s = shingled(t)
        for k, v in {**NOTICES, "short": "all rights"}.items():
            ts = set(shingled(v))
            size = 1
            while size < len(shingled(v)):
                size *= 2
            stride = max(1, size // 4) if size >= 32 else 1
            starts = {min(x, max(0, len(s) - size)) for x in range(0, max(1, len(s)), stride)}
            shares = [len(ts & set(s[a:a + size])) / len(ts) for a in starts] if s else []
            if shares and max(shares) >= 0.8:
                want[(d, k)] = (max(shares), sum(x >= 0.8 for x in shares))
    assert {k: (r.containment, r.n_windows) for k, r in got.items()} == want


def test_licenses_are_found_at_every_start(spark, make_docs):
    rng = random.Random(12)
    rows = []
    for i in range(200):
        notice = NOTICES[rng.choice(["MIT-text", "MIT-text", "BSD", "MIT"])].split()
        for _ in range(rng.choice([0, 1, 2, 2])):
            notice[rng.randrange(len(notice))] = "changed"
        rows.append((i, " ".join([f"a{k}" for k in range(rng.randint(0, 150))] + notice * rng.choice([1, 1, 2]) + [f"b{k}" for k in range(rng.randint(0, 150))])))
    rows += [(500, None), (501, ""), (502, "Released"), (503, "all rights"), (7, rows[7][1]), (8, rows[9][1])]
    templates = notices(spark).union(spark.createDataFrame([("none", None), ("short", "all rights")], "template_id string, text string"))
    got = {(r.doc_id, r.template_id): (r.containment, r.n_windows, r.first_word, r.last_word) for r in scan(make_docs(rows), templates, every_start=True).collect()}
    want = {}
    for d, t in dict.fromkeys(rows):
        s, words = shingled(t), len((t or "").split())
        for k, v in {**NOTICES, "short": "all rights"}.items():
            ts, size = set(shingled(v)), 1
            while size < len(shingled(v)):
                size *= 2
            shares = [(len(ts & set(s[a:a + size])) / len(ts), a, min(words, a + len(s[a:a + size]) + 4)) for a in range(max(1, len(s) - size + 1))] if s else []
            held = [x for x in shares if x[0] >= 0.8]
            if held:
                more = want.get((d, k), (0, 0, 10 ** 9, 0))
                want[(d, k)] = (max(more[0], max(held)[0]), more[1] + len(held), min(more[2], held[0][1]), max(more[3], held[-1][2]))
    assert got == want
    strided = {(r.doc_id, r.template_id) for r in scan(make_docs(rows), templates).collect()}
    assert strided < set(got)


def test_headers_full_texts_and_other_punctuation_are_found(spark, make_docs):
    header = '# Licensed under the Apache License, Version 2.0 (the "License");\n# you may not use this file except in compliance with the License.'
    gpl, filler = full_texts()["GPL-2.0-text"], " ".join(f"w{i}" for i in range(300))
    rows = [(1, f"{filler}\n{header}\nimport os"), (2, "code released under the MIT License, by us"), (3, f"{filler} {gpl} {filler}"), (4, filler + " -----" * 500 + "-" * 20_000), (5, None), (6, "...")]
    got = {(r.doc_id, r.template_id): r.containment for r in scan(make_docs(rows), templates(spark), every_start=True, bare=True).collect()}
    assert got[(1, "Apache-2.0")] == got[(2, "MIT")] == got[(3, "GPL-2.0-text")] == 1.0
    assert {d for d, _ in got} == {1, 2, 3} and (3, "GPL-3.0-text") not in got


def test_every_template_reports_its_own_license_only(spark, make_docs):
    """Headers and texts of related licenses hold most of each other; only a text that contains another as a whole reports both."""
    rows = [(r.template_id, r.license, r.text) for r in templates(spark).collect()]
    # a template of fewer than five words is found where it is the whole text
    docs = make_docs([(k, f"{'x' * 9} before {t} after it" if len(t.split()) >= 5 else t) for k, (_, _, t) in enumerate(rows)])
    got = {}
    for r in scan(docs, templates(spark), every_start=True, bare=True).collect():
        got.setdefault(r.doc_id, set()).add((r.template_id, r.license))
    bare = lambda x: [w for w in (y.strip(MARKS) for y in x.lower().split()) if w]

    def parts(text):
        w = bare(text)
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    sets = [parts(t) for _, _, t in rows]
    for k, (name, license, _) in enumerate(rows):
        assert (name, license) in got[k], name
        for other, its in got[k]:
            o = next(i for i, r in enumerate(rows) if r[0] == other)
            assert its == license or sets[o] <= sets[k] or not sets[k] - sets[o], (name, other)
    assert license_of("AGPL-3.0#0") == "AGPL-3.0" and license_of("GPL-2.0-text") == "GPL-2.0"


def test_edited_headers_keep_their_license(spark, make_docs):
    agpl, gpl3, gpl2 = (next(t for t in WORDINGS[k] if t.startswith("This program is free")) for k in ("AGPL-3.0", "GPL-3.0", "GPL-2.0"))
    rows = [(1, agpl), (2, gpl3), (3, gpl2), (4, f"{agpl} -- and elsewhere -- {gpl3}"), (5, agpl.replace("redistribute", "share")), (6, gpl2.replace("hope", "x"))]
    got = {}
    for r in scan(make_docs(rows), templates(spark), every_start=True, bare=True).collect():
        got.setdefault(r.doc_id, set()).add(r.license)
    assert got == {1: {"AGPL-3.0"}, 2: {"GPL-3.0"}, 3: {"GPL-2.0"}, 4: {"AGPL-3.0", "GPL-3.0"}, 5: {"AGPL-3.0"}, 6: {"GPL-2.0"}}


def test_license_texts_in_a_zipped_package(tmp_path):
    import pathlib
    import subprocess
    import sys
    import zipfile

    import roadflow

    root = pathlib.Path(roadflow.__file__).parent
    with zipfile.ZipFile(tmp_path / "lib.zip", "w") as z:
        for f in root.rglob("*"):
            if f.is_file() and "__pycache__" not in f.parts:
                z.write(f, f.relative_to(root.parent))
    code = "import sys; sys.path.insert(0, sys.argv[1]); from roadflow.llm.licenses import full_texts; print(len(full_texts()))"
    out = subprocess.run([sys.executable, "-c", code, str(tmp_path / "lib.zip")], capture_output=True, text=True, cwd=tmp_path, check=True)
    assert int(out.stdout) == len(full_texts()) >= 14


def test_license_bands_and_empty_tables(spark, make_docs):
    assert band_probability(0.28) > 0.9999
    assert scan(make_docs([]), notices(spark)).collect() == []
    assert scan(make_docs([(1, NOTICES["MIT"])]), notices(spark).limit(0)).collect() == []


def test_pipeline_stages_in_turn(spark, make_docs, tmp_path):
    import corpus_pipeline

    rows, labels = quality_rows(200)
    rows = [(i, t, "en", f"s{i % 3}") for i, t in rows] + [(800 + i, rows[k][1], "en", "s1") for i, k in enumerate(range(0, 40, 4))] + [(900, None, None, None), (901, "", None, "s1")]
    path = str(tmp_path)
    make_docs(rows).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    docs, counts = spark.read.parquet(f"{path}/documents.parquet"), []
    truth = dict(labels)
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, path)
        if k < 4:
            assert out.columns == docs.columns, name
        out.write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
        counts.append({r.doc_id for r in docs.collect()})
        if name == "near_dedup":
            assert not counts[1] & set(range(800, 810))
    assert {i for i in truth if not truth[i]}.isdisjoint(counts[0]) and {i for i in truth if truth[i]} <= counts[0]
    used = {}
    for r in docs.collect():
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
