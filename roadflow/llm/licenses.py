"""License scan in DataFrame functions only: MinHash bands over overlapping windows retrieve templates.

A text's words (lower case, ``[^\\x20\\x09-\\x0D]+``) become hashes of ``n``-word shingles. Templates
fall in classes by their number of shingles (rounded up to a power of two). For each class, windows of that
many shingles start at every position (``stride`` 1) or at every quarter of a long window. A window's
``ROWS * BANDS`` min-hashes form ``BANDS`` band keys, which meet the templates' keys in a join; candidates are
verified by the exact share of the template's shingles that the window holds.

With ``every_start`` (the query's setting) strided windows are lengthened by a stride, so each window of the class lies in
one, and serve for retrieval only. Of each template retrieved in a text every start is verified: an occurrence of
a template shingle counts for the starts whose window has it first, an interval, and the running sum over the intervals'
ends is the exact number of distinct shingles in each window. Without it only strided windows are looked at, and a
passage whose best window starts between two strides can be lost.

A window can agree with a template in a min-hash only if it holds that very shingle. So windows are
formed only where some template shingle occurs: this drops no window that could share a band.

``band_probability`` gives the chance that a window with a given similarity is retrieved. A window of the class's
size that holds 0.8 of a template's shingles has similarity 0.8 / (2 - 0.8) = 0.67 if the class is the template's
size, 0.29 or more at the class's worst, also in lengthened windows (0.8 / (2.5 + 1 - 0.8) = 0.296); the default bands (1 row, 32 bands) retrieve it with 1 - (1 - s)^32,
over 0.99998.

Templates of different licenses can be nearly equal (the headers of GPL and AGPL differ in one word), so that a text with
the one holds over 0.8 of the other. Where templates have a ``license``, one that a text holds only by its likeness to another goes: if both
are found, the text has shingles that tell the second from the first, and none that tell the first from the second. A template that lies in
the other as a whole has no such shingles and stays.

Defined results: null and empty texts match nothing; a text or template shorter than a shingle has its whole
word sequence as its one shingle; null or wordless templates match nothing; equal templates are reported each under their
own id; rows with equal ids are reported together; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .common import materialise

ROWS, BANDS = 1, 32
SPLIT = r"[\x20\x09-\x0D]+"
MARKS = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~\u2018\u2019\u201c\u201d\u00ab\u00bb\u2013\u2014"
_MARK, _BOTH = (r"[\p{Punct}\u2018\u2019\u201c\u201d\u00ab\u00bb\u2013\u2014" + x + "]" for x in ("", r"\x20\x09-\x0D"))
#: a run of marks and white space with some white space in it; possessive, so that long runs of marks stay linear
BARE_SPLIT = rf"(?<!{_BOTH}){_MARK}*+[\x20\x09-\x0D]{_BOTH}*+"
# fixed values: notices by which public licences are named in running text
NOTICES = {
    "MIT": "Released under the MIT License.",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "BSD": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), "
                "to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
                "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
}

# further wordings and standard headers
WORDINGS = {
    "MIT": [
        "This project is licensed under the MIT License.",
        "Licensed under the MIT license.",
        "Distributed under the MIT License.",
        "This software is released under the MIT License.",
        "SPDX-License-Identifier: MIT",
        "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
        "Licensed to the Apache Software Foundation (ASF) under one or more contributor license agreements. See the NOTICE file distributed with this work for additional information regarding copyright ownership. The ASF licenses this file to You under the Apache License, Version 2.0",
        "This project is licensed under the Apache License 2.0.",
        "Released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "GPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU General Public License v3.0.",
        "This project is licensed under the GNU GPL version 3.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "GPL-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
        "SPDX-License-Identifier: GPL-2.0-only",
    ],
    "GPL": [
        "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
    ],
    "LGPL-2.1": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    ],
    "AGPL-3.0": [
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "Licensed under the GNU Affero General Public License v3.0.",
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "BSD": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the BSD 3-Clause License.",
        "Licensed under the BSD 2-Clause License.",
    ],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    ],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at http://www.boost.org/LICENSE_1_0.txt)",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "CC-BY-4.0": [
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0 International.",
    ],
    "CC-BY-SA-4.0": [
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Licensed under CC BY-SA 4.0 International.",
    ],
    "CC-BY-NC-4.0": [
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "CC-BY-SA": [
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ],
}


def full_texts() -> dict[str, str]:
    """License texts beside this module, as systems hand them out; also where the package is a zip."""
    found = {p.name[:-4]: p.read_text(encoding="utf-8") for p in (resources.files(__package__) / "license_texts").iterdir() if p.name.endswith(".txt")}
    if not found:
        raise FileNotFoundError("the package's license_texts are missing")
    return {f"{name}-text": found[name] for name in sorted(found)}


def license_of(template_id: str) -> str:
    """The license that a template of the query stands for: its id without the wording's number or ``-text``."""
    return template_id.split("#")[0].removesuffix("-text")


def templates(spark: SparkSession) -> DataFrame:
    """The query's templates: notices, standard headers in several wordings, full texts. A wording is a row; rows of one license share ``license``."""
    rows = [*NOTICES.items(), *((f"{k}#{i}", x) for k, v in WORDINGS.items() for i, x in enumerate(v)), *full_texts().items()]
    return spark.createDataFrame([(k, license_of(k), x) for k, x in rows], "template_id string, license string, text string")


def notices(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(NOTICES.items()), "template_id string, text string")


def band_probability(similarity: float, rows: int = ROWS, bands: int = BANDS) -> float:
    return 1 - (1 - similarity ** rows) ** bands


def words(text: Column, bare: bool = False) -> Column:
    """A-Z lowered; other letters stay. ``bare``: without ASCII punctuation and typographic quotes and dashes at word ends."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    if bare:
        inner = F.btrim(F.translate(F.coalesce(text, F.lit("")), upper, lower), F.lit(" \t\n\v\f\r" + MARKS))
        return F.when(inner != "", F.split(inner, BARE_SPLIT)).otherwise(F.array().cast("array<string>"))
    inner = F.btrim(F.translate(F.coalesce(text, F.lit("")), upper, lower), F.lit(" \t\n\v\f\r"))
    return F.when(inner != "", F.split(inner, SPLIT)).otherwise(F.array().cast("array<string>"))


def shingles(w: Column, n: int) -> Column:
    """Hashes of the n-word shingles of a word array column, in order."""
    many = F.transform(F.sequence(F.lit(0), F.size(w) - n), lambda i: F.xxhash64(*[w[i + k] for k in range(n)]))
    whole = F.array(F.xxhash64(F.array_join(w, " "), F.lit(n)))
    return F.when(F.size(w) >= n, many).when(F.size(w) > 0, whole).otherwise(F.array().cast("array<bigint>"))


def _once(array: Column, name: str) -> Column:
    """Computes an array once per row. As a generated column it isn't substituted into later filters and lambdas,
    which would compute it anew for every element."""
    return F.explode(F.array(array)).alias(name)


def band_keys(part: Column, rows: int, bands: int) -> Column:
    """The band keys of an array of shingle hashes."""
    def lowest(k: int) -> Column:
        return F.array_min(F.transform(part, lambda x: F.xxhash64(x, F.lit(k))))

    low = [lowest(k) for k in range(rows * bands)]
    return F.array(*[F.xxhash64(F.lit(b), *low[b * rows:(b + 1) * rows]) for b in range(bands)])


def scan(docs: DataFrame, templates: DataFrame, *, n: int = 5, containment: float = 0.8, rows: int = ROWS, bands: int = BANDS,
         every_start: bool = False, bare: bool = False) -> DataFrame:
    """doc_id, template_id, containment (of the best window), n_windows (that reach ``containment``), first_word, last_word
    (positions that those windows span, last exclusive). With ``every_start``, templates with a ``license`` are told apart, and the result
    has the license too."""
    licensed = every_start and "license" in templates.columns
    names = materialise(templates.select("template_id", "license").dropDuplicates(["template_id"]), "licenses") if licensed else None
    t = templates.select("template_id", words(F.col("text"), bare).alias("w")).where(F.size("w") > 0)
    t = t.select("template_id", F.array_distinct(shingles(F.col("w"), n)).alias("template"), F.size(shingles(F.col("w"), n)).alias("len"))
    t = t.withColumn("span", F.pow(2, F.ceil(F.log2(F.col("len").cast("double")))).cast("int"))
    t = materialise(t.withColumn("key", F.explode(F.array_distinct(band_keys(F.col("template"), rows, bands)))), "templates")
    spans = sorted(r[0] for r in t.select("span").distinct().collect())  # powers of two: as many as the longest template has bits
    if not spans:
        return docs.sparkSession.createDataFrame([], "doc_id long, template_id string, " + "license string, " * licensed + "containment double, n_windows long, first_word int, last_word int")
    known = materialise(t.select(F.explode("template").alias("h")).distinct(), "shingles")

    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _once(words(F.col("text"), bare), "w"))
    d = materialise(_with_hits(d, known, templates, n, bare), "hits")  # read once per class of windows
    if every_start:
        return _every_start(d, t, spans, n, containment, rows, bands, names)
    windows = []
    for span in spans:
        stride = max(1, span // 4) if span >= 32 else 1
        last = F.greatest(F.lit(0), F.size("sh") - span)
        # starts whose window holds a hit; the last window ends with the text
        starts = F.array_distinct(F.flatten(F.transform("hits", lambda p: F.transform(
            F.sequence(F.ceil(F.greatest(F.lit(0), p - span + 1) / stride).cast("int"), F.greatest(F.ceil(F.greatest(F.lit(0), p - span + 1) / stride), F.floor(p / stride)).cast("int")),
            lambda i: F.least(i * stride, last)))))
        windows.append(d.select("doc_id", "n_words", "sh", F.explode(starts).alias("start"), F.lit(span).alias("span")))
    all_windows = windows[0]
    for x in windows[1:]:
        all_windows = all_windows.unionByName(x)
    all_windows = all_windows.select("doc_id", "n_words", "start", "span", F.slice("sh", F.col("start") + 1, F.col("span")).alias("part"))
    keyed = all_windows.withColumn("key", F.explode(F.array_distinct(band_keys(F.col("part"), rows, bands))))
    found = keyed.join(t.select("template_id", "template", "span", "key"), ["span", "key"]).dropDuplicates(["doc_id", "start", "span", "template_id"])
    share = F.size(F.array_intersect("part", "template")) / F.size("template")
    found = found.withColumn("containment", share).where(F.col("containment") >= containment)
    end = F.least(F.col("n_words"), F.col("start") + F.size("part") + (n - 1))
    return found.withColumn("end", end).groupBy("doc_id", "template_id").agg(
        F.max("containment").alias("containment"), F.count("*").alias("n_windows"), F.min("start").alias("first_word"), F.max("end").alias("last_word"))


def _telling(known: DataFrame, names: DataFrame, containment: float) -> DataFrame:
    """(template, rival, h): shingles of a template that its rival lacks. Rivals are templates of different licenses of which one holds
    ``containment`` of the other, but not all of it."""
    a = known.join(names, "template_id").select(F.col("template_id").alias("template"), F.col("license").alias("own"), "size", "h")
    b = known.join(names, "template_id").select(F.col("template_id").alias("rival"), F.col("license").alias("other"), F.col("h").alias("its"))
    shared = a.join(b, (F.col("h") == F.col("its")) & (F.col("own") != F.col("other"))).groupBy("template", "rival", "size").agg(F.count("*").alias("common"))
    near = shared.where((F.col("common") >= containment * F.col("size")) & (F.col("common") < F.col("size"))).select("template", "rival")
    near = materialise(near.unionByName(near.select(F.col("rival").alias("template"), F.col("template").alias("rival"))).distinct(), "rivals")
    mine = near.join(a.select("template", "h"), "template")
    return materialise(mine.join(b.select("rival", F.col("its").alias("h")), ["rival", "h"], "left_anti").select("template", "rival", "h"), "telling")


def _only_alike(steps: DataFrame, at: DataFrame, telling: DataFrame) -> DataFrame:
    """(row, template_id) found only by likeness to another template found in the row."""
    held = at.select("row", F.col("template_id").alias("template"), "h").distinct().join(telling, ["template", "h"])
    held = materialise(held.select("row", "template", "rival").distinct(), "evidence")
    found = steps.select("row", "template_id").distinct()
    both = held.join(found.select("row", F.col("template_id").alias("template")), ["row", "template"]).join(found.select("row", F.col("template_id").alias("rival")), ["row", "rival"])
    against = held.select("row", F.col("template").alias("rival"), F.col("rival").alias("template"))
    return both.join(against, ["row", "template", "rival"], "left_anti").select("row", F.col("rival").alias("template_id")).distinct()


def _every_start(d: DataFrame, t: DataFrame, spans: list[int], n: int, containment: float, rows: int, bands: int, names: DataFrame | None) -> DataFrame:
    """As ``scan``, over the windows at every start."""
    d = d.withColumn("row", F.xxhash64("doc_id", "sh"))
    least = t.groupBy("span").agg(F.min(F.size("template")).alias("size")).collect()
    needs = {x["span"]: max(1, math.ceil(containment * x["size"] - 1e-9)) for x in least}
    windows = []
    for span in spans:
        stride = span // 4 if span >= 32 else 1
        length = span + stride - 1  # holds the windows of all starts from its own to the next
        # starts whose window holds as many hits as the class's smallest template needs: fewer can't reach the containment
        most = F.lit(needs[span] - 1)
        low = lambda p, j: F.ceil(F.when(F.get("hits", j + most).isNotNull(), F.greatest(F.lit(0), F.get("hits", j + most) - length + 1)) / stride).cast("int")
        starts = F.array_distinct(F.flatten(F.transform(F.filter(F.transform("hits", lambda p, j: F.struct(low(p, j).alias("a"), F.floor(p / stride).cast("int").alias("b"))),
            lambda x: x["a"].isNotNull() & (x["a"] <= x["b"])), lambda x: F.transform(F.sequence(x["a"], x["b"]), lambda i: i * stride))))
        windows.append(d.where(F.size("hits") > most).select("row", F.explode(starts).alias("start"), F.lit(span).alias("span"), F.slice("sh", F.col("start") + 1, length).alias("part")))
    all_windows = windows[0]
    for x in windows[1:]:
        all_windows = all_windows.unionByName(x)
    keyed = all_windows.select("row", "span", F.explode(F.array_distinct(band_keys(F.col("part"), rows, bands))).alias("key"))
    found = keyed.join(t.select("template_id", "span", "key"), ["span", "key"]).select("row", "template_id").distinct()
    sizes = t.select("template_id", "template", "span").distinct()
    known = sizes.select("template_id", "span", F.size("template").alias("size"), F.explode("template").alias("h"))
    # where the retrieved templates' shingles stand in the text
    at = d.select("row", "doc_id", "n_words", F.size("sh").alias("n_sh"), "sh", F.explode("hits").alias("p")).withColumn("h", F.get("sh", F.col("p"))).drop("sh")
    at = at.join(found, "row").join(known, ["template_id", "h"]).dropDuplicates(["row", "template_id", "p"])
    if names is not None:
        at = occurrences = materialise(at, "occurrences")
    before = F.lag("p").over(Window.partitionBy("row", "template_id", "h").orderBy("p"))
    lo = F.greatest(F.lit(0), F.col("p") - F.col("span") + 1, F.coalesce("before", F.lit(-1)) + 1)
    hi = F.least("p", F.greatest(F.lit(0), F.col("n_sh") - F.col("span")))
    at = at.withColumn("before", before).select("*", lo.alias("lo"), hi.alias("hi")).where("lo <= hi")
    row = ["row", "doc_id", "n_words", "n_sh", "template_id", "span", "size"]
    ends = at.select(*row, F.explode(F.array(F.struct(F.col("lo").alias("start"), F.lit(1).alias("d")), F.struct((F.col("hi") + 1).alias("start"), F.lit(-1).alias("d")))).alias("e"))
    ends = ends.groupBy(*row, "e.start").agg(F.sum("e.d").alias("d"))
    order = Window.partitionBy("row", "template_id").orderBy("start")
    steps = ends.select(*row, "start", F.sum("d").over(order).alias("held"), F.lead("start").over(order).alias("next"))
    steps = steps.withColumn("containment", F.col("held") / F.col("size")).where((F.col("containment") >= containment) & F.col("next").isNotNull())
    end = F.least(F.col("n_words"), F.col("next") - 1 + F.least("span", "n_sh") + (n - 1))
    key = ["doc_id", "template_id"]
    if names is not None:
        steps = materialise(steps, "windows")
        alike = _only_alike(steps, occurrences, _telling(known.select("template_id", "size", "h"), names, containment))
        steps = steps.join(alike, ["row", "template_id"], "left_anti").join(names, "template_id")
        key.append("license")
    return steps.withColumn("end", end).groupBy(*key).agg(
        F.max("containment").alias("containment"), F.sum(F.col("next") - F.col("start")).alias("n_windows"), F.min("start").alias("first_word"), F.max("end").alias("last_word"))


def _with_hits(d: DataFrame, known: DataFrame, templates: DataFrame, n: int, bare: bool = False) -> DataFrame:
    """doc_id, n_words, sh, ``hits``: positions of shingles that some template has; texts without any can't
    match and go. From (doc_id, w).

    The templates are a parameter: up to ``LITERAL`` shingles they are literal sets in the plan, and only
    positions whose first two words begin a template shingle are hashed. Larger collections are joined position by position."""
    listed = [r[0] for r in known.limit(LITERAL + 1).collect()]
    if len(listed) > LITERAL or n < 2:
        keyed = d.select("doc_id", F.size("w").alias("n_words"), _once(shingles(F.col("w"), n), "sh")).withColumn("row", F.xxhash64("doc_id", "sh"))
        hits = keyed.select("row", F.posexplode("sh").alias("at", "h")).join(known, "h").groupBy("row").agg(F.sort_array(F.collect_set("at")).alias("hits"))
        return keyed.join(hits, "row").drop("row")
    begins = templates.select(words(F.col("text"), bare).alias("w")).where(F.size("w") >= n)
    pairs = begins.select(F.explode(F.transform(F.sequence(F.lit(0), F.size("w") - n), lambda i: F.struct(F.col("w")[i].alias("x"), F.col("w")[i + 1].alias("y")))).alias("p"))
    pairs = pairs.select("p.*").distinct().limit(LITERAL).collect()  # at most as many as shingles
    first, second = sorted({r["x"] for r in pairs}) or [""], sorted({r["y"] for r in pairs}) or [""]
    w = F.col("w")
    opens = F.filter(F.transform(w, lambda x, i: F.when(x.isin(first), i)), lambda i: i.isNotNull())
    opens = F.filter(opens, lambda i: F.get(w, i + 1).isin(second) & (i + n <= F.size(w)))
    short = F.when((F.size(w) > 0) & (F.size(w) < n), F.array(F.lit(0))).otherwise(opens)
    d = d.select("doc_id", "w", _once(short, "opens")).where(F.size("opens") > 0)
    d = d.select("doc_id", "w", _once(F.transform("opens", lambda i: F.struct(i.alias("at"), F.when(F.size(w) >= n, F.xxhash64(*[F.get(w, i + k) for k in range(n)])).otherwise(
        F.xxhash64(F.array_join(w, " "), F.lit(n))).alias("h"))), "opens"))
    # parsed at once: a literal per call would take the driver longer
    d = d.select("doc_id", "w", _once(F.expr(f"transform(filter(opens, x -> x.h IN ({', '.join(f'{h}L' for h in listed) or 'NULL'})), x -> x.at)"), "hits")).where(F.size("hits") > 0)
    return d.select("doc_id", F.size("w").alias("n_words"), "hits", _once(shingles(w, n), "sh"))


LITERAL = 100_000
