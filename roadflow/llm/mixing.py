"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Every document gets the exponential key ``-ln(u) / weight``, u from a hash of its id and
``weight`` its quality; ascending keys are a weighted sample without replacement. A
source's target is met by complete epochs over the source first, and the rest by the
documents with the smallest keys, prefix-summed to the words that are left. The document
on the border gives only the words still missing, so each source meets its target exactly
(rounded down).

No window ever spans a source: keys are mapped monotonically to ``BUCKETS`` buckets,
bucket sums (partial aggregates) are prefix-summed per source, and only the bucket in which
the budget ends goes on: if it holds more than ``BORDER_ROWS`` rows of a source (low weights crowd the last
buckets), it is cut into buckets again between its own smallest and largest key, and so on; then it is sorted row by row.

Defined results: null or wordless texts have size 0 and take 0; a null source is a source
of its own, ranked last; a source without words has target 0; rows with equal keys are
ordered by document id, then text hash (rows equal in both: any order, the multiset of results is the
same); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..operators.ordering import with_positions
from .common import materialise

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3.0, 1.0, 2.0)
BUCKETS = 4096
BORDER_ROWS = 100_000  # of one source that are sorted in one task


def n_words(text: Column) -> Column:
    """Java's ``[^...]`` takes code points, so a word of any script counts once."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def text_quality(text: Column) -> Column:
    """Weight in [0.1, 1]: the share of letters and spaces. Junk of symbols weighs little; empty: 0.1."""
    t = F.coalesce(text, F.lit(""))
    plain = F.length(F.regexp_replace(t, r"[^\p{L}\s]+", ""))
    return F.lit(0.1) + F.lit(0.9) * F.when(F.length(t) > 0, plain / F.length(t)).otherwise(F.lit(0.0))


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5,
                   most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from (source, size): weights repeat over the sources in
    code-point order (null last); together they get ``share`` of all words, none over ``most``
    times its own, the excess reshared by weight. One row per source; each round of resharing is one
    aggregate over the sources, which returns three numbers."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = with_positions(per, F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), ((F.col("position") - 1) % len(weights) + 1).cast("int"))
    per = materialise(per.withColumn("w", w).drop("position"), "sources").withColumn("cap", F.col("source_size") * F.lit(float(most)))
    total = per.agg(F.sum("source_size")).first()[0] or 0
    wanted, rate, capped = share * total, 0.0, -1
    while True:
        over = F.col("w") * F.lit(rate) >= F.col("cap")
        row = per.agg(F.sum(F.when(over, F.col("cap")).otherwise(0.0)).alias("full"),
                      F.sum(F.when(over, 0.0).otherwise(F.col("w"))).alias("free"),
                      F.sum(over.cast("int")).alias("n")).first()
        n = row["n"] or 0
        if n == capped or not row["free"]:
            break
        capped, rate = n, max(rate, (wanted - row["full"]) / row["free"])
    over = F.col("w") * F.lit(rate) >= F.col("cap")
    if not row["free"]:  # every source is full
        return per.select("source", "source_size", F.col("cap").alias("target"))
    return per.select("source", "source_size", F.when(over, F.col("cap")).otherwise(F.col("w") * rate).alias("target"))


def mix(docs: DataFrame, *, weights: tuple[float, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0,
        quality: Column | None = None, seed: int = 17, border_rows: int = BORDER_ROWS) -> DataFrame:
    """One row per document: doc_id, source, row_hash, size, weight, source_size, target,
    epochs (complete passes), part (words of one further, partial pass), taken."""
    text = F.col("text")
    rows = docs.select(
        "doc_id", "source", n_words(text).alias("size"),
        (quality if quality is not None else text_quality(text)).alias("weight"),
        F.xxhash64(F.col("doc_id"), text).alias("row_hash"))
    # u in (0, 1): 52 bits of a hash of the id
    bits = F.shiftrightunsigned(F.xxhash64(F.col("doc_id"), F.lit(seed)), 12)
    u = (bits.cast("double") + 0.5) / F.lit(float(1 << 52))
    key = -F.log(u) / F.greatest(F.coalesce(F.col("weight"), F.lit(0.0)), F.lit(1e-6))
    rows = materialise(rows.withColumn("key", key).withColumn(
        "bucket", F.least(F.floor((1 - F.exp(-F.col("key"))) * BUCKETS), F.lit(BUCKETS - 1)).cast("int")), "mix")
    targets = materialise(source_targets(rows.select("source", "size"), weights, share, most), "targets")
    budget = (F.floor(F.col("target") + 1e-6)).cast("long")
    epochs = F.when(F.col("source_size") > 0, F.least(F.floor(budget / F.col("source_size")), F.lit(int(most)))).otherwise(F.lit(0)).cast("long")
    targets = targets.withColumn("epochs", epochs).withColumn("left", budget - F.col("epochs") * F.col("source_size"))
    keep = ["doc_id", "source", "row_hash", "size", "weight", "source_size", "target", "epochs", "key"]
    named = targets.withColumnRenamed("source", "name")
    rows = rows.join(named, rows["source"].eqNullSafe(named["name"])).select(*keep, F.col("left").alias("room"), "bucket")
    done = []
    while True:
        plain, border = _settled(rows, keep)
        done.append(plain)
        border = materialise(border, "border")
        stats = border.groupBy("source").agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("n"))
        # a border of many rows with different keys is cut again, between its own smallest and largest key
        wide = (F.col("n") > border_rows) & (F.col("low") < F.col("high"))
        stats = materialise(stats.withColumn("wide", wide).select(F.col("source").alias("name"), "low", "high", "wide"), "border-keys")
        border = border.join(stats, border["source"].eqNullSafe(stats["name"])).drop("name")
        done.append(_sorted_border(border.where(~F.col("wide")), keep))
        if stats.where("wide").isEmpty():
            break
        place = F.floor((F.col("key") - F.col("low")) / (F.col("high") - F.col("low")) * BUCKETS)
        rows = border.where("wide").withColumn("bucket", F.least(place, F.lit(BUCKETS - 1)).cast("int")).select(*keep, "room", "bucket")
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out.select("doc_id", "source", "row_hash", "size", "weight", "source_size", "target", "epochs", "part",
                      (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"))


def _settled(rows: DataFrame, keep: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of buckets that lie before or behind their source's border, with ``part``; and those of the border's bucket, with the room that
    is left for them."""
    sums = rows.groupBy("source", "room", "bucket").agg(F.sum("size").alias("words"))
    # a source has at most BUCKETS rows here
    upto = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = F.sum("words").over(upto) - F.col("words")
    sums = materialise(sums.select(F.col("source").alias("name"), F.col("bucket").alias("slot"), (F.col("room") - before).alias("free"), "words"), "buckets")
    joined = rows.join(sums, rows["source"].eqNullSafe(sums["name"]) & (rows["bucket"] == sums["slot"]))
    on_border = (F.col("free") > 0) & (F.col("free") < F.col("words"))
    plain = joined.where(~on_border).select(*keep, F.when(F.col("free") > 0, F.col("size")).otherwise(F.lit(0).cast("long")).alias("part"))
    return plain, joined.where(on_border).select(*keep, F.col("free").alias("room"))


def _sorted_border(rows: DataFrame, keep: list[str]) -> DataFrame:
    """The last step: a border of few rows, or of rows with one key, is sorted and prefix-summed."""
    run = Window.partitionBy("source").orderBy("key", "doc_id", "row_hash").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("upto", F.sum("size").over(run))
    return rows.select(*keep, F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("room") - F.col("upto") + F.col("size"))).alias("part"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself, in the columns of ``docs``: a document once per complete epoch, and once
    more if the partial pass takes it (the border document's text ends after its last taken word). Rows equal in id and text
    come as often as all of them together are taken, with the other columns of one of them."""
    chosen = mix(docs, **options).groupBy("doc_id", "row_hash", "size").agg(F.sum("epochs").alias("epochs"), F.sum("part").alias("part"))
    more = F.when(F.col("size") > 0, F.floor(F.col("part") / F.col("size"))).otherwise(0)
    chosen = chosen.where("epochs > 0 OR part > 0").select("doc_id", "row_hash", "size", (F.col("epochs") + more).alias("epochs"), (F.col("part") - more * F.col("size")).alias("part"))
    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").alias("own"), F.xxhash64(F.col("doc_id"), F.col("text")).alias("doc_hash"))
    rows = rows.dropDuplicates(["own", "doc_hash"])
    rows = rows.join(chosen, rows["own"].eqNullSafe(chosen["doc_id"]) & (rows["doc_hash"] == chosen["row_hash"]), "inner")
    copies = F.concat(F.array_repeat(F.lit(-1).cast("long"), F.col("epochs").cast("int")),
                      F.when(F.col("part") > 0, F.array(F.col("part"))).otherwise(F.array().cast("array<bigint>")))
    rows = rows.select("doc", "size", F.explode(copies).alias("take"))
    whole = (F.col("take") < 0) | (F.col("take") >= F.col("size"))
    text = F.when(whole, F.col("doc.text")).otherwise(first_words(F.col("doc.text"), F.col("take")))
    changed = {"text": text}
    if "n_chars" in docs.columns:
        changed["n_chars"] = F.when(whole, F.col("doc.n_chars")).otherwise(F.length(text).cast("long"))
    return rows.select(*[changed.get(c, F.col(f"doc.`{c}`")).alias(c) for c in docs.columns])


def first_words(text: Column, n: Column) -> Column:
    """The first n words, joined by single blanks."""
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    return F.array_join(F.slice(words, F.lit(1), n.cast("int")), " ")
