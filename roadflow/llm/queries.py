"""The checked queries: each applies one operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from .common import held_out
from .oracle import ORACLE_SQL


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_table(spark, sf_dir, "documents"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan, templates

    return scan(_table(spark, sf_dir, "documents"), templates(spark), every_start=True, bare=True)


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import fit, score

    docs = _table(spark, sf_dir, "documents")
    out = score(docs, fit(docs, _table(spark, sf_dir, "labels")), "doc_id")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import mix

    out = mix(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", "size", "source_size", "target", "taken", "epochs", "weight")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import lookup, write_archive

    pages = _table(spark, sf_dir, "pages")
    out = lookup(write_archive(pages, least_bytes=0), pages, payload=False)
    return out.select(F.col("id").alias("page_id"), "payload_bytes", "payload_digest", F.col("type").alias("record_type"), "refers_to")


def op6_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .vecdedup import linked

    return linked(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op7_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents"), n=3, threshold=0.85)


def op8_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ann import nearest

    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op9_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix import doc_key, repeats

    docs = _table(spark, sf_dir, "documents")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("doc_id", doc_key().alias("key"), F.octet_length(raw).cast("long").alias("n_bytes"), F.sha2(raw, 256).alias("sha"))
    lost = repeats(docs).select("doc", F.octet_length("kept").cast("long").alias("n_kept"), F.size("spans").cast("long").alias("spans"),
                                F.sha2("kept", 256).alias("kept_sha")).dropDuplicates(["doc"])
    out = rows.join(lost, rows["key"] == lost["doc"], "left")
    return out.select("doc_id", "n_bytes", (F.col("n_bytes") - F.coalesce("n_kept", "n_bytes")).alias("n_removed"),
                      F.coalesce("spans", F.lit(0).cast("long")).alias("n_spans"), F.coalesce("kept_sha", "sha").alias("kept_sha256"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import label_spans, learn

    docs = _table(spark, sf_dir, "documents")
    out = label_spans(docs, learn(docs), "doc_id")
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .turns import damaged, digests, repair

    given = _table(spark, sf_dir, "conversations")
    out = digests(repair(damaged(given), given))
    return out.select("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten

    return whiten(_table(spark, sf_dir, "embeddings"))


def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pieces import decode, encode

    coded = encode(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    coded = coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"), "ids")
    return decode(coded).select("doc_id", "n_tokens", "ids_sha256", F.sha2("text", 256).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_fit_packing": op1_best_fit_packing,
    "op2_license_scan": op2_license_scan,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_source_mixing": op4_source_mixing,
    "op5_warc": op5_warc,
    "op6_embedding_near_dedup": op6_embedding_near_dedup,
    "op7_minhash_near_dedup": op7_minhash_near_dedup,
    "op8_nearest_neighbours": op8_nearest_neighbours,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_language_id": op10_language_id,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_sentencepiece": op13_sentencepiece,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
