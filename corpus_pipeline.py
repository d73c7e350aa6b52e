"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and is written as Parquet and read
again before the next one. All but the last return the columns of ``documents``. Filtering stages keep clean documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from roadflow.llm.common import materialise
from roadflow.llm.minhash import near_groups, node
from roadflow.llm.mixing import mixed_documents
from roadflow.llm.packing import pack
from roadflow.llm.quality import good_documents
from roadflow.llm.suffix import without_repeats


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. Its labels are the table ``labels``."""
    return good_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: that with the smallest id (of several texts with that id, the smallest hash; of equal rows one).
    Different texts under one id are documents of their own."""
    kept = near_groups(docs).where("kept").groupBy("component").agg(F.min("id").alias("kept_id"))
    kept = materialise(kept.select("kept_id").distinct(), "kept")
    rows = docs.select(F.struct(*docs.columns).alias("row"), node().alias("id"))
    rows = rows.join(kept, rows["id"] == kept["kept_id"], "left_semi")
    return rows.groupBy("id").agg(F.min("row").alias("row")).select("row.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats of 100 bytes and more are cut out; a document of which nothing is left goes."""
    out = without_repeats(docs)
    return out.where(F.col("text").isNull() | (F.col("text") != "") | (F.col("n_chars") > 0))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: documents once per pass."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces with their sequences and places."""
    return pack(docs)


STAGES = [("quality", quality_classifier), ("near_dedup", near_dedup), ("repeated_passages", repeated_passages), ("mixing", source_mix), ("packing", packing)]

#: A trained classifier, signatures and suffix sorting aren't SQL: tested stage by stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
