"""A training corpus from documents: quality, exact copies, near copies, source mix, token ids.

Each stage works on what the one before kept, and is written and read again in between.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lociframe.llm import exact_dedup, jaccard_join, mixing, quality_fm, sentencepiece_codec
from lociframe.llm.common import document, maybe_member, without_ids
from lociframe.session import stage


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; rows without id stay. A text is judged by itself where an id repeats with others."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    key = F.when(F.col("doc_id").isNotNull(), document("doc_id", "text"))
    named = docs.select(key.alias("doc_id"), "text", "n_chars").where("doc_id IS NOT NULL")
    scored = quality_fm.score(named, quality_fm.train(docs, labels))
    rejected = scored.where(F.col("score") < quality_fm.THRESHOLD).select("id").distinct()
    return without_ids(docs, key, stage(rejected, "rejected"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest id."""
    return exact_dedup.drop_exact_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones, the one with the smallest id."""
    return jaccard_join.drop_similar(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.take_mix(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document of the mix; each copy of a document draws merges of its own."""
    row = docs.select("doc_id", "text")
    often = stage(row.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id"), "repeated")
    tested = maybe_member(row, F.col("doc_id"), often, F.col("doc_id"))
    copy = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))) - 1
    once = F.coalesce(~F.col("_maybe"), F.lit(True)) | F.col("doc_id").isNull()
    copies = tested.where(~once).withColumn("copy", copy)
    keyed = tested.where(once).withColumn("copy", F.lit(0)).unionByName(copies)
    key = F.when(F.col("copy") > 0, F.xxhash64("doc_id", "copy")).otherwise(F.col("doc_id"))
    return sentencepiece_codec.encode(keyed.select("doc_id", "text", key.alias("key")), key_column="key").withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("exact dedup", exact),
    ("n-gram Jaccard join", near),
    ("source mixing", mix),
    ("SentencePiece encoding", encode),
]

# The first and the fourth stage learn by iteration, which SQL does not express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
