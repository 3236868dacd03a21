"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import document, maybe_member, without_ids
from lociframe.session import stage

PREFIX = 64  # characters under the prefix hash


def survivors(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, digest, document) of the rows whose length and prefix hash occur twice at least, and of few others; staged.

    The first scan keeps a length and a prefix hash per row. Lengths and then (length, prefix) pairs
    that occur once leave. A bitmap of fixed size takes the remaining pairs to the second scan, so that
    texts are neither shuffled nor hashed whole unless their pair survives; a row that passes the bitmap
    by chance only costs a hash. The digest is the SHA-256 of the whole text.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    size, prefix = F.octet_length(text).cast("long"), F.xxhash64(F.substring(text, 1, PREFIX))
    keys = stage(docs.select(size.alias("size"), prefix.alias("prefix")), "exact-keys")
    sizes = keys.groupBy("size").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = keys.groupBy("size", "prefix").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    pairs = stage(pairs.join(sizes.select("size"), "size", "left_semi").select("size", "prefix"), "exact-pairs")
    rows = docs.select(F.col(id_column).alias("id"), text.alias("text"), document(id_column, text_column).alias("document")).withColumns({"size": F.octet_length("text").cast("long"), "prefix": F.xxhash64(F.substring("text", 1, PREFIX))})
    tested = maybe_member(rows, F.struct("size", "prefix"), pairs, F.struct("size", "prefix"))
    return stage(tested.where("_maybe").select("id", F.unhex(F.sha2("text", 256)).alias("digest"), "document"), "exact-full")


def groups(full: DataFrame) -> DataFrame:
    """(digest, keep_id, group_size) of every text that occurs twice at least; staged.

    The counts and largest ids are combined before the shuffle, so a group of any size is one row a task.
    """
    found = full.groupBy("digest").agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return stage(found.where("group_size > 1"), "exact-groups")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, digest, document, keep_id, group_size, kept) of the rows whose text occurs twice at least.

    Null text counts as empty. The largest id stays; null ids are smallest. Rows that repeat the id
    that stays are the same document and all count as kept. An empty table gives no rows.
    """
    full = survivors(docs, id_column, text_column)
    return full.join(groups(full), "digest").withColumn("kept", F.col("id").eqNullSafe(F.col("keep_id")))


def drop_exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` without the rows that an equal text with a larger id replaces; rows without id stay.

    Another text under the same id is another document, and stays.
    """
    gone = exact_duplicates(docs, id_column, text_column).where("NOT kept AND id IS NOT NULL")
    return without_ids(docs, document(id_column, text_column), stage(gone.select("document").distinct(), "exact-gone"))
