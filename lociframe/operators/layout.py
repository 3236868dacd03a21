"""Stored call blocks laid out for the association: one bucket per variant block, its rows in order of sample block.

A bucketed table tells Spark that a variant block lies in one file, so grouping by it needs no exchange, in any later
session. The number of buckets is kept beside the files, because a path alone does not say how it was bucketed.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.operators.blocks import CALL_KEYS

VARIANT_WIDTH = 4096
BUCKET = "variant_block"
ORDER = [BUCKET, "sample_block"]


def variant_block(n_blocks: int) -> Column:
    """Block of a variant, by hash, so that no block is hot."""
    return F.pmod(F.xxhash64(*CALL_KEYS), F.lit(n_blocks)).cast("int")


def _table(path: str, use: str) -> str:
    return f"lociframe_{use}_{hashlib.sha256(path.encode()).hexdigest()[:24]}"


def write_layout(calls: DataFrame, path: str, n_variants: int, variant_width: int = VARIANT_WIDTH) -> None:
    """Write packed blocks once, shuffled to their bucket; each of ceil(n_variants / variant_width) tasks writes one file.

    The table's name is given up after the write; its files and ``<path>_layout`` stay.
    """
    spark = calls.sparkSession
    n_blocks = max(1, -(-n_variants // variant_width))
    placed = calls.withColumn(BUCKET, variant_block(n_blocks)).repartition(n_blocks, BUCKET).sortWithinPartitions(*ORDER, *CALL_KEYS)
    name = _table(path, "written")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    placed.write.format("parquet").mode("overwrite").bucketBy(n_blocks, BUCKET).sortBy(*ORDER).option("path", path).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")
    spark.createDataFrame([(n_blocks,)], "n_blocks int").coalesce(1).write.mode("overwrite").parquet(f"{path}_layout")


def read_layout(spark: SparkSession, path: str) -> DataFrame:
    """Blocks written by ``write_layout``, with their buckets known to Spark."""
    n_blocks = spark.read.parquet(f"{path}_layout").first().n_blocks
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in spark.read.parquet(path).schema)
    name, place = _table(path, "read"), path.replace("'", "\\'")
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    spark.sql(
        f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({BUCKET}) SORTED BY ({', '.join(ORDER)}) INTO {n_blocks} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)
