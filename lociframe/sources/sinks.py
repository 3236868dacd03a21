"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.schema import SNAPSHOT_COLUMNS


def write_table(df: DataFrame, path: str) -> None:
    """Parquet, replacing what is there."""
    df.write.mode("overwrite").parquet(path, compression="snappy")


def write_repartitioned(df: DataFrame, path: str, n_partitions: int) -> None:
    """Parquet in a given number of files; fails if the path exists."""
    df.repartition(n_partitions).write.parquet(path)


def write_tsv(df: DataFrame, path: str, compression: str = "none", mode: str = "errorifexists") -> None:
    """TSV with header; a NULL is an empty field and so is an empty text."""
    df.write.mode(mode).csv(path, sep="\t", header=True, nullValue="", emptyValue="", compression=compression)


def write_calls(df: DataFrame, path: str) -> None:
    """Calls by contig; a re-run replaces only the contigs it contains.

    The rebalance hint lets Spark size the files by bytes, so that a contig with a large share of
    the calls is split over many tasks and small contigs do not scatter.
    """
    (
        df.hint("rebalance", F.col("contig"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy("contig")
        .parquet(path)
    )


RESULT_PARTITIONS = ["contig", "trait_group_id", "batch_index"]


def write_results(df: DataFrame, path: str, placed: bool = False) -> None:
    """Association results by contig, trait group and batch; a re-run replaces only what it contains.

    Rows that already lie together (``placed``) are written where they are.
    """
    (
        (df if placed else df.hint("rebalance", *[F.col(c) for c in RESULT_PARTITIONS]))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*RESULT_PARTITIONS)
        .parquet(path)
    )


def write_snapshot(variants: DataFrame, samples: DataFrame, trait_values: DataFrame, path: str) -> None:
    """The variables behind an association run as three tables with fixed columns."""
    for name, df in (("variants", variants), ("samples", samples), ("traits", trait_values)):
        keys = ["sample_id"] if name == "traits" else []
        df.select(*keys, *SNAPSHOT_COLUMNS[name]).write.mode("overwrite").parquet(f"{path}/{name}")


def write_published(df: DataFrame, path: str, file_column: str) -> None:
    """Gzipped TSV, one folder per trait file name; a large trait is split over several files."""
    (
        df.hint("rebalance", F.col(file_column))
        .write.mode("overwrite")
        .partitionBy(file_column)
        .csv(path, sep="\t", header=True, compression="gzip")
    )
