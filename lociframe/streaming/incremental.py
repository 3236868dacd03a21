"""Incremental runs: skip finished work, take in arriving files once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociframe.operators.traits import pending_work
from lociframe.session import stage
from lociframe.sources.sinks import RESULT_PARTITIONS, write_results
from lociframe.sources.sumstats import list_files

WORK_SCHEMA = "contig string, batch_index int, trait_group_id long"


LOG_SCHEMA = f"{WORK_SCHEMA}, has_result boolean, settings string"


def log_path(results_path: str) -> str:
    """The log lies in the results folder, under a name that readers of the results pass over."""
    return f"{results_path.rstrip('/')}/_finished"


def finished_work(spark: SparkSession, results_path: str, settings: str = "") -> DataFrame:
    """(contig, batch, trait group) that the log says are done: with a result, or without one under the same settings.

    A row is logged after its results are committed. Files of a run that was ended before are not in the log, so
    their work is done again and replaces them.
    """
    try:
        log = spark.read.schema(LOG_SCHEMA).parquet(log_path(results_path))
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], WORK_SCHEMA)
    done = log.filter(F.col("has_result") | (F.col("settings") == settings))
    return done.select("contig", "batch_index", "trait_group_id").distinct()


def stored_work(spark: SparkSession, results_path: str) -> DataFrame:
    """(contig, batch, trait group) with files, from the names of the partition folders; no result is read."""
    try:
        found = list_files(spark, results_path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], WORK_SCHEMA)
    folder = {c: F.regexp_extract("file", f"/{c}=([^/]+)/", 1) for c in RESULT_PARTITIONS}
    return (
        found.filter(F.col("file").endswith(".parquet") & F.col("file").contains("/contig="))
        .select(
            folder["contig"].alias("contig"),
            folder["batch_index"].cast("int").alias("batch_index"),
            folder["trait_group_id"].cast("long").alias("trait_group_id"),
        )
        .distinct()
    )


def run_pending(
    spark: SparkSession,
    work: DataFrame,
    results_path: str,
    compute: Callable[[DataFrame], DataFrame],
    settings: str = "",
    placed: bool = False,
) -> DataFrame:
    """Compute and write the part of ``work`` that is not finished yet, and log it; returns that part.

    ``compute`` gets the pending rows and returns results that carry ``contig``,
    ``trait_group_id`` and ``batch_index``. A second run with the same work finds nothing to do: work that gave no result
    is not tried again as long as ``settings`` are the same. ``placed``: see ``write_results``.
    """
    pending = pending_work(work, finished_work(spark, results_path, settings))
    todo = stage(pending, "pending")  # fixed before results appear
    if not todo.isEmpty():
        write_results(compute(todo), results_path, placed)
        stored = stored_work(spark, results_path).withColumn("has_result", F.lit(True))
        keys = [f.name for f in stored.schema.fields if f.name != "has_result"]
        logged = todo.select(*keys).join(stored, keys, "left")
        logged = logged.withColumns({"has_result": F.coalesce("has_result", F.lit(False)), "settings": F.lit(settings)})
        logged.coalesce(1).write.mode("append").parquet(log_path(results_path))
    return todo


def ingest_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    checkpoint: str,
    sink: Callable[[DataFrame, int], None],
    file_format: str = "parquet",
    **options: str,
):
    """Hand files that arrived since the last run to ``sink`` once, then stop.

    The stream's checkpoint remembers the files taken in; ``sink`` should replace what it writes,
    so that a repeated batch does no harm.
    """
    stream = spark.readStream.format(file_format).schema(schema).options(**options).load(source)
    return (
        stream.writeStream.foreachBatch(sink)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

