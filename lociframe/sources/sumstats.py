"""Summary statistics: file manifests, published TSV files and own Parquet results."""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociframe.functions import text as X
from lociframe.operators.sumstats import own_result_columns, published_result_columns


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Paths below a folder; only the listing is read, never the contents."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(F.col("path").alias("file"))
    )


def own_manifest(files: DataFrame, all_contigs: bool = False) -> DataFrame:
    """Contig, batch and trait of own result files by name; other names are skipped.

    The default pattern takes numbered contigs only; ``all_contigs`` also takes X and XY.
    """
    pattern = X.OWN_FILE_ALL_CONTIGS if all_contigs else X.OWN_FILE
    name = X.base_name(F.col("file"))
    trait_id = F.regexp_extract(name, pattern, 3)
    return files.filter(name.rlike(pattern)).select(
        F.regexp_extract(name, pattern, 1).alias("contig"),
        F.regexp_extract(name, pattern, 2).cast("int").alias("batch"),
        trait_id.alias("trait_id"),
        X.id_group(trait_id).alias("trait_group_id"),
        X.id_code(trait_id).alias("trait_code_id"),
        "file",
    )


def _published_trait(name: Column) -> Column:
    """Trait id of a published file name: text before the first dot without a ``_raw`` ending."""
    trait = X.before_first_dot(name)
    return F.when(trait.endswith("_raw"), F.replace(trait, F.lit("_raw"), F.lit(""))).otherwise(trait)


def published_manifest(files: DataFrame) -> DataFrame:
    """Trait of published files by name; rank-normalised traits are left out in favour of raw ones."""
    name = X.base_name(F.col("file"))
    trait_id = _published_trait(name)
    kept = files.filter(F.col("file").endswith(".tsv.gz") & ~X.before_first_dot(name).endswith("_irnt"))
    return kept.select(
        trait_id.alias("trait_id"),
        X.id_group(trait_id).alias("trait_group_id"),
        X.id_code(trait_id).alias("trait_code_id"),
        "file",
    )


def published_trait_groups(files: DataFrame) -> DataFrame:
    """Distinct numeric trait groups of published files, rank-normalised ones included."""
    group = X.id_group(X.before_first_dot(X.base_name(F.col("file"))))
    return (
        files.filter(F.col("file").endswith(".tsv.gz"))
        .select(group.try_cast("long").alias("trait_group_id"))
        .filter(F.col("trait_group_id").isNotNull())
        .distinct()
    )


PUBLISHED_SCHEMA = T.StructType(
    [
        T.StructField("chromosome", T.StringType()),
        T.StructField("variant", T.StringType()),
        T.StructField("variant_id", T.StringType()),
        T.StructField("minor_allele", T.StringType()),
        T.StructField("n_complete_samples", T.LongType()),
        T.StructField("beta", T.DoubleType()),
        T.StructField("p-value", T.DoubleType()),
        T.StructField("tstat", T.DoubleType()),
    ]
)

# The trait file name is the path component that ends in .tsv.gz: a file, or a folder written by Spark.
_TRAIT_FILE = r"([^/=]+\.tsv\.gz)(?:/|$)"


def read_published(spark: SparkSession, path: str, traits: DataFrame | None = None) -> DataFrame:
    """Published results of the files below ``path``, in one scan for each order of columns.

    Columns are matched to each file's header by name, so files may order them in their own way and
    carry more than are read. The trait comes from the file name. ``traits`` (a manifest) restricts
    the result to its trait ids: other files are not opened. One job lists the files and another reads all
    headers; their paths, a few per trait, come to the driver.
    """
    name = F.regexp_extract("file", _TRAIT_FILE, 1)
    kept = list_files(spark, path).filter(name.endswith(".tsv.gz") & ~X.before_first_dot(name).endswith("_irnt"))
    kept = kept.withColumn("trait_id", _published_trait(name))
    if traits is not None:
        kept = kept.join(traits.select("trait_id").distinct(), "trait_id", "left_semi")
    listed = sorted(r.file for r in kept.select("file").collect())
    alike = first_lines(spark, listed).groupBy("line").agg(F.array_sort(F.collect_list("file")).alias("files"))
    found = alike.filter("line <> ''").orderBy("line").collect() if listed else []  # an empty file has no line
    parts = [_read_alike(spark, line, files) for line, files in found]
    if not parts:
        if traits is None:
            raise ValueError(f"no published results below {path}")
        parts = [spark.createDataFrame([], T.StructType([*PUBLISHED_SCHEMA, T.StructField("file", T.StringType())]))]
    trait_id = _published_trait(F.col("file"))
    return published_result_columns(
        reduce(DataFrame.unionByName, parts).withColumns(
            {"trait_id": trait_id, "trait_group_id": X.id_group(trait_id), "trait_code_id": X.id_code(trait_id)}
        )
    )


_HEADER_BYTES = 4096  # read at a time until the first line ends
_OPENED_BY_TASKS = ("file", "hdfs", "gs", "s3")  # file systems that tasks open without Spark


def first_lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """(file, line): the first line of each text file, gzipped where the name ends in .gz, in one job.

    Tasks open the files themselves and stop after the line, because Spark's readers decompress all of a file that
    cannot be split. On file systems that only Spark knows they are read so all the same. An empty file has a NULL
    line in the first way, and no row in the second.
    """
    if files and files[0].split(":", 1)[0] not in _OPENED_BY_TASKS:
        path = F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B")))  # which is escaped, but for a plus
        text = spark.read.text(files).select(path.alias("file"), "value", F.monotonically_increasing_id().alias("_seen"))
        return text.groupBy("file").agg(F.min_by("value", "_seen").alias("line"))

    def read(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            lines = pa.array([_first_line(path) for path in batch["file"].to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch["file"], lines], ["file", "line"])

    return spark.createDataFrame([(f,) for f in files], "file string").mapInArrow(read, "file string, line string")


def _first_line(path: str) -> str | None:
    # Spark names local files file:/a/b and does not escape; Arrow takes escapes for those of a URI.
    uri = re.sub(r"^file:/(?!/)", "file:///", path).replace("%", "%25").replace(" ", "%20").replace("#", "%23").replace("?", "%3F")
    system, place = fs.FileSystem.from_uri(uri)
    held = b""
    with system.open_input_stream(place, compression="gzip" if place.endswith(".gz") else None) as stream:
        while b"\n" not in held:
            more = stream.read(_HEADER_BYTES)
            if not more:
                break
            held += more
    return held.split(b"\n", 1)[0].removesuffix(b"\r").decode() if held else None


def _read_alike(spark: SparkSession, header: str, files: list[str]) -> DataFrame:
    """Files of one header; Spark holds each against it when it reads them."""
    known = {f.name: f.dataType for f in PUBLISHED_SCHEMA}
    names = header.split("\t")
    missing = [c for c in known if c not in names]
    if missing:
        raise ValueError(f"columns missing from {files[0]}: {missing}")
    file_schema = T.StructType([T.StructField(n, known.get(n, T.StringType())) for n in names])
    reader = spark.read.option("recursiveFileLookup", "true")  # folders named like partitions add no columns
    df = reader.csv(files, sep="\t", header=True, schema=file_schema, enforceSchema=False)
    trait_file = F.regexp_extract(F.col("_metadata.file_path"), _TRAIT_FILE, 1)
    return df.select(*[F.col(f"`{c}`") for c in known], trait_file.alias("file"))


def read_own(spark: SparkSession, path: str) -> DataFrame:
    """Own results of all files below ``path`` in one scan, in the comparison layout."""
    return own_result_columns(spark.read.parquet(path))
