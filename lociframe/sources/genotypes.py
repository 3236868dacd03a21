"""Variant info, sample files, probability tables, packed calls and the contig dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociframe import schema
from lociframe.functions import genotype as G
from lociframe.operators.reshape import pack_alleles, with_prefix


def contigs(spark: SparkSession, imputed: bool = True) -> DataFrame:
    """The contig dimension, every column text: 24 imputed or 26 hard-call contigs."""
    return spark.createDataFrame(schema.contig_rows(imputed), schema.CONTIG)


def _row_index(df: DataFrame, name: str) -> DataFrame:
    """0-based position of each row over all files, in the order of their names.

    The reader keeps file order within a split, ``_metadata`` says where the split starts, and the
    row ids of a split follow each other. So a row's place is its id less the first id of its
    split, plus the rows of the splits before; only the short list of splits is ordered.
    """
    split = df.select(
        "*",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_seen"),
    )
    before = Window.orderBy("_file", "_start").rowsBetween(Window.unboundedPreceding, -1)
    sizes = split.groupBy("_file", "_start").agg(F.count(F.lit(1)).alias("_n"), F.min("_seen").alias("_first"))
    offsets = sizes.select("_file", "_start", "_first", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        split.join(offsets, ["_file", "_start"])
        .withColumn(name, (F.col("_offset") + F.col("_seen") - F.col("_first")).cast("long"))
        .drop("_file", "_start", "_seen", "_first", "_offset")
    )


def read_variant_info(spark: SparkSession, path: str, with_index: bool = False) -> DataFrame:
    """Headerless variant TSV of eight columns; alleles packed, columns prefixed ``variant_``."""
    df = spark.read.csv(path, sep="\t", header=False, schema=schema.VARIANT_INFO)
    if with_index:
        df = _row_index(df, "index")
    return with_prefix(pack_alleles(df), "variant_")


def read_sample_file(spark: SparkSession, path: str, with_index: bool = False) -> DataFrame:
    """Space-separated sample file: the name row is the header, the type row (sex ``D``) is dropped."""
    df = spark.read.csv(path, sep=" ", header=True, schema=schema.SAMPLE_FILE, enforceSchema=True)
    df = df.filter(~F.col("sex").eqNullSafe("D"))  # a sample without sex keeps its place
    if with_index:
        df = _row_index(df, "index")
    ids = [F.col("id1").cast("int").alias("id"), F.col("sex").cast("short").alias("sex")]
    return with_prefix(df.select(*ids, *(["index"] if with_index else [])), "sample_")


def read_probabilities(spark: SparkSession, path: str) -> DataFrame:
    """Genotype probabilities after decoding: one row per (variant, sample), a vector of three."""
    df = spark.read.parquet(path)
    return df.select("contig", "contig_name", "variant_index", "sample_index", "gp")


def read_calls(spark: SparkSession, path: str, unpack: bool = False) -> DataFrame:
    """Stored calls. ``unpack`` restores probabilities and dosage from the two one-byte codes.

    Columns named ``*_mask`` come back as booleans.
    """
    df = spark.read.parquet(path)
    masks = {c: F.col(c).cast("boolean") for c in df.columns if c.endswith("_mask")}
    df = df.withColumns(masks) if masks else df
    if not unpack:
        return df
    het, hom_alt = G.dequantise(F.col("gp_het")), G.dequantise(F.col("gp_hom_alt"))
    return df.select(
        *[c for c in df.columns if c not in ("gp_het", "gp_hom_alt")],
        G.unpack_probability(het, hom_alt).alias("gp"),
        G.dosage(het, hom_alt).alias("dosage"),
    )


def pack_calls(calls: DataFrame) -> DataFrame:
    """Drop the hom-ref probability and store the others as one-byte codes (lossy)."""
    return calls.select(
        *[c for c in calls.columns if c != "gp"],
        G.quantise(F.col("gp")[1]).alias("gp_het"),
        G.quantise(F.col("gp")[2]).alias("gp_hom_alt"),
    )


def expand_packed_calls(df: DataFrame, byte_column: str, n_samples_column: str | None = None) -> DataFrame:
    """Rows of packed two-bit calls to one row per call.

    ``byte_index`` in the input gives the position of the byte in its variant; four samples share
    a byte, so ``sample_index = 4 * byte_index + slot``.
    """
    keep = [c for c in df.columns if c not in (byte_column, "byte_index", n_samples_column)]
    limit = [n_samples_column] if n_samples_column else []
    calls = df.select(*keep, *limit, "byte_index", F.posexplode(G.packed_calls(F.col(byte_column))).alias("slot", "call"))
    calls = calls.withColumn("sample_index", (F.col("byte_index") * 4 + F.col("slot")).cast("long"))
    if n_samples_column:
        calls = calls.filter(F.col("sample_index") < F.col(n_samples_column))
    return calls.select(*keep, "sample_index", "call")


def read_hard_call_variants(spark: SparkSession, path: str, with_index: bool = False) -> DataFrame:
    """Six-column variant table of hard calls: contig name, id, position and both alleles; genetic distance is dropped."""
    declared = "contig_name string, id string, distance double, position int, allele_1 string, allele_2 string"
    df = spark.read.csv(path, sep="\t", header=False, schema=declared)
    if with_index:
        df = _row_index(df, "index")
    packed = F.array("allele_1", "allele_2").alias("allele")
    return with_prefix(df.select("contig_name", "id", "position", packed, *(["index"] if with_index else [])), "variant_")


def read_packed_calls(spark: SparkSession, path: str) -> DataFrame:
    """Bytes of packed two-bit calls: one row per (variant, byte of it)."""
    return spark.read.parquet(path).select("variant_index", "byte_index", "byte")


def read_hard_call_samples(spark: SparkSession, path: str, with_index: bool = False) -> DataFrame:
    """Six-column sample table of hard calls; family, parent and phenotype columns are dropped."""
    names = ["family_id", "sample_id", "paternal_id", "maternal_id", "sex", "phenotype"]
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    df = spark.read.csv(path, sep=" ", header=False, schema=text)
    if with_index:
        df = _row_index(df, "sample_index")
    ids = [F.col("sample_id").cast("int").alias("sample_id"), F.col("sex").cast("short").alias("sample_sex")]
    return df.select(*ids, *(["sample_index"] if with_index else []))
