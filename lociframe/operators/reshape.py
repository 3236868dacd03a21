"""Projections and reshaping."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociframe import schema
from lociframe.functions import text as X
from lociframe.session import stage


def with_prefix(df: DataFrame, prefix: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Add a prefix to every column name but those in ``keep``."""
    return df.toDF(*[c if c in keep else prefix + c for c in df.columns])


def without_text(df: DataFrame, text: str) -> DataFrame:
    """Remove a piece of text from every column name."""
    return df.toDF(*[c.replace(text, "") for c in df.columns])


def sorted_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in sorted(df.columns)])


def extract_sample_qc(participants: DataFrame) -> DataFrame:
    """The 64 sample QC fields of the participant table under their readable names."""
    return participants.select(*[F.col(k).alias(v) for k, v in schema.SAMPLE_QC_FIELDS.items()])


def pack_matching(df: DataFrame, pattern: str, name: str) -> DataFrame:
    """Scalar columns whose names match, in name order, as one vector; the scalars go."""
    parts = sorted(c for c in df.columns if re.search(pattern, c))
    rest = [c for c in df.columns if c not in parts]
    return df.select(*rest, F.array(*[F.col(c).cast("double") for c in parts]).alias(name))


def pack_principal_components(sample_qc: DataFrame) -> DataFrame:
    return pack_matching(sample_qc, "^genetic_principal_component", "principal_component")


def prefix_sample_qc(sample_qc: DataFrame) -> DataFrame:
    """``eid`` becomes ``id``, all columns get ``sample_``; ``sex`` must not meet the genotype file's sex."""
    renames = {"eid": "id", "sex": "qc_sex"}
    return df_alias(sample_qc, lambda c: "sample_" + renames.get(c, c))


def df_alias(df: DataFrame, rename) -> DataFrame:
    return df.toDF(*[rename(c) for c in df.columns])


def pack_alleles(df: DataFrame) -> DataFrame:
    """Reference and alternate allele as a pair."""
    rest = [c for c in df.columns if c not in ("allele1_ref", "allele2_alt")]
    return df.select(*rest, F.array("allele1_ref", "allele2_alt").alias("allele"))


def unpivot_traits(wide: DataFrame, id_column: str = "userId") -> DataFrame:
    """Trait columns (names that start with a digit) to one row per (sample, trait)."""
    traits = [c for c in wide.columns if re.match(r"^\d+", c)]
    typed = wide.select(F.col(id_column).cast("long").alias("sample_id"), *[F.col(f"`{c}`").cast("double").alias(c) for c in traits])
    return typed.unpivot("sample_id", [F.col(f"`{c}`") for c in traits], "trait_id", "value")


def trait_matrix(wide: DataFrame, id_column: str = "userId") -> DataFrame:
    """Trait columns as one vector per sample, in column order."""
    traits = [c for c in wide.columns if re.match(r"^\d+", c)]
    return wide.select(
        F.col(id_column).cast("long").alias("sample_id"),
        F.array(*[F.col(f"`{c}`").cast("double") for c in traits]).alias("trait"),
    )


def describe_traits(trait_ids: DataFrame) -> DataFrame:
    """Group and code of each trait id."""
    c = F.col("trait_id")
    return trait_ids.select(
        "trait_id", X.id_group(c).try_cast("long").alias("trait_group_id"), X.id_code(c).alias("trait_code_id")
    )


def contig_columns(df: DataFrame, contig_names: list[str], contig_index: int) -> DataFrame:
    """Keep the file's own contig as a name, then set the contig to the one of the file."""
    names = F.array(*[F.lit(n) for n in contig_names])
    return df.withColumns(
        {
            "contig_name": F.element_at(names, (F.col("contig") + 1).cast("int")),
            "contig": F.lit(contig_index),
        }
    )


def number_rows(df: DataFrame, name: str, order_by: list[str], within: list[str] | None = None) -> DataFrame:
    """0-based position of each row in its group, for groups of any size.

    The table is range-partitioned, so a large group is spread over many tasks, and written once
    with the position of every row in its partition. A group's position is that of its first row
    in the partition taken away, plus the sizes of its earlier partitions; only this short list
    (groups x partitions they touch) is ordered by group.
    """
    within = within or []
    ranged = df.repartitionByRange(*within, *order_by).sortWithinPartitions(*within, *order_by)
    seen = F.monotonically_increasing_id()
    slots = F.lit(1 << 33)  # the id is the partition number times 2^33 plus the row's place in the partition
    placed = stage(ranged.withColumns({"_part": F.floor(seen / slots).cast("long"), "_at": seen % slots}), "numbered")
    pieces = placed.groupBy(*within, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*within).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    shift = (F.coalesce(F.sum("_n").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    keys = [f"_k{i}" for i in range(len(within))]
    shifts = pieces.select(*[F.col(c).alias(k) for c, k in zip(within, keys)], F.col("_part").alias("_piece"), shift)
    same = F.col("_part") == F.col("_piece")
    for c, k in zip(within, keys):
        same &= F.col(c).eqNullSafe(F.col(k))
    position = (F.col("_at") + F.col("_shift")).cast("long").alias(name)
    return placed.join(shifts, same).select(*df.columns, position)


def array_items(c: Column, n: int) -> list[Column]:
    """The first ``n`` elements of a vector as separate expressions."""
    return [F.get(c, F.lit(i)) for i in range(n)]


def merge_positions(calls: DataFrame, variants: DataFrame, samples: DataFrame) -> DataFrame:
    """Variant and sample attributes onto calls by their stored positions."""
    return calls.join(variants, "variant_index").join(samples, "sample_index")


def explode_vector(df: DataFrame, vector: str, position: str, value: str) -> DataFrame:
    """One row per vector element with its 0-based position."""
    rest = [c for c in df.columns if c != vector]
    return df.select(*rest, F.posexplode(vector).alias(position, value))
