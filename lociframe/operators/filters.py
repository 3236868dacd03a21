"""Quality-control filters with accounting, and membership filters."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lociframe.functions import genotype as G
from lociframe.functions import text as X
from lociframe.functions.pvalues import hwe_p_value

MIN_INFO = 0.8
MIN_MAF = 0.001
MIN_HWE_P = 1e-10
# Ethnic background codes kept by sample QC.
ETHNIC_GROUPS = [1001, 1002]


def _holds(condition: Column) -> Column:
    """An unknown condition counts as not met."""
    return F.coalesce(condition, F.lit(False))


def apply_filters(df: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """Rows that meet every named condition."""
    return df.filter(reduce(lambda a, b: a & b, [_holds(c) for c in filters.values()]))


def filter_report(df: DataFrame, filters: dict[str, Column]) -> DataFrame:
    """Kept and removed rows of each condition over the whole table, in one pass.

    With more than one condition a row ``overall`` counts the rows that meet all of them.
    """
    conditions = {name: _holds(c) for name, c in filters.items()}
    if len(filters) > 1:
        conditions["overall"] = reduce(lambda a, b: a & b, conditions.values())
    kept = [F.count_if(c).alias(f"k{i}") for i, c in enumerate(conditions.values())]
    totals = df.agg(F.count(F.lit(1)).alias("n"), *kept)
    rows = [
        F.struct(F.lit(name).alias("filter"), F.col(f"k{i}").alias("kept"), (F.col("n") - F.col(f"k{i}")).alias("removed"))
        for i, name in enumerate(conditions)
    ]
    return totals.select(F.inline(F.array(*rows)))


Tally = Callable[[], list[tuple[str, int, int]]]


def observed_filters(df: DataFrame, *steps: dict[str, Column]) -> tuple[DataFrame, Tally]:
    """Rows that meet all conditions, and a function that gives (filter, kept, removed) of each once they are written.

    The rows are counted while they pass, so the report costs no scan and no job. A step's conditions are counted among the
    rows that meet all earlier steps; a step of several has a last entry ``overall``, as in ``filter_report``.

    Write the rows as they are, in one action: its tasks count each of their partitions once, however often an executor is lost,
    whereas the tasks before a shuffle may run and count again.
    """
    counts, entries, met = [], [], F.lit(True)
    for step in steps:
        reached = met
        held = {name: reached & _holds(c) for name, c in step.items()}
        met = reduce(lambda a, b: a & b, held.values())
        if len(step) > 1:
            held["overall"] = met
        for name, condition in held.items():
            entries.append(name)
            counts += [F.count_if(reached).alias(f"n{len(entries)}"), F.count_if(condition).alias(f"k{len(entries)}")]
    watch = Observation()
    kept = df.observe(watch, *counts).filter(met)

    def tally() -> list[tuple[str, int, int]]:
        got = watch.get
        return [(name, got[f"k{i}"], got[f"n{i}"] - got[f"k{i}"]) for i, name in enumerate(entries, 1)]

    return kept, tally


def sample_qc_filters() -> dict[str, Column]:
    """The six sample conditions, on prefixed sample QC columns."""
    return {
        "no_aneuploidy": F.col("sample_sex_chromosome_aneuploidy").isNull(),
        "has_age": F.col("sample_age_at_recruitment").isNotNull(),
        "in_phasing_chromosome_x": F.col("sample_use_in_phasing_chromosome_x") == 1,
        "in_phasing_chromosomes_1_22": F.col("sample_use_in_phasing_chromosomes_1_22") == 1,
        "in_pca": F.col("sample_used_in_genetic_principal_components") == 1,
        "in_ethnic_groups": F.col("sample_ethnic_background").isin(ETHNIC_GROUPS),
    }


def sample_qc(samples: DataFrame) -> DataFrame:
    return apply_filters(samples, sample_qc_filters())


def variant_qc_1_filters(info: str = "info") -> dict[str, Column]:
    return {"high_info": F.col(info) > MIN_INFO}


def variant_qc_1(variants: DataFrame, info: str = "info") -> DataFrame:
    """Variants imputed with high information."""
    return apply_filters(variants, variant_qc_1_filters(info))


def info_threshold(variants: DataFrame, threshold: float | None, info: str = "info") -> DataFrame:
    """Variants above an optional information threshold."""
    return variants if threshold is None else variants.filter(F.col(info) > threshold)


def region(variants: DataFrame, bounds: tuple[int, int] | None) -> DataFrame:
    """Variants whose index lies in an optional half-open range."""
    if bounds is None:
        return variants
    return variants.filter((F.col("variant_index") >= bounds[0]) & (F.col("variant_index") < bounds[1]))


def genotype_counts(calls: DataFrame, keys: tuple[str, ...] = ("variant_index",), gp: str = "gp") -> DataFrame:
    """Calls per genotype and variant: het, hom_ref, hom_alt. Calls with a missing probability do not count."""
    called = calls.select(*keys, G.hard_call(F.col(gp)).alias("_g"))
    return called.groupBy(*keys).agg(
        F.count_if(F.col("_g") == 1).alias("n_het"),
        F.count_if(F.col("_g") == 0).alias("n_hom_ref"),
        F.count_if(F.col("_g") == 2).alias("n_hom_alt"),
    )


def sparse_genotype_counts(calls: DataFrame, n_samples: Column, keys: tuple[str, ...] = ("variant_index",)) -> DataFrame:
    """The same counts from non-reference hard calls only; all other samples are hom_ref."""
    seen = calls.groupBy(*keys).agg(
        F.count_if(F.col("dosage") == 1).alias("n_het"),
        F.count_if(F.col("dosage") == 2).alias("n_hom_alt"),
    )
    return seen.select(
        *keys, "n_het", (n_samples - F.col("n_het") - F.col("n_hom_alt")).alias("n_hom_ref"), "n_hom_alt"
    )


def with_hwe(counts: DataFrame, name: str = "hwe_p_value") -> DataFrame:
    return counts.withColumn(name, hwe_p_value("n_het", "n_hom_ref", "n_hom_alt"))


def frequency_filters() -> dict[str, Column]:
    return {"common": F.col("maf") > MIN_MAF}


def equilibrium_filters() -> dict[str, Column]:
    return {"in_equilibrium": F.col("hwe_p_value") > MIN_HWE_P}


def called_filters() -> dict[str, Column]:
    return {"has_calls": F.col("n_het").isNotNull()}


def with_common_tested(counted: DataFrame) -> DataFrame:
    """The exact test of variants in rows (maf, n_het, n_hom_ref, n_hom_alt); rare ones lose their counts and are spared it."""
    names = ("n_het", "n_hom_ref", "n_hom_alt")
    common = _holds(frequency_filters()["common"])
    return with_hwe(counted.withColumns({n: F.when(common, F.col(n)) for n in names}))


def counted_variants(variants: DataFrame, counts: DataFrame, keys: tuple[str, ...] = ("variant_index",)) -> DataFrame:
    """All variants, the common ones with their counts and exact test where they have calls."""
    return with_common_tested(variants.join(counts, list(keys), "left"))


def tested_variants(variants: DataFrame, counts: DataFrame, keys: tuple[str, ...] = ("variant_index",)) -> DataFrame:
    """Variants that are common enough, with their exact test; the rare ones are spared it."""
    return with_hwe(apply_filters(variants, frequency_filters()).join(counts, list(keys)))


def variant_qc_2(variants: DataFrame, counts: DataFrame, keys: tuple[str, ...] = ("variant_index",)) -> DataFrame:
    """Variants that are common enough and in Hardy-Weinberg equilibrium.

    The frequency is the supplied one and the counts cover all samples, so this comes before
    sample QC.
    """
    return apply_filters(tested_variants(variants, counts, keys), equilibrium_filters())


def keep_calls(calls: DataFrame, variants_kept: DataFrame, samples_kept: DataFrame, keys: tuple[str, ...] = ("variant_index",)) -> DataFrame:
    """Calls of kept variants and kept samples. Spark broadcasts a side only if its size allows."""
    in_variants = calls.join(variants_kept.select(*keys), list(keys), "left_semi")
    return in_variants.join(samples_kept.select("sample_id"), "sample_id", "left_semi")


def member_filter(df: DataFrame, column: str, values) -> DataFrame:
    """Rows whose value, as text, is one of ``values`` (comma text, sequence or one-column table); None keeps all."""
    if values is None:
        return df
    if isinstance(values, str):
        values = values.split(",")
    if isinstance(values, DataFrame):
        members = values.select(F.col(values.columns[0]).cast("string").alias("_member"))
        return df.join(members, F.col(column).cast("string") == F.col("_member"), "left_semi")
    if isinstance(values, Iterable):
        return df.filter(F.col(column).cast("string").isin([str(v) for v in values]))
    raise TypeError(f"cannot filter {column} by {type(values).__name__}")


def trait_group_members(spark: SparkSession, traits: DataFrame, trait_group_ids=None) -> DataFrame:
    """Trait groups to run: all distinct ones, those of a TSV file, or a given sequence."""
    if trait_group_ids is None:
        return traits.select(F.col("trait_group_id").cast("long").alias("trait_group_id")).distinct()
    if isinstance(trait_group_ids, str):
        listed = spark.read.csv(trait_group_ids, sep="\t", header=True, schema="trait_group_id long")
        return listed.select("trait_group_id")
    return spark.createDataFrame([(int(v),) for v in trait_group_ids], "trait_group_id long")


def mark_excluded(variable_list: DataFrame, terms: list[str] | None) -> DataFrame:
    """Exclude variables whose text has none of the terms; earlier exclusions stay. No terms, no change."""
    if not terms:
        return variable_list
    keep = F.col("EXCLUDED").isNotNull() | X.any_term(F.col("Field"), terms)
    return variable_list.withColumn("EXCLUDED", F.when(keep, F.col("EXCLUDED")).otherwise(F.lit("YES-NOT_IN_SUBSET")))


def flag_sample_set(df: DataFrame, flag: str) -> DataFrame:
    """Mark the listed samples as members; the table must be plate and well exactly."""
    df = df.withColumnRenamed("plate_name", "plate")
    if df.columns != ["plate", "well"]:
        raise ValueError(f"Expecting columns plate, well, found {df.columns}")
    return df.withColumn(flag, F.lit(True))


def column_profile(df: DataFrame) -> DataFrame:
    """Type and number of non-null values of every column, in one pass."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)])
    rows = [
        F.struct(F.lit(name).alias("column"), F.lit(kind).alias("type"), F.col(f"c{i}").alias("non_null"))
        for i, (name, kind) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*rows)))
