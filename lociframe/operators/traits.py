"""Trait names, batches, complete cases and sample alignment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.functions.text import batch_key
from lociframe.operators import checks
from lociframe.operators.reshape import number_rows
from lociframe.session import stage

BATCH_SIZE = 100
MIN_SAMPLES = 100


def name_traits(traits: DataFrame, dictionary: DataFrame, key: str = "trait_group_id") -> DataFrame:
    """Look the field name up; a field that is not in the dictionary gets NULL."""
    names = dictionary.select(F.col("FieldID").alias("_field"), F.col("Field").alias("trait_name"))
    return traits.join(names, F.col(key).cast("string") == F.col("_field"), "left").drop("_field")


def batch_traits(traits: DataFrame, batch_size: int = BATCH_SIZE, order_by: str = "trait_id") -> DataFrame:
    """Split the traits of each group into near-equal batches of at most ``batch_size``.

    A group of n traits has k = ceil(n / batch_size) batches; the first n mod k of them are larger
    by one. ``trait_index`` is the position in the batch, ``group_name`` the first name of the group.
    The result is written once, as most steps of a run use it.
    """
    named = "trait_name" in traits.columns
    first = [F.min_by("trait_name", order_by).alias("group_name")] if named else []
    numbered = number_rows(traits, "_r", [order_by], ["trait_group_id"])
    sizes = numbered.groupBy("trait_group_id").agg(F.count(F.lit(1)).alias("_n"), *first)
    split = sizes.withColumn("n_batches", F.ceil(F.col("_n") / batch_size).cast("int")).withColumns(
        {"_base": F.expr("_n div n_batches"), "_extra": F.expr("_n % n_batches")}
    )
    base, extra, r = F.col("_base"), F.col("_extra"), F.col("_r")
    large = extra * (base + 1)
    index = F.when(r < large, F.expr("_r div (_base + 1)")).otherwise(
        extra + F.expr("(_r - _extra * (_base + 1)) div _base")
    )
    batched = numbered.join(split, "trait_group_id").withColumn("batch_index", index.cast("int"))
    start = F.col("batch_index") * base + F.least(F.col("batch_index"), extra)
    batches = batched.select(
        *traits.columns,
        *(["group_name"] if named else []),
        "batch_index",
        (r - start).cast("int").alias("trait_index"),
        (base + F.when(F.col("batch_index") < extra, 1).otherwise(0)).cast("int").alias("batch_size"),
        "n_batches",
        batch_key(F.col("batch_index"), F.col("trait_group_id")).alias("batch_key"),
    )
    return stage(batches, "batches")


def first_trait_name(traits: DataFrame, order_by: str = "trait_id") -> DataFrame:
    """The name of the first trait of each group."""
    return traits.groupBy("trait_group_id").agg(F.min_by("trait_name", order_by).alias("trait_name"))


def _observed(trait_values: DataFrame) -> DataFrame:
    return trait_values.filter(F.col("value").isNotNull() & ~F.isnan("value"))


def complete_cases(trait_values: DataFrame, batches: DataFrame) -> DataFrame:
    """Samples with a value for every trait of a batch, with the batch's values as a vector.

    The vector is in trait_index order and never longer than the batch.
    """
    observed = _observed(trait_values)
    dims = batches.select("trait_id", "batch_key", "trait_index", "batch_size")
    return (
        observed.join(dims, "trait_id")
        .groupBy("batch_key", "sample_id")
        .agg(
            F.count(F.lit(1)).alias("_n"),
            F.max("batch_size").alias("_size"),
            F.array_sort(F.collect_list(F.struct("trait_index", "value"))).alias("_y"),
        )
        .filter("_n = _size")
        .select("batch_key", "sample_id", F.col("_y.value").alias("y"))
    )


def presence_bitmaps(trait_values: DataFrame, samples: DataFrame) -> DataFrame:
    """(trait_id, block, present): which samples have a value of the trait, 32,768 samples a bitmap of four kilobytes.

    ``samples`` gives each sample its ``sample_index``; values of others do not count, and neither does a second value of
    the same sample. Bits are set before the shuffle, which carries at most one bitmap per (trait, block) and task.
    """
    placed = _observed(trait_values).join(samples.select("sample_id", "sample_index"), "sample_id")
    bit = F.col("sample_index") + 1  # Spark's bitmaps number from one
    keyed = placed.select("trait_id", F.bitmap_bucket_number(bit).alias("block"), F.bitmap_bit_position(bit).alias("bit"))
    return keyed.groupBy("trait_id", "block").agg(F.bitmap_construct_agg("bit").alias("present"))


def complete_case_bitmaps(presence: DataFrame, batches: DataFrame) -> DataFrame:
    """(batch_key, block, complete): samples with a value for every trait of a batch, without a group over trait values.

    A trait without a bitmap of a block has no value there, so the batch has no complete case in it.
    """
    dims = batches.select("trait_id", "batch_key", "batch_size")
    met = presence.join(dims, "trait_id").groupBy("batch_key", "block").agg(
        F.count(F.lit(1)).alias("_n"), F.max("batch_size").alias("_size"), F.bitmap_and_agg("present").alias("complete")
    )
    return met.filter("_n = _size").select("batch_key", "block", "complete")


def bitmap_sample_sizes(complete: DataFrame) -> DataFrame:
    """Complete cases per batch; a batch without any has no row."""
    sizes = complete.groupBy("batch_key").agg(F.sum(F.bitmap_count("complete")).alias("sample_size"))
    return sizes.filter(F.col("sample_size") > 0)


def bitmap_samples(complete: DataFrame) -> DataFrame:
    """(batch_key, sample_index) of the complete cases: one row per set bit."""
    digits = complete.select("batch_key", "block", F.posexplode(F.split(F.hex("complete"), "")).alias("at", "digit"))
    # A byte is two digits, the higher bits first; digits of zero, which most of a sparse bitmap is, end here.
    first = (F.col("block") - 1) * 32768 + F.expr("at div 2") * 8 + F.when(F.col("at") % 2 == 0, 4).otherwise(0)
    some = digits.select("batch_key", first.alias("_first"), F.conv("digit", 16, 10).cast("int").alias("_four")).filter("_four > 0")
    bits = F.array_compact(F.array(*[F.when(F.col("_four").bitwiseAND(F.lit(1 << i)) > 0, F.lit(i)) for i in range(4)]))
    each = some.select("batch_key", "_first", F.explode(bits).alias("_bit"))
    return each.select("batch_key", (F.col("_first") + F.col("_bit")).cast("long").alias("sample_index"))


def sample_sizes(cases: DataFrame) -> DataFrame:
    """Complete cases per batch."""
    return cases.groupBy("batch_key").agg(F.count(F.lit(1)).alias("sample_size"))


def gate_batches(cases: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """Batches with enough complete cases."""
    return sample_sizes(cases).filter(F.col("sample_size") >= min_samples)


def batch_report(batches: DataFrame, sizes: DataFrame, min_samples: int = MIN_SAMPLES) -> DataFrame:
    """Every batch with its complete cases (``sizes``: batch_key, sample_size) and whether they were enough to run."""
    listed = batches.select("batch_key", "trait_group_id", "batch_index", "batch_size").distinct()
    size = F.coalesce("sample_size", F.lit(0)).cast("long")
    counted = listed.join(sizes.select("batch_key", "sample_size"), "batch_key", "left").withColumn("sample_size", size)
    return counted.withColumn("ran", F.col("sample_size") >= min_samples)


def add_traits(samples: DataFrame, traits: DataFrame) -> DataFrame:
    """Left join of trait columns onto samples; a column of both keeps the sample's value."""
    extra = [c for c in traits.columns if c == "sample_id" or c not in samples.columns]
    return samples.join(traits.select(*extra), "sample_id", "left")


def add_sample_qc(calls: DataFrame, samples: DataFrame) -> DataFrame:
    """Inner join of QC'd samples onto genotype rows; a column of both keeps the genotype's value."""
    extra = [c for c in samples.columns if c == "sample_id" or c not in calls.columns]
    return calls.join(samples.select(*extra), "sample_id")


def order_as_genotypes(trait_values: DataFrame, genotype_samples: DataFrame, check: bool = True) -> DataFrame:
    """Trait rows with the genotype sample index, sorted by it inside partitions.

    A genotype sample without trait rows is an error.
    """
    if check:
        missing = checks.find_uncovered_samples(genotype_samples, trait_values)
        checks.require_none(missing, "genotype samples without trait rows")
    placed = trait_values.join(genotype_samples.select("sample_id", "sample_index"), "sample_id")
    return placed.repartitionByRange("sample_index").sortWithinPartitions("sample_index", "trait_id")


def pending_work(work: DataFrame, done: DataFrame) -> DataFrame:
    """(contig, batch, trait group) whose result does not exist yet."""
    keys = ["contig", "batch_index", "trait_group_id"]
    return work.join(done.select(*keys).distinct(), keys, "left_anti")


def missing_groups(wanted: DataFrame, traits: DataFrame) -> DataFrame:
    """Wanted trait groups that the data does not have."""
    return wanted.select("trait_group_id").join(traits.select("trait_group_id").distinct(), "trait_group_id", "left_anti")


def common_groups(ours: DataFrame, published: DataFrame) -> DataFrame:
    """Distinct trait groups on both sides."""
    return ours.select("trait_group_id").intersect(published.select("trait_group_id"))


def field_ids(trait_ids: DataFrame) -> DataFrame:
    """Distinct numeric prefixes of trait ids; others are skipped."""
    number = F.substring_index("trait_id", "_", 1).try_cast("int")
    return trait_ids.select(number.alias("field_id")).filter(F.col("field_id").isNotNull()).distinct()
