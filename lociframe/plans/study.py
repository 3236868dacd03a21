"""A study from files to files: each function is one step and writes its result.

The steps share a few stored tables. A genotype folder holds ``variants``, ``samples`` and
``calls`` (one binary per variant and sample block), after a QC step also its ``report``; a phenotype folder holds ``traits`` and ``values``.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe import schema
from lociframe.operators import blocks, checks, filters, layout, regression, reshape, sumstats, traits
from lociframe.session import stage
from lociframe.sources import genotypes, participants, sinks
from lociframe.sources import sumstats as files
from lociframe.streaming import incremental

# Participants -----------------------------------------------------------------------------------

TEXT_QC = ("genotype_measurement_batch", "genotype_measurement_plate", "genotype_measurement_well")


def convert_participants(spark: SparkSession, csv_path: str, output_path: str) -> None:
    """Wide participant CSV to Parquet."""
    sinks.write_table(participants.read_participants(spark, csv_path), output_path)


def extract_sample_qc(spark: SparkSession, participants_path: str, output_path: str) -> None:
    """The sample QC fields as a TSV."""
    qc = reshape.extract_sample_qc(spark.read.parquet(participants_path))
    sinks.write_tsv(qc, output_path, mode="overwrite")


def pack_sample_qc(spark: SparkSession, tsv_path: str, output_path: str) -> None:
    """Sample QC as numbers, principal components packed into a vector."""
    names = list(schema.SAMPLE_QC_FIELDS.values())
    kinds = {"eid": "long", **dict.fromkeys(TEXT_QC, "string")}
    declared = ", ".join(f"{n} {kinds.get(n, 'double')}" for n in names)
    qc = spark.read.csv(tsv_path, sep="\t", header=True, schema=declared)
    sinks.write_table(reshape.pack_principal_components(qc), output_path)


def read_sample_qc(spark: SparkSession, path: str) -> DataFrame:
    return reshape.prefix_sample_qc(spark.read.parquet(path))


# Genotypes --------------------------------------------------------------------------------------


def _read_genotypes(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    calls = spark.read.parquet(f"{path}/calls").withColumn("contig", F.col("contig").cast("string"))
    return spark.read.parquet(f"{path}/variants"), spark.read.parquet(f"{path}/samples"), calls


def _write_genotypes(path: str, variants: DataFrame, samples: DataFrame, calls: DataFrame) -> None:
    sinks.write_table(variants, f"{path}/variants")
    sinks.write_table(samples, f"{path}/samples")
    sinks.write_calls(calls, f"{path}/calls")


def integrate_genotypes(
    spark: SparkSession,
    probabilities_path: str,
    variants_path: str,
    samples_path: str,
    output_path: str,
    contig: str,
    region: tuple[int, int] | None = None,
    min_info: float | None = None,
) -> None:
    """Decoded probabilities, variant info and sample file of one contig to a genotype folder.

    Positions in the variant and sample files are the indices of the probabilities. The contig
    given replaces the file's own, which stays as ``variant_contig_name``.
    """
    index = {row[2]: int(row[0]) for row in schema.contig_rows()}[contig]
    probabilities = genotypes.read_probabilities(spark, probabilities_path)
    info = genotypes.read_variant_info(spark, variants_path, with_index=True)
    info = filters.info_threshold(filters.region(info, region), min_info, "variant_info")
    probabilities = filters.region(probabilities, region).withColumn("contig", F.lit(contig))
    packed = blocks.pack_codes(probabilities, with_variant=("contig_name",))
    sinks.write_calls(packed.join(info.select("variant_index"), "variant_index", "left_semi"), f"{output_path}/calls")
    # The name lies with the blocks, a few rows per variant.
    names = spark.read.parquet(f"{output_path}/calls").groupBy("variant_index").agg(F.min("contig_name").alias("variant_contig_name"))
    variants = info.join(names, "variant_index").withColumns({"variant_contig": F.lit(index), "contig": F.lit(contig)})
    sinks.write_table(variants, f"{output_path}/variants")
    sinks.write_table(genotypes.read_sample_file(spark, samples_path, with_index=True), f"{output_path}/samples")


def convert_hard_calls(spark: SparkSession, packed_path: str, variants_path: str, samples_path: str, output_path: str, contig: str) -> None:
    """Packed two-bit calls, variant table and sample table of one contig to a genotype folder; the calls stay packed.

    Positions in the variant and sample tables are the indices of the calls. The contig given replaces the file's own,
    which stays as ``variant_contig_name``.
    """
    index = {row[2]: int(row[0]) for row in schema.contig_rows(imputed=False)}[contig]
    variants = genotypes.read_hard_call_variants(spark, variants_path, with_index=True)
    variants = variants.withColumns({"variant_contig": F.lit(index), "contig": F.lit(contig)})
    samples = genotypes.read_hard_call_samples(spark, samples_path, with_index=True)
    packed = genotypes.read_packed_calls(spark, packed_path).withColumn("contig", F.lit(contig))
    _write_genotypes(output_path, variants, samples, blocks.pack_hard_calls(packed))


def run_hard_call_qc(spark: SparkSession, input_path: str, output_path: str) -> None:
    """Keep variants of a hard-call folder that are common enough and in equilibrium, by counts of the packed calls.

    The frequency is that of the rarer allele among called samples. The folder's ``report`` counts what each filter removes.
    """
    variants, samples, calls = _read_genotypes(spark, input_path)
    keys = ("contig", "variant_index")
    counts = blocks.count_hard_calls(calls, samples.count(), keys)
    called = F.col("n_het") + F.col("n_hom_ref") + F.col("n_hom_alt")
    share = F.try_divide(F.col("n_het") + 2 * F.col("n_hom_alt"), 2 * called)
    with_maf = variants.join(counts.drop("n_missing"), list(keys)).withColumn("maf", F.least(share, 1 - share))
    tested = filters.with_common_tested(with_maf)
    kept, tally = filters.observed_filters(tested, filters.frequency_filters(), filters.equilibrium_filters())
    kept = kept.drop("n_het", "n_hom_ref", "n_hom_alt").withColumnsRenamed({"hwe_p_value": "variant_hwe_p_value", "maf": "variant_maf"})
    sinks.write_table(kept, f"{output_path}/variants")
    left = spark.read.parquet(f"{output_path}/variants").select(*keys)
    sinks.write_table(samples, f"{output_path}/samples")
    sinks.write_calls(calls.join(left, list(keys), "left_semi"), f"{output_path}/calls")
    _write_report(spark, output_path, [("variants", tally)])


def integrate_hard_calls(packed: DataFrame, samples: DataFrame, n_samples: int) -> DataFrame:
    """Packed two-bit calls (contig, variant_index, byte_index, byte) as rows with sample ids."""
    calls = genotypes.expand_packed_calls(packed.withColumn("_n", F.lit(n_samples)), "byte", "_n")
    return calls.join(samples.select("sample_index", "sample_id"), "sample_index")


def _write_report(spark: SparkSession, path: str, tallies: list[tuple[str, filters.Tally]]) -> None:
    """Rows that each filter of a step kept and removed, counted while they were written, as the table ``report`` of its folder."""
    rows = [(name, *entry) for name, tally in tallies for entry in tally()]
    listed = spark.createDataFrame(rows, "`table` string, filter string, kept long, removed long")
    sinks.write_table(listed.coalesce(1), f"{path}/report")


def run_qc_1(spark: SparkSession, input_path: str, output_path: str) -> None:
    """Keep variants imputed with high information; the folder's ``report`` counts them."""
    variants, samples, calls = _read_genotypes(spark, input_path)
    kept, tally = filters.observed_filters(variants, filters.variant_qc_1_filters("variant_info"))
    sinks.write_table(kept, f"{output_path}/variants")
    sinks.write_table(samples, f"{output_path}/samples")
    left = spark.read.parquet(f"{output_path}/variants").select("contig", "variant_index")
    sinks.write_calls(calls.join(left, ["contig", "variant_index"], "left_semi"), f"{output_path}/calls")
    _write_report(spark, output_path, [("variants", tally)])


def run_qc_2(spark: SparkSession, input_path: str, sample_qc_path: str, output_path: str) -> None:
    """Variant QC on all samples, then sample QC; the calls of what is left are laid out for the association.

    The layout shuffles the blocks once here, and no association run shuffles them again. The folder's ``report`` counts what
    each filter keeps and removes: of all variants, of the common ones, of those with calls, and of the QC table's samples.
    """
    variants, samples, calls = _read_genotypes(spark, input_path)
    keys = ("contig", "variant_index")
    counted = filters.counted_variants(variants.withColumn("maf", F.col("variant_maf")), blocks.count_codes(calls, keys), keys)
    steps = filters.frequency_filters(), filters.called_filters(), filters.equilibrium_filters()
    kept, of_variants = filters.observed_filters(counted, *steps)
    kept = kept.drop("maf", "n_het", "n_hom_ref", "n_hom_alt").withColumnRenamed("hwe_p_value", "variant_hwe_p_value")
    sinks.write_table(kept, f"{output_path}/variants")
    passed, of_samples = filters.observed_filters(read_sample_qc(spark, sample_qc_path), filters.sample_qc_filters())
    passed = stage(passed.select(*schema.SAMPLE_QC_KEEP), "passed")
    sinks.write_table(traits.add_sample_qc(samples, passed), f"{output_path}/samples")
    left = spark.read.parquet(f"{output_path}/variants").select(*keys)
    of_kept = calls.join(left, list(keys), "left_semi")
    stored = spark.read.parquet(f"{output_path}/samples").select("sample_index")
    layout.write_layout(blocks.keep_samples(of_kept, stored), f"{output_path}/calls", left.count())
    _write_report(spark, output_path, [("variants", of_variants), ("samples", of_samples)])


# Phenotypes -------------------------------------------------------------------------------------


def extract_sample_ids(spark: SparkSession, genotypes_path: str, output_path: str) -> None:
    """Distinct sample ids of a genotype folder as a TSV."""
    sinks.write_tsv(spark.read.parquet(f"{genotypes_path}/samples").select("sample_id").distinct(), output_path, mode="overwrite")


def filter_phenotypes(spark: SparkSession, input_path: str, sample_id_path: str, output_path: str, report_path: str | None = None) -> None:
    """Rows of the phenotype TSV whose participant is listed; fields stay the text they are.

    With a ``report_path``, its table ``report`` counts the rows kept and removed.
    """
    rows = participants.read_text_table(spark, input_path, int_columns=("userId",))
    listed = participants.read_sample_ids(spark, sample_id_path).select(F.col("sample_id").alias("userId"), F.lit(True).alias("_listed"))
    kept, tally = filters.observed_filters(rows.join(listed, "userId", "left"), {"in_genotype_samples": F.col("_listed")})
    sinks.write_tsv(kept.select(*[F.col(f"`{c}`") for c in rows.columns]), output_path, mode="overwrite")
    if report_path:
        _write_report(spark, report_path, [("phenotypes", tally)])


def convert_phenotypes(spark: SparkSession, input_path: str, output_path: str) -> None:
    """Normalised phenotype TSV to Parquet, types inferred."""
    sinks.write_table(participants.read_typed_table(spark, input_path), output_path)


def store_traits(spark: SparkSession, phenotypes_path: str, dictionary_path: str, genotypes_path: str, output_path: str) -> None:
    """Phenotypes as trait and value tables in genotype sample order.

    Every column that starts with a digit is a trait. A genotype sample without phenotypes is an error.
    """
    wide = spark.read.parquet(phenotypes_path)
    names = [c for c in wide.columns if re.match(r"^\d+", c)]
    listed = spark.createDataFrame([(n, i) for i, n in enumerate(names)], "trait_id string, trait_position int")
    described = reshape.describe_traits(listed).join(listed, "trait_id")
    named = traits.name_traits(described, participants.read_dictionary(spark, dictionary_path))
    values = reshape.unpivot_traits(wide)
    placed = traits.order_as_genotypes(values, spark.read.parquet(f"{genotypes_path}/samples"))
    sinks.write_table(named, f"{output_path}/traits")
    sinks.write_table(placed, f"{output_path}/values")


def extract_trait_groups(spark: SparkSession, phenotypes_path: str, published_path: str, output_path: str) -> None:
    """Trait groups that we and the published results have, as a TSV."""
    published = files.published_trait_groups(files.list_files(spark, published_path))
    ours = spark.read.parquet(f"{phenotypes_path}/traits")
    sinks.write_tsv(traits.common_groups(ours, published).orderBy("trait_group_id"), output_path, mode="overwrite")


# Association ------------------------------------------------------------------------------------


def run_association(
    spark: SparkSession,
    genotypes_path: str,
    phenotypes_path: str,
    results_path: str,
    variables_path: str | None = None,
    batch_size: int = traits.BATCH_SIZE,
    trait_group_ids: Sequence[int | str] | str | None = None,
    min_samples: int = traits.MIN_SAMPLES,
    npc: int = regression.N_COMPONENTS,
    report_path: str | None = None,
) -> DataFrame:
    """All variants against all wanted trait groups; returns the (contig, batch, group) computed.

    Batches that an earlier run finished are skipped, also those that had too few complete cases for the same
    ``min_samples``. Wanted groups that the data lacks are left out. With a
    ``report_path``, these are listed in its table ``missing_groups``, and the batches of this run in ``batches``,
    each with its complete cases and whether they were enough.
    """
    variants, samples = spark.read.parquet(f"{genotypes_path}/variants"), spark.read.parquet(f"{genotypes_path}/samples")
    calls = layout.read_layout(spark, f"{genotypes_path}/calls")
    listed = spark.read.parquet(f"{phenotypes_path}/traits")
    values = spark.read.parquet(f"{phenotypes_path}/values").select("sample_id", "trait_id", "value")

    people = samples.select(
        "sample_id",
        "sample_index",
        F.col("sample_age_at_recruitment").alias("age_at_recruitment"),
        F.col("sample_genetic_sex").alias("genetic_sex"),
        F.col("sample_principal_component").alias("principal_component"),
    )
    raw = regression.covariate_vector(people, npc)
    checks.require_finite_vector(raw, "covariate")
    covariates = stage(regression.standardise(raw, 5 + npc), "covariates")
    checks.require_finite_vector(covariates, "covariate")

    wanted = filters.trait_group_members(spark, listed, trait_group_ids)
    batches = traits.batch_traits(listed.join(wanted, "trait_group_id", "left_semi"), batch_size, "trait_position")
    mixed = checks.find_mixed_batches(batches.withColumn("trait_name", F.coalesce("trait_name", F.lit(""))))
    checks.require_none(mixed, "batches must have one trait group and name")
    contigs = [r[0] for r in variants.select("contig").distinct().collect()]  # 26 at most
    work = batches.select(F.explode(F.array(*[F.lit(c) for c in contigs])).alias("contig"), "batch_index", "trait_group_id").distinct()

    trait_columns = [
        "trait_id",
        F.col("trait_id").alias("sample_trait_id"),
        F.col("group_name").alias("sample_trait_name"),
        F.col("trait_group_id").alias("sample_trait_group_id"),
        F.col("trait_code_id").alias("sample_trait_code_id"),
    ]
    variant_columns = ["contig", "variant_index", "variant_id", "variant_contig", "variant_contig_name", "variant_position"]

    if report_path:
        sinks.write_table(traits.missing_groups(wanted, listed), f"{report_path}/missing_groups")
    def compute(todo: DataFrame) -> DataFrame:
        pending = batches.join(todo.select("batch_index", "trait_group_id").distinct(), ["batch_index", "trait_group_id"], "left_semi")
        # Batches with too few complete cases end here: their values are counted as bits, not put together by sample.
        presence = traits.presence_bitmaps(values.join(pending.select("trait_id"), "trait_id", "left_semi"), covariates)
        cases = stage(traits.bitmap_sample_sizes(traits.complete_case_bitmaps(presence, pending)), "cases")
        if report_path:
            sinks.write_table(traits.batch_report(pending, cases, min_samples), f"{report_path}/batches")
        pending = pending.join(cases.filter(F.col("sample_size") >= min_samples), "batch_key", "left_semi")
        # A filter, unlike a join, keeps the calls in their buckets; there are 26 contigs at most.
        todo_calls = calls.where(F.col("contig").isin([r[0] for r in todo.select("contig").distinct().collect()]))
        people = covariates.select("sample_id", "sample_index", "covariate")
        # Most groups have one trait; batches of like size run together, so that none carries empty columns.
        sizes = sorted({1, min(10, batch_size), batch_size})
        size = F.when(F.col("batch_size") <= sizes[0], sizes[0])
        for larger in sizes[1:]:
            size = size.when(F.col("batch_size") <= larger, larger)
        pending = pending.withColumn("_size", size)
        parts = [
            regression.associate(
                todo_calls,
                people,
                values,
                pending.filter(F.col("_size") == n),
                regression.Shape(5 + npc, n),
                min_samples,
                variants=variants.select(*variant_columns),
                described=batches.select(*trait_columns),
                only=todo,  # a genotype folder has several contigs only if stored so; each may have its own finished batches
                together=sinks.RESULT_PARTITIONS,
            )
            for n in [r[0] for r in pending.select("_size").distinct().collect()] or sizes[:1]  # three at most
        ]
        fitted = reduce(DataFrame.unionByName, parts)
        return fitted.withColumnsRenamed({"p_value": "variant_p_value", "beta": "variant_beta"}).drop("trait_id")

    done = incremental.run_pending(spark, work, results_path, compute, settings=f"min_samples={min_samples}", placed=True)
    if variables_path:
        sample_values = values.join(listed, "trait_id").select(
            "sample_id",
            F.col("value").alias("sample_trait"),
            *[F.col(c).alias(f"sample_{c}") for c in ("trait_id", "trait_group_id", "trait_code_id", "trait_name")],
        )
        kept = samples.join(covariates.select("sample_id", F.col("covariate").alias("sample_covariate")), "sample_id")
        sinks.write_snapshot(variants, kept, sample_values, variables_path)
    return done


def merge_sumstats(
    spark: SparkSession,
    results_path: str,
    published_path: str,
    output_path: str,
    contigs: Sequence[str] | str | None = None,
    trait_group_ids: Sequence[str] | str | None = None,
) -> None:
    """Own and published results side by side, for the given contigs and trait groups or all of ours.

    Contig and group are folders of the stored results, so the filters skip files.
    """
    stored = spark.read.parquet(results_path)
    stored = filters.member_filter(filters.member_filter(stored, "contig", contigs), "trait_group_id", trait_group_ids)
    own = sumstats.own_result_columns(stored)
    groups = stored.select(F.col("trait_group_id").cast("string")).distinct()
    wanted = files.published_manifest(files.list_files(spark, published_path)).join(groups, "trait_group_id", "left_semi")
    published = files.read_published(spark, published_path, wanted)
    members = contigs if contigs is not None else stored.select("contig").distinct()
    published = filters.member_filter(published, "contig", members)
    # The check for repeated keys and the join both need the text files, which are read and parsed once.
    published = stage(sumstats.comparable(published, own), "published")
    sinks.write_table(sumstats.merge_results(own, published), output_path)


# Small tables -----------------------------------------------------------------------------------


def mark_variables(spark: SparkSession, input_path: str, output_path: str, term_set: str | None = "basic") -> None:
    """Exclude variables without any of the set's keywords from a variable list TSV."""
    listed = spark.read.csv(input_path, sep="\t", header=True)
    terms = schema.TERM_SETS[term_set] if term_set else None
    sinks.write_tsv(filters.mark_excluded(listed, terms), output_path, mode="overwrite")


def convert_sample_set(spark: SparkSession, input_path: str, output_path: str) -> None:
    """Plate and well list with a membership flag."""
    listed = spark.read.csv(input_path, sep="\t", header=True)
    sinks.write_tsv(filters.flag_sample_set(listed, "in_european_samples"), output_path, mode="overwrite")


def convert_json(spark: SparkSession, input_path: str, output_path: str, n_partitions: int) -> None:
    """JSON lines to Parquet; fails if the output exists."""
    sinks.write_repartitioned(participants.read_json(spark, input_path), output_path, n_partitions)


def export_field_ids(spark: SparkSession, phenotypes_path: str, output_path: str) -> None:
    """Numeric field ids of the stored traits."""
    listed = traits.field_ids(spark.read.parquet(f"{phenotypes_path}/traits").select("trait_id"))
    sinks.write_tsv(listed.withColumnRenamed("field_id", "ukb_field_id"), output_path, mode="overwrite")


