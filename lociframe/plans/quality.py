"""Queries over sample and variant quality control and data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.functions import text as X
from lociframe.operators import blocks, checks, filters, regression, reshape, traits, zones
from lociframe.plans import domain as D
from lociframe.plans import study
from lociframe.plans.registry import query, rounded, table
from lociframe.session import shared_path, stage
from lociframe.sources import sinks
from lociframe.sources.participants import drop_missing_id


@query(f"WITH {D.DENSE_GP_SQL} SELECT * FROM counts")
def genotype_counts(spark: SparkSession, d: str) -> DataFrame:
    return filters.genotype_counts(D.dense_probabilities(spark, d))


_CODES = "round_even({p} * 254, 0)"


@query(
    f"""WITH {D.DENSE_GP_SQL}, codes AS (
  SELECT variant_index, {_CODES.format(p='p1')} AS a, {_CODES.format(p='p2')} AS b, 254 - a - b AS r FROM gp)
SELECT variant_index, count(*) FILTER (r < greatest(a, b) AND a >= b) AS n_het, count(*) FILTER (r >= greatest(a, b)) AS n_hom_ref,
  count(*) FILTER (r < greatest(a, b) AND a < b) AS n_hom_alt FROM codes GROUP BY variant_index"""
)
def block_counts(spark: SparkSession, d: str) -> DataFrame:
    """Genotypes counted from one-byte codes packed by sample block, written and read back."""
    packed = blocks.pack_codes(D.dense_probabilities(spark, d).withColumn("contig", F.lit("1")), width=64)
    return blocks.count_codes(stage(packed, "blocks"), ("variant_index",))


@query(
    """WITH bytes AS (SELECT l_orderkey AS variant_index, l_linenumber % 7 AS place, max(5 * CAST(l_quantity AS INT) + l_linenumber) & 255 AS byte
  FROM lineitem GROUP BY ALL),
calls AS (SELECT variant_index, (byte >> CAST(2 * slot AS INT)) & 3 AS code FROM bytes, (SELECT range AS slot FROM range(4)) WHERE 4 * place + slot < 27)
SELECT variant_index, count(*) FILTER (code = 2) AS n_het, count(*) FILTER (code = 0) AS n_hom_ref, count(*) FILTER (code = 3) AS n_hom_alt,
  27 - count(*) FILTER (code <> 1) AS n_missing FROM calls GROUP BY variant_index"""
)
def hard_call_counts(spark: SparkSession, d: str) -> DataFrame:
    """Genotypes counted by bit planes from packed two-bit calls of 27 samples; bytes that are not there are missing calls."""
    bytes_ = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("variant_index"), (F.col("l_linenumber") % 7).cast("long").alias("byte_index"))
    packed = bytes_.agg(F.max(5 * F.col("l_quantity").cast("int") + F.col("l_linenumber")).bitwiseAND(F.lit(255)).alias("byte"))
    calls = blocks.pack_hard_calls(packed.withColumn("contig", F.lit("1")), width=16)
    return blocks.count_hard_calls(calls, 27, ("variant_index",), width=16)


_P = "round(p, 8) + 0.0 AS hwe_p_value, round(-log10(p), 6) + 0.0 AS neg_log10_p"


def _p_columns() -> list:
    return [rounded("hwe_p_value", 8).alias("hwe_p_value"), rounded(X.neg_log10(F.col("hwe_p_value"))).alias("neg_log10_p")]


@query(f"WITH {D.DENSE_GP_SQL}, {D.HWE_SQL} SELECT variant_index, n_het, n_hom_ref, n_hom_alt, {_P} FROM hwe")
def hwe_exact(spark: SparkSession, d: str) -> DataFrame:
    tested = filters.with_hwe(filters.genotype_counts(D.dense_probabilities(spark, d)))
    return tested.select("variant_index", "n_het", "n_hom_ref", "n_hom_alt", *_p_columns())


def _sparse_counts(spark: SparkSession, d: str) -> DataFrame:
    n_samples = table(spark, d, "customer").agg(F.count(F.lit(1))).scalar()
    return filters.sparse_genotype_counts(D.sparse_dosages(spark, d), n_samples)


@query(f"WITH {D.SPARSE_SQL}, {D.SPARSE_COUNTS_SQL}, {D.HWE_SQL} SELECT variant_index, n_het, n_hom_ref, n_hom_alt, {_P} FROM hwe")
def hwe_sparse(spark: SparkSession, d: str) -> DataFrame:
    tested = filters.with_hwe(_sparse_counts(spark, d))
    return tested.select("variant_index", "n_het", "n_hom_ref", "n_hom_alt", *_p_columns())


@query(f"WITH {D.VARIANTS_SQL} SELECT variant_index, variant_id, info FROM variants WHERE info > 0.8")
def variant_qc_1(spark: SparkSession, d: str) -> DataFrame:
    return filters.variant_qc_1(D.variants(spark, d)).select("variant_index", "variant_id", "info")


@query(
    f"""WITH {D.VARIANTS_SQL}, {D.DENSE_GP_SQL}, {D.HWE_SQL}
SELECT variant_index, variant_id, maf, {_P} FROM variants JOIN hwe USING (variant_index) WHERE maf > 0.001 AND p > 1e-10"""
)
def variant_qc_2(spark: SparkSession, d: str) -> DataFrame:
    kept = filters.variant_qc_2(D.variants(spark, d), filters.genotype_counts(D.dense_probabilities(spark, d)))
    return kept.select("variant_index", "variant_id", "maf", *_p_columns())


@query(
    f"""WITH {D.VARIANTS_SQL}, {D.SPARSE_SQL}, {D.SPARSE_COUNTS_SQL}, {D.HWE_SQL}
SELECT variant_index, variant_id, maf, {_P} FROM variants JOIN hwe USING (variant_index) WHERE maf > 0.001 AND p > 1e-10"""
)
def variant_qc_2_sparse(spark: SparkSession, d: str) -> DataFrame:
    kept = filters.variant_qc_2(D.variants(spark, d), _sparse_counts(spark, d))
    return kept.select("variant_index", "variant_id", "maf", *_p_columns())


@query(f"WITH {D.SAMPLE_QC_SQL} SELECT sample_id, age, ethnic_background FROM kept_samples")
def sample_qc_filter(spark: SparkSession, d: str) -> DataFrame:
    kept = filters.sample_qc(D.sample_qc(spark, d))
    return kept.select(
        "sample_id", F.col("sample_age_at_recruitment").alias("age"), F.col("sample_ethnic_background").alias("ethnic_background")
    )


_CONDITIONS = {
    "no_aneuploidy": "aneuploidy IS NULL",
    "has_age": "age IS NOT NULL",
    "in_phasing_chromosome_x": "phasing_x = 1",
    "in_phasing_chromosomes_1_22": "phasing = 1",
    "in_pca": "in_pca = 1",
    "in_ethnic_groups": "ethnic_background IN (1001, 1002)",
}
_CONDITIONS["overall"] = " AND ".join(_CONDITIONS.values())


@query(
    f"WITH {D.SAMPLE_QC_SQL} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS \"filter\", count(*) FILTER ({c}) AS kept, count(*) - count(*) FILTER ({c}) AS removed FROM sample_qc"
        for n, c in _CONDITIONS.items()
    )
)
def filter_report(spark: SparkSession, d: str) -> DataFrame:
    return filters.filter_report(D.sample_qc(spark, d), filters.sample_qc_filters())


def _tally_sql(step: str, name: str, rows: str, conditions: dict[str, str]) -> str:
    counted = ((n, f"count(*) FILTER ({c})") for n, c in conditions.items())
    return " UNION ALL ".join(
        f"SELECT '{step}' AS step, '{name}' AS \"table\", '{n}' AS \"filter\", {k} AS kept, count(*) - {k} AS removed FROM {rows}" for n, k in counted
    )


_QC_TALLIES = " UNION ALL ".join(
    [
        _tally_sql("qc_1", "variants", "variants", {"high_info": "info > 0.8"}),
        _tally_sql("qc_2", "variants", "high", {"common": "maf > 0.001"}),
        _tally_sql("qc_2", "variants", "high WHERE maf > 0.001", {"has_calls": "variant_index IN (SELECT variant_index FROM tested)"}),
        _tally_sql("qc_2", "variants", "high JOIN tested USING (variant_index) WHERE maf > 0.001", {"in_equilibrium": "p > 1e-10"}),
        _tally_sql("qc_2", "samples", "sample_qc", _CONDITIONS),
    ]
)


@query(
    f"""WITH {D.SAMPLE_QC_SQL}, {D.VARIANTS_SQL}, {D.DENSE_GP_SQL}, codes AS (
  SELECT variant_index, {_CODES.format(p="p1")} AS a, {_CODES.format(p="p2")} AS b, 254 - a - b AS r FROM gp),
tested AS (WITH counts AS (
  SELECT variant_index, count(*) FILTER (r < greatest(a, b) AND a >= b) AS n_het, count(*) FILTER (r >= greatest(a, b)) AS n_hom_ref,
    count(*) FILTER (r < greatest(a, b) AND a < b) AS n_hom_alt FROM codes GROUP BY variant_index), {D.HWE_SQL} SELECT * FROM hwe),
high AS (SELECT * FROM variants WHERE info > 0.8)
{_QC_TALLIES}"""
)
def qc_run_report(spark: SparkSession, d: str) -> DataFrame:
    """Both QC steps of a study from folder to folder, and what their filters counted while the rows were written."""
    root = shared_path(spark, "qc-run")
    contig = (1 + F.col("variant_index") % 22).cast("string").alias("contig")
    variants = D.variants(spark, d).select("contig", "variant_index", *[F.col(c).alias(f"variant_{c}") for c in ("variant_id", "position", "maf", "info")])
    sinks.write_table(variants, f"{root}/raw/variants")
    sinks.write_table(table(spark, d, "embeddings").selectExpr("vec_id AS sample_id", "vec_id AS sample_index"), f"{root}/raw/samples")
    sinks.write_calls(blocks.pack_codes(D.dense_probabilities(spark, d).select(contig, "*")), f"{root}/raw/calls")
    sinks.write_table(D.packed_sample_qc(spark, d), f"{root}/sample_qc")
    study.run_qc_1(spark, f"{root}/raw", f"{root}/qc_1")
    study.run_qc_2(spark, f"{root}/qc_1", f"{root}/sample_qc", f"{root}/qc_2")
    reports = [spark.read.parquet(f"{root}/{step}/report").select(F.lit(step).alias("step"), "*") for step in ("qc_1", "qc_2")]
    return reports[0].union(reports[1])


@query(f"WITH {D.VARIANTS_SQL} SELECT variant_index, variant_id FROM variants WHERE variant_index >= 100 AND variant_index < 1500")
def region_slice(spark: SparkSession, d: str) -> DataFrame:
    return filters.region(D.variants(spark, d), (100, 1500)).select("variant_index", "variant_id")


def _zoned(spark: SparkSession, d: str, width: int = 1024) -> str:
    """Variants and call blocks of all contigs by zone; the dense calls cover the first variants."""
    path = shared_path(spark, "zones")
    contig = (1 + F.col("variant_index") % 22).cast("string").alias("contig")
    packed = blocks.pack_codes(D.dense_probabilities(spark, d).select(contig, "*"), width=1024)
    zones.write_zones(packed, D.variants(spark, d), path, "position", width)
    return path


_IN_REGION = "contig = '3' AND position BETWEEN 10000 AND 14700"


@query(
    f"""WITH {D.VARIANTS_SQL}, {D.DENSE_GP_SQL}, codes AS (
  SELECT variant_index, {_CODES.format(p="p1")} AS a, {_CODES.format(p="p2")} AS b, 254 - a - b AS r FROM gp),
counted AS (SELECT variant_index, count(*) FILTER (r < greatest(a, b) AND a >= b) AS n_het, count(*) FILTER (r >= greatest(a, b)) AS n_hom_ref,
  count(*) FILTER (r < greatest(a, b) AND a < b) AS n_hom_alt FROM codes GROUP BY variant_index)
SELECT variant_index, position, n_het, n_hom_ref, n_hom_alt FROM variants LEFT JOIN counted USING (variant_index) WHERE {_IN_REGION}"""
)
def region_blocks(spark: SparkSession, d: str) -> DataFrame:
    """Variants of a region of positions with genotype counts from its own blocks; other zones are not read."""
    variants, calls = zones.read_region(spark, _zoned(spark, d), "3", 10_000, 14_700, "position")
    counts = blocks.count_codes(calls, ("variant_index",))
    return variants.join(counts, "variant_index", "left").select("variant_index", "position", "n_het", "n_hom_ref", "n_hom_alt")


_REGIONS = """SELECT o_orderkey AS region_id, CAST(1 + o_custkey % 22 AS VARCHAR(9)) AS contig, CAST(10000 + o_orderkey * 7 AS BIGINT) AS "start",
  CAST(10000 + o_orderkey * 7 + 100 * (o_custkey % 50) AS BIGINT) AS "end" FROM orders"""


@query(
    f"""WITH {D.VARIANTS_SQL}, regions AS ({_REGIONS})
SELECT region_id, variant_index, position FROM regions JOIN variants USING (contig) WHERE position BETWEEN "start" AND "end" """
)
def region_join(spark: SparkSession, d: str) -> DataFrame:
    """All variants in each of many regions, met through the zones that a region overlaps."""
    regions = table(spark, d, "orders").selectExpr(
        "o_orderkey AS region_id", "CAST(1 + o_custkey % 22 AS STRING) AS contig", "10000 + o_orderkey * 7 AS start",
        "10000 + o_orderkey * 7 + 100 * (o_custkey % 50) AS end",
    )
    found = zones.join_regions(spark, _zoned(spark, d), regions, "position")
    return found.select("region_id", "variant_index", "position")


@query(f"WITH {D.VARIANTS_SQL} SELECT variant_index, info FROM variants WHERE info > 0.3")
def info_threshold(spark: SparkSession, d: str) -> DataFrame:
    return filters.info_threshold(D.variants(spark, d), 0.3).select("variant_index", "info")


@query(
    f"""WITH {D.SAMPLE_QC_SQL}, {D.VARIANTS_SQL}, {D.SPARSE_SQL}
SELECT variant_index, count(*) AS n_calls, CAST(sum(g) AS BIGINT) AS n_copies
FROM sparse WHERE variant_index IN (SELECT variant_index FROM variants WHERE info > 0.8)
  AND sample_index IN (SELECT sample_id FROM kept_samples) GROUP BY variant_index"""
)
def qc_calls(spark: SparkSession, d: str) -> DataFrame:
    """Calls left after variant and sample QC, per variant."""
    calls = D.sparse_dosages(spark, d).withColumnRenamed("sample_index", "sample_id")
    kept = filters.keep_calls(calls, filters.variant_qc_1(D.variants(spark, d)), filters.sample_qc(D.sample_qc(spark, d)))
    return kept.groupBy("variant_index").agg(F.count(F.lit(1)).alias("n_calls"), F.sum("dosage").cast("long").alias("n_copies"))


@query(
    f"""WITH {D.SAMPLE_QC_SQL}
SELECT vec_id AS sample_id, label AS batch_label, genetic_sex, age FROM embeddings JOIN kept_samples ON sample_id = vec_id"""
)
def sample_inner_join(spark: SparkSession, d: str) -> DataFrame:
    """Genotype samples that passed QC; a column of both sides keeps the genotype's value."""
    genotype = table(spark, d, "embeddings").selectExpr("vec_id AS sample_id", "label AS batch")
    kept = filters.sample_qc(D.sample_qc(spark, d)).selectExpr(
        "sample_id", "sample_genotype_measurement_batch AS batch", "sample_genetic_sex AS genetic_sex", "sample_age_at_recruitment AS age"
    )
    return traits.add_sample_qc(genotype, kept).withColumnRenamed("batch", "batch_label")


@query(
    f"""WITH {D.COHORT_SQL}
SELECT sample_id, CAST(age_at_recruitment AS DOUBLE) AS age, CAST(age_at_recruitment AS DOUBLE) ** 2 AS age_2, CAST(genetic_sex AS DOUBLE) AS sex,
  CAST(genetic_sex * age_at_recruitment AS DOUBLE) AS sex_x_age, genetic_sex * CAST(age_at_recruitment AS DOUBLE) ** 2 AS sex_x_age_2,
  pc[1] AS first_pc, pc[20] AS last_pc, CAST(25 AS INT) AS width FROM cohort"""
)
def covariate_derive(spark: SparkSession, d: str) -> DataFrame:
    x = regression.covariate_vector(D.cohort(spark, d))
    items = reshape.array_items(F.col("covariate"), 25)
    names = ["age", "age_2", "sex", "sex_x_age", "sex_x_age_2", "first_pc"]
    return x.select(
        "sample_id", *[c.alias(n) for c, n in zip(items, names)], items[24].alias("last_pc"), F.size("covariate").alias("width")
    )


_SCALED, _SCALED_NAMES = D.covariates_sql(D.N_PC)


@query(
    f"WITH {D.COHORT_SQL}, {_SCALED} SELECT sample_id, "
    + ", ".join(f"round({n}, 6) + 0.0 AS {n}" for n in _SCALED_NAMES)
    + " FROM covariates"
)
def covariate_scale(spark: SparkSession, d: str) -> DataFrame:
    x = regression.standardise(regression.covariate_vector(D.cohort(spark, d)), 25)
    items = reshape.array_items(F.col("covariate"), 25)
    return x.select("sample_id", *[rounded(c).alias(n) for c, n in zip(items, _SCALED_NAMES)])


_RAW_ID = "CASE WHEN o_orderstatus = 'P' THEN concat('P', o_custkey) ELSE CAST(o_custkey AS VARCHAR(20)) END"


@query(f"SELECT o_orderkey, TRY_CAST({_RAW_ID} AS INT) AS eid FROM orders WHERE TRY_CAST({_RAW_ID} AS INT) IS NOT NULL")
def null_id_filter(spark: SparkSession, d: str) -> DataFrame:
    return drop_missing_id(table(spark, d, "orders").selectExpr("o_orderkey", f"try_cast({_RAW_ID} AS INT) AS eid"), "eid")


TERMS = ["widget", "bolt"]
_EXCLUDED = "CASE WHEN p_partkey % 5 = 0 THEN 'YES' END"
_FIELD = "CASE WHEN p_size % 7 <> 0 THEN upper(p_name) END"


@query(
    f"""SELECT p_partkey, {_FIELD} AS "Field", CASE WHEN {_EXCLUDED} IS NOT NULL
  OR contains(lower(coalesce({_FIELD}, '')), 'widget') OR contains(lower(coalesce({_FIELD}, '')), 'bolt')
  THEN {_EXCLUDED} ELSE 'YES-NOT_IN_SUBSET' END AS "EXCLUDED" FROM part"""
)
def keyword_exclude(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "part").selectExpr("p_partkey", f"{_FIELD} AS Field", f"{_EXCLUDED} AS EXCLUDED")
    return filters.mark_excluded(listed, TERMS)


@query(
    """SELECT DISTINCT concat('P', c_nationkey) AS plate, concat(substr('ABCDEFGH', CAST(1 + c_custkey % 8 AS INT), 1), 1 + c_custkey % 12) AS well,
  true AS in_european_samples FROM customer"""
)
def membership_flag(spark: SparkSession, d: str) -> DataFrame:
    listed = D.participants(spark, d).selectExpr("x22007_0_0 AS plate_name", "x22008_0_0 AS well").distinct()
    return filters.flag_sample_set(listed, "in_european_samples")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def uniqueness_check(spark: SparkSession, d: str) -> DataFrame:
    return checks.find_duplicate_keys(table(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    """SELECT count(*) FILTER (c_acctbal IS NULL) AS balance, count(*) FILTER (c_nationkey = 0) AS ratio,
  count(*) FILTER (c_nationkey = 1) AS unbounded FROM customer"""
)
def finite_check(spark: SparkSession, d: str) -> DataFrame:
    nation, balance = F.col("c_nationkey"), F.col("c_acctbal")
    columns = {
        "balance": balance,
        "ratio": F.when(nation == 0, F.lit(float("nan"))).otherwise(balance),
        "unbounded": F.when(nation == 1, F.lit(float("-inf"))).otherwise(balance),
    }
    return checks.count_not_finite(table(spark, d, "customer"), columns)


@query(
    """SELECT p_type AS batch_key, count(DISTINCT p_size % 3) AS n_groups, count(DISTINCT p_brand) AS n_names FROM part
GROUP BY p_type HAVING count(DISTINCT p_size % 3) <> 1 OR count(DISTINCT p_brand) <> 1"""
)
def group_uniform_check(spark: SparkSession, d: str) -> DataFrame:
    listed = table(spark, d, "part").selectExpr("p_type AS batch_key", "p_size % 3 AS trait_group_id", "p_brand AS trait_name")
    return checks.find_mixed_batches(listed)


@query("SELECT c_custkey AS sample_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def sample_coverage_check(spark: SparkSession, d: str) -> DataFrame:
    genotype = table(spark, d, "customer").selectExpr("c_custkey AS sample_id")
    return checks.find_uncovered_samples(genotype, table(spark, d, "events").selectExpr("user_id AS sample_id"))
