"""Queries comparing own and published summary statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.functions import text as X
from lociframe.operators import reshape, sumstats
from lociframe.plans.registry import query, rounded, table
from lociframe.session import shared_path
from lociframe.sources import sinks
from lociframe.sources import sumstats as files

# Own results: line items by status and part. Published results: orders by status and customer.
_OWN = """SELECT concat('20095_', l_linestatus) AS sample_trait_id, concat('status ', l_linestatus) AS sample_trait_name,
  CAST(20095 AS BIGINT) AS sample_trait_group_id, l_linestatus AS sample_trait_code_id,
  CAST(1 + l_partkey % 22 AS VARCHAR(9)) AS variant_contig_name, concat(1 + l_partkey % 22, ':', l_partkey, '_A_G') AS variant_id,
  CAST(10000 + 100 * l_partkey AS INT) AS variant_position, CAST(sum(CAST(l_quantity AS INT)) % 40 AS DOUBLE) / 40 AS variant_p_value,
  avg(l_discount) AS variant_beta, count(*) AS sample_size, CAST(0 AS INT) AS batch_index, CAST(2 AS INT) AS batch_size
FROM {} GROUP BY l_linestatus, l_partkey"""

_PUBLISHED = """SELECT concat('20095_', o_orderstatus) AS trait_id, '20095' AS trait_group_id, o_orderstatus AS trait_code_id,
  CAST(1 + o_custkey % 22 AS VARCHAR(9)) AS chromosome, concat(1 + o_custkey % 22, ':', o_custkey, ':A:G') AS variant,
  concat('rs', o_custkey) AS variant_id, 'G' AS minor_allele, count(*) AS n_complete_samples,
  CAST(sum(CAST(floor(o_totalprice) AS BIGINT)) AS DOUBLE) / 1000 AS beta, CAST(sum(o_orderkey) % 40 AS DOUBLE) / 40 AS {p_value},
  CAST(sum(o_orderkey) % 997 AS DOUBLE) / 100 AS tstat
FROM {orders} GROUP BY o_orderstatus, o_custkey"""


def own_results(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(_OWN.format("{lineitem}"), lineitem=table(spark, d, "lineitem"))


def published_results(spark: SparkSession, d: str) -> DataFrame:
    return spark.sql(_PUBLISHED.format(p_value="`p-value`", orders="{orders}"), orders=table(spark, d, "orders"))


_MERGED_SQL = f"""own AS ({_OWN.format('lineitem')}), published AS ({_PUBLISHED.format(p_value='p_value', orders='orders')}),
o AS (SELECT sample_trait_id AS trait_id, variant_contig_name AS contig, replace(variant_id, '_', ':') AS variant_id,
    * EXCLUDE (sample_trait_id, variant_contig_name, variant_id) FROM own),
p AS (SELECT trait_id, chromosome AS contig, variant AS variant_id, variant_id AS rsid, minor_allele, n_complete_samples, beta, p_value, tstat,
    trait_group_id, trait_code_id FROM published),
merged AS (
  SELECT trait_id, contig, variant_id, sample_trait_name AS gwas_trait_name, CAST(sample_trait_group_id AS VARCHAR) AS gwas_trait_group_id,
    sample_trait_code_id AS gwas_trait_code_id, variant_position AS gwas_variant_position, variant_p_value AS gwas_p_value,
    variant_beta AS gwas_variant_beta, sample_size AS gwas_sample_size, batch_index AS gwas_batch_index, batch_size AS gwas_batch_size,
    CASE WHEN variant_p_value = 0 THEN CAST('Infinity' AS DOUBLE) WHEN variant_p_value > 0 THEN -log10(variant_p_value) END AS gwas_log_p_value,
    rsid AS ot_variant_rsid, minor_allele AS ot_minor_allele, n_complete_samples AS ot_n_complete_samples, beta AS ot_beta, p_value AS ot_p_value,
    tstat AS ot_tstat, p.trait_group_id AS ot_trait_group_id, p.trait_code_id AS ot_trait_code_id,
    CASE WHEN p_value = 0 THEN CAST('Infinity' AS DOUBLE) WHEN p_value > 0 THEN -log10(p_value) END AS ot_log_p_value
  FROM o FULL OUTER JOIN p USING (trait_id, contig, variant_id))"""

_ROUNDED = ["gwas_variant_beta", "gwas_log_p_value", "ot_log_p_value"]


def _round_merged(df: DataFrame) -> DataFrame:
    """Round, and write infinity as a flag value, since round() maps it differently across engines."""
    infinite = lambda c: F.abs(F.col(c)) == float("inf")
    return df.withColumns({c: F.when(infinite(c), F.lit(9999.0)).otherwise(rounded(F.when(~infinite(c), F.col(c)))) for c in _ROUNDED})


_ROUND_SQL = "* REPLACE (" + ", ".join(f"CASE WHEN isinf({c}) THEN 9999.0 ELSE round({c}, 6) + 0.0 END AS {c}" for c in _ROUNDED) + ")"


@query(f"WITH {_MERGED_SQL} SELECT {_ROUND_SQL} FROM merged")
def sumstat_full_outer(spark: SparkSession, d: str) -> DataFrame:
    """The comparison table, written and read back."""
    path = shared_path(spark, "merged")
    own = sumstats.own_result_columns(own_results(spark, d))
    published = sumstats.published_result_columns(published_results(spark, d))
    sinks.write_table(sumstats.merge_results(own, sumstats.comparable(published, own)), path)
    return _round_merged(spark.read.parquet(path))


@query(f"WITH {_MERGED_SQL} SELECT {_ROUND_SQL} FROM merged WHERE trait_id <> '20095_P'")
def merge_selected(spark: SparkSession, d: str) -> DataFrame:
    """The comparison table from published files of two column orders, of which one trait is not wanted."""
    path = shared_path(spark, "published")
    named = published_results(spark, d).withColumn("trait_file", F.concat("trait_id", F.lit("_raw.both_sexes.tsv.gz")))
    columns = [c for c in named.columns if c not in ("trait_id", "trait_group_id", "trait_code_id")]
    sinks.write_published(named.filter("trait_code_id = 'F'").select(*columns), f"{path}/some", "trait_file")
    sinks.write_published(named.filter("trait_code_id <> 'F'").select(*reversed(columns)), f"{path}/others", "trait_file")
    own = sumstats.own_result_columns(own_results(spark, d))
    published = files.read_published(spark, path, named.filter("trait_code_id <> 'P'").select("trait_id"))
    return _round_merged(sumstats.merge_results(own, sumstats.comparable(published, own)))


@query(
    f"""WITH own AS ({_OWN.format('lineitem')})
SELECT sample_trait_id AS trait_id, variant_id, sample_trait_name AS gwas_trait_name, sample_trait_group_id AS gwas_trait_group_id,
  sample_trait_code_id AS gwas_trait_code_id, variant_contig_name AS gwas_variant_contig_name, variant_position AS gwas_variant_position,
  variant_p_value AS gwas_variant_p_value, round(variant_beta, 6) + 0.0 AS gwas_variant_beta, sample_size AS gwas_size,
  batch_index AS gwas_batch_index, batch_size AS gwas_batch_size FROM own"""
)
def result_rename(spark: SparkSession, d: str) -> DataFrame:
    """Results without their dimension in the names, and with the name of their source."""
    own = own_results(spark, d).withColumn("variant_beta", rounded("variant_beta"))
    return reshape.with_prefix(reshape.without_text(own, "sample_"), "gwas_", keep=("trait_id", "variant_id"))


@query(
    f"""WITH own AS ({_OWN.format('lineitem')})
SELECT sample_trait_id AS trait_id, variant_id, CASE WHEN variant_p_value = 0 THEN 9999.0 ELSE round(-log10(variant_p_value), 6) + 0.0 END AS log_p FROM own"""
)
def neg_log10(spark: SparkSession, d: str) -> DataFrame:
    own = own_results(spark, d)
    log_p = X.neg_log10(F.col("variant_p_value"))
    return own.select(
        F.col("sample_trait_id").alias("trait_id"),
        "variant_id",
        F.when(F.col("variant_p_value") == 0, F.lit(9999.0)).otherwise(rounded(F.when(X.is_finite(log_p), log_p))).alias("log_p"),
    )


@query(
    f"""WITH {_MERGED_SQL}
SELECT contig, count(*) AS n_rows, count(DISTINCT trait_id) AS n_traits, count(gwas_p_value) AS n_own, count(ot_p_value) AS n_published,
  count(*) FILTER (gwas_p_value IS NOT NULL AND ot_p_value IS NOT NULL) AS n_both, CAST(sum(ot_n_complete_samples) AS BIGINT) AS n_samples
FROM merged GROUP BY contig"""
)
def merge_checked(spark: SparkSession, d: str) -> DataFrame:
    """Rows of the comparison table by contig; keys are checked and joined in one exchange per side."""
    own = sumstats.own_result_columns(own_results(spark, d))
    merged = sumstats.merge_results(own, sumstats.published_result_columns(published_results(spark, d)))
    mine, theirs = F.col("gwas_p_value").isNotNull(), F.col("ot_p_value").isNotNull()
    return merged.groupBy("contig").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.countDistinct("trait_id").alias("n_traits"),
        F.count_if(mine).alias("n_own"),
        F.count_if(theirs).alias("n_published"),
        F.count_if(mine & theirs).alias("n_both"),
        F.sum("ot_n_complete_samples").alias("n_samples"),
    )


@query(
    f"""WITH {_MERGED_SQL}, f AS (
  SELECT *, isfinite(gwas_log_p_value) AND isfinite(ot_log_p_value) AS finite FROM merged)
SELECT trait_id, count(*) FILTER (gwas_p_value IS NOT NULL AND ot_p_value IS NOT NULL) AS n_both,
  count(*) FILTER (gwas_p_value IS NOT NULL AND ot_p_value IS NULL) AS n_own_only,
  count(*) FILTER (gwas_p_value IS NULL AND ot_p_value IS NOT NULL) AS n_published_only,
  round(corr(gwas_variant_beta, ot_beta), 6) + 0.0 AS beta_corr, round(regr_slope(gwas_variant_beta, ot_beta) * 1000000, 4) + 0.0 AS beta_slope,
  round(corr(gwas_log_p_value, ot_log_p_value) FILTER (finite), 6) + 0.0 AS log_p_corr
FROM f GROUP BY trait_id"""
)
def replication_stats(spark: SparkSession, d: str) -> DataFrame:
    own = sumstats.own_result_columns(own_results(spark, d))
    merged = sumstats.merge_results(own, sumstats.published_result_columns(published_results(spark, d)))
    stats = sumstats.replication_stats(merged)
    return stats.select(
        "trait_id",
        "n_both",
        "n_own_only",
        "n_published_only",
        rounded("beta_corr").alias("beta_corr"),
        rounded(F.col("beta_slope") * 1_000_000, 4).alias("beta_slope"),
        rounded("log_p_corr").alias("log_p_corr"),
    )


@query(
    f"""WITH own AS ({_OWN.format('lineitem')})
SELECT sample_trait_id AS trait_id, variant_contig_name AS contig, replace(variant_id, '_', ':') AS variant_id, sample_size AS gwas_sample_size FROM own"""
)
def sumstat_union(spark: SparkSession, d: str) -> DataFrame:
    """Own results written by contig and trait group, read back as one table."""
    path = shared_path(spark, "own-results")
    results = own_results(spark, d).withColumns({"contig": F.col("variant_contig_name"), "trait_group_id": F.col("sample_trait_group_id")})
    sinks.write_results(results, path)
    return files.read_own(spark, path).select("trait_id", "contig", "variant_id", "gwas_sample_size")


@query(
    f"""WITH published AS ({_PUBLISHED.format(p_value='p_value', orders='orders')})
SELECT trait_id, chromosome AS contig, variant AS variant_id, variant_id AS ot_variant_rsid, minor_allele AS ot_minor_allele,
  n_complete_samples AS ot_n_complete_samples, round(beta, 3) + 0.0 AS ot_beta, round(p_value, 6) + 0.0 AS ot_p_value, round(tstat, 3) + 0.0 AS ot_tstat,
  trait_group_id AS ot_trait_group_id, trait_code_id AS ot_trait_code_id FROM published"""
)
def gz_tsv_read(spark: SparkSession, d: str) -> DataFrame:
    """Published results written as gzipped TSV by trait, read back by file name."""
    path = shared_path(spark, "published")
    named = published_results(spark, d).withColumn("trait_file", F.concat("trait_id", F.lit("_raw.both_sexes.tsv.gz")))
    sinks.write_published(named.drop("trait_id", "trait_group_id", "trait_code_id"), path, "trait_file")
    df = files.read_published(spark, path)
    return df.withColumns({"ot_beta": rounded("ot_beta", 3), "ot_p_value": rounded("ot_p_value"), "ot_tstat": rounded("ot_tstat", 3)})
