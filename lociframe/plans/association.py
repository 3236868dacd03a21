"""Association queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.operators import filters, layout, regression, reshape, traits
from lociframe.operators.traits import batch_traits
from lociframe.plans import domain as D
from lociframe.plans.registry import query, rounded, table
from lociframe.session import shared_path, stage
from lociframe.sources import sinks

_FIT = "n AS sample_size, round(beta, 6) + 0.0 AS beta, round(beta / se, 6) + 0.0 AS t"


def _single_batches(values: DataFrame) -> DataFrame:
    """One batch per trait, so that each trait has its own complete cases."""
    return batch_traits(reshape.describe_traits(values.select("trait_id").distinct()), 1)


_BALANCE_ROWS = f"""rows1 AS (SELECT concat('50_', c_mktsegment) AS trait_id, variant_index, c_acctbal AS y, g, CAST(c_nationkey % 2 AS DOUBLE) AS x1
  FROM dosages JOIN customer ON c_custkey = sample_index)"""


@query(
    f"""WITH {D.dense_dosage_sql(0)}, {_BALANCE_ROWS}, {D.adjusted_sql("rows1", "trait_id, variant_index", ["x1"])}
SELECT trait_id, variant_index, {_FIT} FROM fit WHERE n >= 10"""
)
def gwas_linear_1cov(spark: SparkSession, d: str) -> DataFrame:
    """Account balance, per market segment, on every vector element as a dosage, adjusted for sex."""
    values = table(spark, d, "customer").selectExpr("c_custkey AS sample_id", "concat('50_', c_mktsegment) AS trait_id", "c_acctbal AS value")
    samples = D.cohort(spark, d).select(
        "sample_id", "sample_index", F.array(F.col("genetic_sex").cast("double")).alias("covariate")
    )
    shape = regression.Shape(n_covariates=1, batch_size=1)
    result = regression.associate(D.dense_dosages(spark, d, 0), samples, values, _single_batches(values), shape, 10, n_variants=64)
    return result.select("trait_id", "variant_index", "sample_size", rounded("beta").alias("beta"), rounded("t").alias("t"))


_COV25, _X25 = D.covariates_sql(D.N_PC)
_COUNTS_SQL = """order_counts AS (SELECT o_custkey, concat('50_', o_orderstatus) AS trait_id, CAST(count(*) AS DOUBLE) AS y FROM orders GROUP BY ALL)"""
_MULTI_ROWS = f"""{_COUNTS_SQL}, rows1 AS (SELECT trait_id, variant_index, y, g, {', '.join(_X25)}
  FROM dosages JOIN covariates c USING (sample_index) JOIN order_counts p ON p.o_custkey = c.sample_id)"""


def _covariates(spark: SparkSession, d: str, npc: int) -> DataFrame:
    scaled = regression.standardise(regression.covariate_vector(D.cohort(spark, d), npc), 5 + npc)
    return scaled.select("sample_id", "sample_index", "covariate")


def _order_counts(spark: SparkSession, d: str) -> DataFrame:
    """Orders per participant, one trait per order status."""
    orders = table(spark, d, "orders").selectExpr("o_custkey AS sample_id", "concat('50_', o_orderstatus) AS trait_id")
    return orders.groupBy("sample_id", "trait_id").agg(F.count(F.lit(1)).cast("double").alias("value"))


@query(
    f"""WITH {D.COHORT_SQL}, {_COV25}, {D.dense_dosage_sql()}, {_MULTI_ROWS}, {D.adjusted_sql("rows1", "trait_id, variant_index", _X25)}
SELECT trait_id, variant_index, {_FIT} FROM fit WHERE n >= 100"""
)
def gwas_linear_multi(spark: SparkSession, d: str) -> DataFrame:
    """Number of orders by status on 44 dense dosages, adjusted for 25 standardised covariates."""
    values = _order_counts(spark, d)
    shape = regression.Shape(n_covariates=25, batch_size=1)
    calls = regression.pack_blocks(D.dense_dosages(spark, d))
    result = regression.associate(
        calls, _covariates(spark, d, D.N_PC), values, _single_batches(values), shape, n_variants=D.N_DENSE
    )
    return result.select("trait_id", "variant_index", "sample_size", rounded("beta").alias("beta"), rounded("t").alias("t"))


_COV5, _X5 = D.covariates_sql(5)
_BATCH_ROWS = f"""rows1 AS (SELECT trait_id, variant_index, value AS y, g, {', '.join(_X5)}
  FROM complete JOIN batches USING (batch_key) JOIN trait_values USING (trait_id, sample_id)
    JOIN covariates USING (sample_id) JOIN dosages USING (sample_index))"""
_BATCH_SQL = f"""{D.TRAITS_SQL}, {D.COHORT_SQL}, {_COV5}, {D.dense_dosage_sql()}, {_BATCH_ROWS},
{D.adjusted_sql("rows1", "trait_id, variant_index", _X5)}"""


def _batched(spark: SparkSession, d: str, min_samples: int) -> DataFrame:
    batches = D.trait_batches(spark, d)
    shape = regression.Shape(n_covariates=10, batch_size=2)
    calls = regression.pack_blocks(D.dense_dosages(spark, d))
    values = D.trait_values(spark, d)
    return regression.associate(
        calls, _covariates(spark, d, 5), values, batches, shape, min_samples, n_variants=D.N_DENSE
    )


@query(
    f"""WITH {_BATCH_SQL}
SELECT trait_id, variant_index, trait_group_id, CAST(trait_index AS INT) AS trait_index, CAST(batch_index AS INT) AS batch_index,
  CAST(batch_size AS INT) AS batch_size, {_FIT.replace("n AS", "fit.n AS")} FROM fit JOIN batches USING (trait_id) WHERE fit.n >= 130"""
)
def gwas_batched(spark: SparkSession, d: str) -> DataFrame:
    """All trait groups and batches with enough complete cases, in one job."""
    result = _batched(spark, d, 130)
    return result.select(
        "trait_id", "variant_index", "trait_group_id", "trait_index", "batch_index", "batch_size", "sample_size",
        rounded("beta").alias("beta"), rounded("t").alias("t"),
    )


@query(
    f"""WITH {_BATCH_SQL}
SELECT trait_id, variant_index, trait_group_id, CAST(trait_index AS INT) AS trait_index, {_FIT.replace("n AS", "fit.n AS")}
FROM fit JOIN batches USING (trait_id) WHERE fit.n >= 10"""
)
def gwas_tiled(spark: SparkSession, d: str) -> DataFrame:
    """All batches on calls laid out by variant block: three variant blocks, several sample blocks and several passes."""
    shape = regression.Shape(n_covariates=10, batch_size=2, sample_width=64, variant_width=16, columns_per_pass=60)
    path = shared_path(spark, "laid-out-calls")
    layout.write_layout(regression.pack_blocks(D.dense_dosages(spark, d), shape.sample_width), path, D.N_DENSE, shape.variant_width)
    calls = layout.read_layout(spark, path)
    result = regression.associate(calls, _covariates(spark, d, 5), D.trait_values(spark, d), D.trait_batches(spark, d), shape, 10)
    return result.select(
        "trait_id", "variant_index", "trait_group_id", "trait_index", "sample_size", rounded("beta").alias("beta"), rounded("t").alias("t")
    )


@query(
    f"""WITH {D.TRAITS_SQL}, {D.COHORT_SQL}, sizes AS (SELECT batch_key, count(*) AS cases FROM complete JOIN cohort USING (sample_id) GROUP BY batch_key)
SELECT DISTINCT batch_key, trait_group_id, CAST(batch_index AS INT) AS batch_index, CAST(batch_size AS INT) AS batch_size,
  coalesce(cases, 0) AS sample_size, coalesce(cases, 0) >= 130 AS ran FROM batches LEFT JOIN sizes USING (batch_key)"""
)
def batch_report(spark: SparkSession, d: str) -> DataFrame:
    """Complete cases of every batch, and whether they are enough to run."""
    batches, shape = D.trait_batches(spark, d), regression.Shape(n_covariates=10, batch_size=2)
    rows = regression.design(D.trait_values(spark, d), batches, _covariates(spark, d, 5), shape)
    solved = regression.solve(regression.moments(rows), shape.k)
    return traits.batch_report(batches, solved.select("batch_key", F.col("n").alias("sample_size")), 130)


@query(
    f"""WITH {_BATCH_SQL}, scored AS (SELECT trait_id, variant_index, dof, beta / se AS t FROM fit),
{D.p_value_sql("scored", "trait_id, variant_index")}
SELECT trait_id, variant_index, CASE WHEN p IS NOT NULL THEN CAST(dof AS DOUBLE) END AS dof, round(p, 8) + 0.0 AS p_value FROM tested"""
)
def gwas_pvalue(spark: SparkSession, d: str) -> DataFrame:
    """p-values of all batches, small ones included."""
    result = _batched(spark, d, 1)
    return result.select("trait_id", "variant_index", "dof", rounded("p_value", 8).alias("p_value"))


_SPARSE_GWAS = f"""{D.SPARSE_SQL},
y0 AS (SELECT concat('50_', o_orderstatus) AS trait_id, o_custkey AS sample_index, sum(o_totalprice) AS y FROM orders GROUP BY ALL),
s0 AS (SELECT trait_id, sample_index, y, CAST(c_nationkey % 2 AS DOUBLE) AS x1, CAST(floor((c_acctbal + 1000) / 200) AS DOUBLE) AS x2
  FROM y0 JOIN customer ON c_custkey = sample_index),
s1 AS (SELECT trait_id, sample_index, y - avg(y) OVER w AS y, x1 - avg(x1) OVER w AS x1, x2 - avg(x2) OVER w AS x2 FROM s0
  WINDOW w AS (PARTITION BY trait_id)),
s2 AS (SELECT trait_id, sample_index, x1, y - x1 * (sum(x1 * y) OVER w / sum(x1 * x1) OVER w) AS y,
  x2 - x1 * (sum(x1 * x2) OVER w / sum(x1 * x1) OVER w) AS x2 FROM s1 WINDOW w AS (PARTITION BY trait_id)),
s3 AS (SELECT trait_id, sample_index, x1, x2, y - x2 * (sum(x2 * y) OVER w / sum(x2 * x2) OVER w) AS y FROM s2
  WINDOW w AS (PARTITION BY trait_id)),
totals AS (SELECT trait_id, count(*) AS n, sum(y * y) AS yy, sum(x1 * x1) AS x11, sum(x2 * x2) AS x22 FROM s3 GROUP BY trait_id),
v AS (SELECT trait_id, variant_index, sum(g) AS g1, sum(g * g) AS g2, sum(g * x1) AS gx1, sum(g * x2) AS gx2, sum(g * y) AS gy
  FROM sparse JOIN s3 USING (sample_index) GROUP BY ALL),
fit AS (SELECT trait_id, variant_index, n, yy, gy, n - 4 AS dof, g2 - g1 * g1 / n - gx1 * gx1 / x11 - gx2 * gx2 / x22 AS gg
  FROM v JOIN totals USING (trait_id))"""


@query(
    f"""WITH {_SPARSE_GWAS}
SELECT trait_id, variant_index, n AS sample_size, round(gy / gg, 3) + 0.0 AS beta, round(gy / gg / sqrt((yy - gy * gy / gg) / dof / gg), 6) + 0.0 AS t FROM fit WHERE n >= 100"""
)
def gwas_sparse(spark: SparkSession, d: str) -> DataFrame:
    """Order volume by status on the number of line items of every part, adjusted for sex and age."""
    people = table(spark, d, "customer").selectExpr(
        "c_custkey AS sample_id",
        "c_custkey AS sample_index",
        "array(CAST(c_nationkey % 2 AS DOUBLE), CAST(floor((c_acctbal + 1000) / 200) AS DOUBLE)) AS covariate",
    )
    orders = table(spark, d, "orders").selectExpr("o_custkey AS sample_id", "concat('50_', o_orderstatus) AS trait_id", "o_totalprice")
    values = orders.groupBy("sample_id", "trait_id").agg(F.sum("o_totalprice").alias("value"))
    shape = regression.Shape(n_covariates=2, batch_size=1)
    calls = D.sparse_dosages(spark, d)
    n_variants = table(spark, d, "part").count()
    covariates = regression.standardise(people, 2)
    result = regression.associate(calls, covariates, values, _single_batches(values), shape, n_variants=n_variants)
    return result.select("trait_id", "variant_index", "sample_size", rounded("beta", 3).alias("beta"), rounded("t").alias("t"))


_PEOPLE = """SELECT c_custkey AS sample_id, c_custkey AS sample_index, CAST(c_nationkey % 2 AS INT) AS genetic_sex,
  CAST(floor((c_acctbal + 1000) / 200) AS INT) AS age_at_recruitment FROM {}"""
_KEPT_PEOPLE = f"kept_people AS (SELECT * FROM ({_PEOPLE.format('customer')}) SEMI JOIN kept_samples USING (sample_id))"
_COV_QC, _XQC = D.covariates_sql(0, "kept_people")
_QC_ROWS = f"""{_COUNTS_SQL}, rows1 AS (SELECT trait_id, v.variant_index, y, coalesce(s.g, 0) AS g, {', '.join(_XQC)}
  FROM kept_variants v CROSS JOIN covariates c JOIN order_counts p ON p.o_custkey = c.sample_id LEFT JOIN sparse s ON s.variant_index = v.variant_index AND s.sample_index = c.sample_index)"""


@query(
    f"""WITH {D.SAMPLE_QC_SQL}, {_KEPT_PEOPLE}, {_COV_QC}, {D.VARIANTS_SQL}, {D.SPARSE_SQL}, {D.SPARSE_COUNTS_SQL}, {D.HWE_SQL},
kept_variants AS (SELECT variant_index FROM variants JOIN hwe USING (variant_index) WHERE info > 0.8 AND maf > 0.001 AND p > 1e-10),
{_QC_ROWS}, {D.adjusted_sql("rows1", "trait_id, variant_index", _XQC)}
SELECT trait_id, variant_index, {_FIT} FROM fit SEMI JOIN (
  SELECT trait_id, variant_index FROM sparse JOIN covariates USING (sample_index) JOIN order_counts ON o_custkey = sample_id) USING (trait_id, variant_index)
WHERE n >= 100"""
)
def gwas_full_run(spark: SparkSession, d: str) -> DataFrame:
    """The whole run: variant QC, sample QC, covariates of kept samples, association, results by partition.

    A variant that no kept sample carries has no row.
    """
    calls = stage(D.sparse_dosages(spark, d), "sparse-calls")
    informative = filters.variant_qc_1(D.variants(spark, d))
    n_samples = table(spark, d, "customer").agg(F.count(F.lit(1))).scalar()
    kept_variants = filters.variant_qc_2(informative, filters.sparse_genotype_counts(calls, n_samples))
    passed = filters.sample_qc(D.sample_qc(spark, d)).select("sample_id")
    people = spark.sql(_PEOPLE.format("{c}"), c=table(spark, d, "customer")).join(passed, "sample_id", "left_semi")
    no_components = people.withColumn("principal_component", F.array().cast("array<double>"))
    covariates = regression.standardise(regression.covariate_vector(no_components, 0), 5)
    kept_calls = calls.join(kept_variants.select("variant_index"), "variant_index", "left_semi")
    values = _order_counts(spark, d)
    shape = regression.Shape(n_covariates=5, batch_size=1)
    n_variants = table(spark, d, "part").count()
    result = regression.associate(
        kept_calls, covariates, values, _single_batches(values), shape, n_variants=n_variants, together=sinks.RESULT_PARTITIONS
    )
    path = shared_path(spark, "association")
    sinks.write_results(result, path, placed=True)
    stored = spark.read.schema(result.schema).parquet(path)
    return stored.select("trait_id", "variant_index", "sample_size", rounded("beta").alias("beta"), rounded("t").alias("t"))


@query(
    f"""WITH {D.COHORT_SQL}, {_COV5}, {D.TRAITS_SQL}
SELECT sample_id, trait_id, trait_group_id, trait_code_id, round(value, 4) + 0.0 AS value, round(x1, 6) + 0.0 AS first_covariate
FROM trait_values JOIN traits USING (trait_id) JOIN covariates USING (sample_id)"""
)
def variables_snapshot(spark: SparkSession, d: str) -> DataFrame:
    """The variables behind a run as three tables, read back joined."""
    path = shared_path(spark, "variables")
    info = D.variants(spark, d).select(
        F.col("variant_index").alias("variant_contig"), F.col("contig").alias("variant_contig_name"), "variant_id",
        F.col("rsid").alias("variant_rsid"), F.col("position").alias("variant_position"),
        F.array("allele1_ref", "allele2_alt").alias("variant_allele"), F.col("minor_allele").alias("variant_minor_allele"),
        F.lit(None).cast("double").alias("variant_hwe_p_value"), F.col("maf").alias("variant_maf"), F.col("info").alias("variant_info"),
    )
    scaled = regression.standardise(regression.covariate_vector(D.cohort(spark, d), 5), 10)
    samples = scaled.select(
        "sample_id", F.col("principal_component").alias("sample_principal_component"), F.col("covariate").alias("sample_covariate"),
        F.col("genetic_sex").alias("sample_genetic_sex"), F.col("age_at_recruitment").alias("sample_age_at_recruitment"),
        F.lit(None).cast("int").alias("sample_ethnic_background"),
    )
    values = D.trait_values(spark, d).join(D.traits(spark, d), "trait_id").select(
        "sample_id", F.col("value").alias("sample_trait"), F.col("trait_id").alias("sample_trait_id"),
        F.col("trait_group_id").alias("sample_trait_group_id"), F.col("trait_code_id").alias("sample_trait_code_id"),
        F.lit(None).cast("string").alias("sample_trait_name"),
    )
    sinks.write_snapshot(info, samples, values, path)
    stored = spark.read.parquet(f"{path}/traits").join(spark.read.parquet(f"{path}/samples"), "sample_id")
    return stored.select(
        "sample_id", F.col("sample_trait_id").alias("trait_id"), F.col("sample_trait_group_id").alias("trait_group_id"),
        F.col("sample_trait_code_id").alias("trait_code_id"), rounded("sample_trait", 4).alias("value"),
        rounded(F.get("sample_covariate", F.lit(0))).alias("first_covariate"),
    )
