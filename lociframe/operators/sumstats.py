"""Comparison of own association results with published ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.functions import text as X
from lociframe.operators.reshape import sorted_columns

KEYS = ["trait_id", "contig", "variant_id"]


def own_result_columns(results: DataFrame) -> DataFrame:
    """Own results with plain key names, ``gwas_`` on all other columns and colon variant ids.

    Accepts ids stored as bytes. The sample size keeps its full name.
    """
    binary = {name for name, kind in results.dtypes if kind == "binary"}
    text = lambda c: X.as_text(F.col(c)) if c in binary else F.col(c).cast("string")
    keys = [
        text("sample_trait_id").alias("trait_id"),
        text("variant_contig_name").alias("contig"),
        X.colon_variant_id(text("variant_id")).alias("variant_id"),
    ]
    return results.select(
        *keys,
        text("sample_trait_name").alias("gwas_trait_name"),
        text("sample_trait_group_id").alias("gwas_trait_group_id"),
        text("sample_trait_code_id").alias("gwas_trait_code_id"),
        F.col("variant_position").alias("gwas_variant_position"),
        F.col("variant_p_value").alias("gwas_p_value"),
        F.col("variant_beta").alias("gwas_variant_beta"),
        F.col("sample_size").alias("gwas_sample_size"),
        F.col("batch_index").alias("gwas_batch_index"),
        F.col("batch_size").alias("gwas_batch_size"),
    )


def published_result_columns(published: DataFrame) -> DataFrame:
    """Published results with plain key names and ``ot_`` on all other columns."""
    return published.select(
        "trait_id",
        F.col("chromosome").cast("string").alias("contig"),
        F.col("variant").alias("variant_id"),
        F.col("variant_id").alias("ot_variant_rsid"),
        F.col("minor_allele").alias("ot_minor_allele"),
        F.col("n_complete_samples").alias("ot_n_complete_samples"),
        F.col("beta").alias("ot_beta"),
        F.col("`p-value`").alias("ot_p_value"),
        F.col("tstat").alias("ot_tstat"),
        F.col("trait_group_id").cast("string").alias("ot_trait_group_id"),
        F.col("trait_code_id").alias("ot_trait_code_id"),
    )


def comparable(published: DataFrame, own: DataFrame) -> DataFrame:
    """Published results of trait groups that we have results for."""
    ours = own.select(F.col("gwas_trait_group_id").alias("ot_trait_group_id")).distinct()
    return published.join(ours, "ot_trait_group_id", "left_semi")


def single_rows(side: DataFrame, name: str) -> DataFrame:
    """``side`` grouped by key; the job fails where a key has more than one row.

    The grouping deals the rows out by key, as a join on the key then needs them, so that check and join share one exchange.
    """
    others = [c for c in side.columns if c not in KEYS]
    grouped = side.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("_n"), F.first(F.struct(*others)).alias("_row"))
    shown = F.concat_ws(", ", *[F.coalesce(F.col(k).cast("string"), F.lit("NULL")) for k in KEYS])
    fail = F.raise_error(F.concat(F.lit(f"duplicate keys {KEYS} in {name} results; first: "), shown))
    # A condition, unlike a column, is evaluated whatever is asked of the result.
    checked = grouped.filter(F.when(F.col("_n") == 1, F.lit(True)).otherwise(fail.cast("boolean")))
    return checked.select(*KEYS, *[F.col(f"_row.{c}").alias(c) for c in others])


def merge_results(own: DataFrame, published: DataFrame) -> DataFrame:
    """Full outer join of both sides with -log10 p, columns in name order.

    Keys must be unique on each side, otherwise the join would multiply rows: the job fails on one that is not.
    """
    merged = single_rows(own, "own").join(single_rows(published, "published"), KEYS, "full_outer").withColumns(
        {
            "gwas_log_p_value": X.neg_log10(F.col("gwas_p_value")),
            "ot_log_p_value": X.neg_log10(F.col("ot_p_value")),
        }
    )
    return sorted_columns(merged)


def replication_stats(merged: DataFrame) -> DataFrame:
    """Per trait: rows by presence, and agreement of effects and p-values where both sides have one."""
    own, ext = F.col("gwas_variant_beta"), F.col("ot_beta")
    own_p, ext_p = F.col("gwas_log_p_value"), F.col("ot_log_p_value")
    finite = X.is_finite(own_p) & X.is_finite(ext_p)
    mine, theirs = F.col("gwas_p_value").isNotNull(), F.col("ot_p_value").isNotNull()
    return merged.groupBy("trait_id").agg(
        F.count_if(mine & theirs).alias("n_both"),
        F.count_if(mine & ~theirs).alias("n_own_only"),
        F.count_if(~mine & theirs).alias("n_published_only"),
        F.corr(own, ext).alias("beta_corr"),
        F.regr_slope(own, ext).alias("beta_slope"),
        F.corr(F.when(finite, own_p), F.when(finite, ext_p)).alias("log_p_corr"),
    )
