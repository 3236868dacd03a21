"""Data checks. ``find_*`` return the offending rows; ``require_*`` fail the job on the first one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.functions.text import is_finite


class CheckFailed(ValueError):
    """A data check found offending rows."""


def require_none(offending: DataFrame, message: str) -> None:
    row = offending.head(1)
    if row:
        raise CheckFailed(f"{message}; first: {row[0].asDict()}")


def find_duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def require_unique(df: DataFrame, keys: list[str]) -> None:
    require_none(find_duplicate_keys(df, keys), f"duplicate keys {keys}")


def count_not_finite(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Number of missing or infinite values per named expression, in one pass."""
    return df.agg(*[F.count_if(~is_finite(c)).alias(name) for name, c in columns.items()])


def require_finite_vector(df: DataFrame, vector: str) -> None:
    bad = F.col(vector).isNull() | F.exists(vector, lambda v: ~is_finite(v))
    require_none(df.filter(bad), f"values of {vector} must be finite")


def find_mixed_batches(traits: DataFrame) -> DataFrame:
    """Batches that mix trait groups or trait names."""
    return (
        traits.groupBy("batch_key")
        .agg(F.countDistinct("trait_group_id").alias("n_groups"), F.countDistinct("trait_name").alias("n_names"))
        .filter("n_groups <> 1 or n_names <> 1")
    )


def find_uncovered_samples(genotype_samples: DataFrame, trait_samples: DataFrame) -> DataFrame:
    """Genotype samples without trait rows."""
    return genotype_samples.select("sample_id").join(trait_samples.select("sample_id"), "sample_id", "left_anti")
