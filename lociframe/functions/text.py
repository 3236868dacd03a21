"""Identifiers, file names and text predicates as Column expressions."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of own result files, numbered contigs only and with X and XY.
OWN_FILE = r"ukb_chr(\d+)_(\d+)_(.*).parquet"
OWN_FILE_ALL_CONTIGS = r"ukb_chr([0-9]+|X|XY)_(\d+)_(.*).parquet"


_FIELD = re.compile(r"(\d+)-(\d+)\.(\d+)")  # field, instance and array of a participant column
_COLUMN = re.compile(r"x(\d+)_(\d+)_(\d+)")


def participant_field(name: str, id_column: str = "eid") -> str:
    """``31-0.0`` -> ``x31_0_0``; the id column keeps its name, any other name is an error."""
    if name == id_column:
        return id_column
    parts = _FIELD.fullmatch(name)
    if not parts:
        raise ValueError(f"{name!r} is not of the form field-instance.array")
    return "x{}_{}_{}".format(*parts.groups())


def participant_header(column: str) -> str:
    """The inverse of ``participant_field`` for ``x{field}_{instance}_{array}``."""
    parts = _COLUMN.fullmatch(column)
    if not parts:
        raise ValueError(f"{column!r} is not a participant column")
    return "{}-{}.{}".format(*parts.groups())


def id_group(c: Column) -> Column:
    """Text before the first underscore."""
    return F.substring_index(c, "_", 1)


def id_code(c: Column) -> Column:
    """Text after the first underscore, empty where there is none."""
    return F.regexp_extract(c, "^[^_]*_(.*)$", 1)


def as_text(c: Column) -> Column:
    """Bytes to text."""
    return F.decode(c, "UTF-8")


def colon_variant_id(c: Column) -> Column:
    """``21:9660864_G_A`` -> ``21:9660864:G:A``."""
    return F.translate(c, "_", ":")


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def before_first_dot(name: Column) -> Column:
    return F.substring_index(name, ".", 1)


def batch_key(batch_index: Column, group: Column) -> Column:
    """``007_20095``: zero-padded batch number and trait group."""
    digits = batch_index.cast("string")
    padded = F.when(F.length(digits) < 3, F.lpad(digits, 3, "0")).otherwise(digits)
    return F.concat_ws("_", padded, group.cast("string"))


def any_term(c: Column, terms: list[str]) -> Column:
    """Case-insensitive match of any term; terms are patterns, a missing text matches none."""
    text = F.lower(F.coalesce(c, F.lit("")))
    return reduce(lambda a, b: a | b, [text.rlike(term) for term in terms], F.lit(False))


def is_finite(c: Column) -> Column:
    """False for NULL, NaN and the infinities."""
    return F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False))


def neg_log10(p: Column) -> Column:
    """-log10(p) with infinity at zero."""
    return F.when(p == 0, F.lit(float("inf"))).otherwise(-F.log10(p))
