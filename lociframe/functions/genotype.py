"""Genotype probabilities, dosages and packed calls as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def complete_probability(gp: Column) -> Column:
    """True where a probability vector has no NULL and no NaN."""
    return gp.isNotNull() & F.forall(gp, lambda p: p.isNotNull() & ~F.isnan(p))


def hard_call(gp: Column) -> Column:
    """0-based position of the largest probability, the first on ties; NULL if any is missing."""
    return F.when(complete_probability(gp), (F.array_position(gp, F.array_max(gp)) - 1).cast("int"))


def unpack_probability(het: Column, hom_alt: Column) -> Column:
    """(hom_ref, het, hom_alt) from the two stored probabilities; NULL if either is missing."""
    full = F.array((F.lit(1.0) - het - hom_alt).cast("float"), het.cast("float"), hom_alt.cast("float"))
    return F.when(het.isNotNull() & hom_alt.isNotNull(), full)


def dosage(het: Column, hom_alt: Column) -> Column:
    """Expected number of alternate alleles."""
    return (het + F.lit(2.0) * hom_alt).cast("float")


def quantise(p: Column) -> Column:
    """One byte per probability: 0 is missing, 1..255 cover 0..1."""
    code = F.when(~F.isnan(p), (F.lit(1) + F.rint(p * F.lit(254.0))).cast("short"))
    return F.coalesce(code, F.lit(0).cast("short"))


def dequantise(code: Column) -> Column:
    return F.when(code > 0, (code - 1) / F.lit(254.0))


def packed_calls(byte: Column) -> Column:
    """Four calls of one byte, lowest bits first, as copies of the second allele; NULL is missing."""
    pair = lambda i: F.shiftright(byte, i * 2).bitwiseAND(F.lit(3))
    copies = lambda c: F.when(c == 2, 1).when(c == 3, 2).when(c == 0, 0)
    return F.array(*[copies(pair(i)) for i in range(4)])
