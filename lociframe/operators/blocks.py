"""Calls as binaries, one per (variant, sample block), from ingest on: no table has a row per call.

Two kinds are stored. ``codes`` are one-byte probability codes, ``width`` of the heterozygous genotype followed by ``width`` of the
homozygous alternate one; 0 is missing, 1..255 cover 0..1, a call that is not there is missing. ``hard_calls`` are two-bit
calls as they come, four samples a byte and the lowest bits first: 0 and 3 are homozygous, 2 is heterozygous, 1 is missing.

A variant's calls of ``width`` consecutive samples make a block, so every value handed to Python is bounded by the width.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lociframe.functions import genotype as G

SAMPLE_WIDTH = 4096
CALL_KEYS = ["contig", "variant_index"]
BLOCK_KEYS = [*CALL_KEYS, "sample_block"]
MISSING_BYTE = 0b01010101  # four missing two-bit calls
_AT_ONCE = 512  # blocks made matrices of numbers at a time


# Packing ----------------------------------------------------------------------------------------


def _runs(batch: pa.RecordBatch, names: list[str], n_values: int) -> pa.RecordBatch:
    """Rows (names, pos, v0..) of a batch as one row per block it touches, the values as binaries."""
    keys = [batch[c] for c in names]
    codes = [k.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False) for k in keys]
    order = np.lexsort(codes[::-1])
    sorted_codes = [c[order] for c in codes]
    new = np.zeros(len(order), bool)
    new[:1] = True
    for c in sorted_codes:
        new[1:] |= c[1:] != c[:-1]
    starts = np.append(np.flatnonzero(new), len(order)).tolist()
    first = pa.array(order[starts[:-1]])

    def pieces(values: np.ndarray) -> pa.Array:
        raw, size = values[order].tobytes(), values.dtype.itemsize
        return pa.array([raw[a * size : b * size] for a, b in zip(starts, starts[1:])], pa.binary())

    values = [pieces(batch[f"v{i}"].to_numpy().astype(np.uint8)) for i in range(n_values)]
    return pa.RecordBatch.from_arrays([*[k.take(first) for k in keys], pieces(batch["pos"].to_numpy().astype("<u4")), *values], batch.schema.names)


def _gathered(rows: DataFrame, n_values: int, dense) -> DataFrame:
    """Rows (keys, pos, v0..) to blocks: packed where they are read, so that the shuffle carries bytes."""
    values = [f"v{i}" for i in range(n_values)]
    keys = [c for c in rows.columns if c not in ("pos", *values)]
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([*[T.StructField(k, kinds[k]) for k in keys], *[T.StructField(v, T.BinaryType()) for v in ("pos", *values)]])

    def pack(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (_runs(batch, keys, n_values) for batch in stream if batch.num_rows)

    @F.arrow_udf(T.BinaryType())
    def merge(pieces: pa.Array) -> pa.Array:
        out, offsets, flat = [], pieces.offsets.to_pylist(), pieces.flatten()
        columns = [flat.field(c).to_pylist() for c in ("pos", *values)]
        for a, b in zip(offsets, offsets[1:]):
            at = np.frombuffer(b"".join(columns[0][a:b]), "<u4")
            if len(np.unique(at)) != len(at):
                raise ValueError("a variant has more than one call of a sample")
            out.append(dense(at, [np.frombuffer(b"".join(c[a:b]), np.uint8) for c in columns[1:]]))
        return pa.array(out, pa.binary())

    partial = rows.select(*keys, "pos", *values).mapInArrow(pack, schema)
    together = partial.groupBy(*keys).agg(F.collect_list(F.struct("pos", *values)).alias("_pieces"))
    return together.select(*keys, merge("_pieces").alias("packed"))


def _placed(index: Column, width: int) -> list[Column]:
    return [F.floor(index / width).cast("long").alias("sample_block"), (index % width).cast("int").alias("pos")]


def pack_codes(probabilities: DataFrame, width: int = SAMPLE_WIDTH, gp: str = "gp", with_variant: tuple[str, ...] = ()) -> DataFrame:
    """Probabilities in rows (contig, variant_index, sample_index, gp) to blocks of codes.

    Columns ``with_variant``, which all calls of a variant have alike, stay with its blocks.
    """

    def dense(at: np.ndarray, values: list[np.ndarray]) -> bytes:
        block = np.zeros((2, width), np.uint8)
        block[:, at] = values
        return block.tobytes()

    codes = [F.coalesce(G.quantise(F.col(gp)[i]), F.lit(0)).cast("int").alias(f"v{i - 1}") for i in (1, 2)]
    rows = probabilities.select(*CALL_KEYS, *with_variant, *_placed(F.col("sample_index"), width), *codes)
    return _gathered(rows, 2, dense).withColumnRenamed("packed", "codes")


def pack_hard_calls(packed: DataFrame, width: int = SAMPLE_WIDTH) -> DataFrame:
    """Two-bit calls in rows (contig, variant_index, byte_index, byte) to blocks; ``width`` is a multiple of four."""
    size = width // 4

    def dense(at: np.ndarray, values: list[np.ndarray]) -> bytes:
        block = np.full(size, MISSING_BYTE, np.uint8)
        block[at] = values[0]
        return block.tobytes()

    byte = F.col("byte").cast("int").bitwiseAND(F.lit(255))
    rows = packed.select(*CALL_KEYS, *_placed(F.col("byte_index"), size), byte.alias("v0"))
    return _gathered(rows, 1, dense).withColumnRenamed("packed", "hard_calls")


# Counting and reading ---------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _genotypes() -> np.ndarray:
    """Genotype of each pair of codes, at 256 x het + alt: the most probable one, the first on ties; 3 if missing."""
    het, alt = np.divmod(np.arange(1 << 16), 256)
    het_p, alt_p = het - 1, alt - 1
    ref_p = 254 - het_p - alt_p
    called = np.where(ref_p >= np.maximum(het_p, alt_p), 0, np.where(het_p >= alt_p, 1, 2))
    return np.where((het == 0) | (alt == 0), 3, called).astype(np.uint8)


@lru_cache(maxsize=1)
def _code_dosages() -> np.ndarray:
    """Dosage of each pair of codes; NaN if missing."""
    het, alt = np.divmod(np.arange(1 << 16), 256)
    dosage = ((het - 1) + 2 * (alt - 1)) / 254
    return np.where((het == 0) | (alt == 0), np.nan, dosage).astype(np.float32)


def _pairs(blocks: list[bytes]) -> np.ndarray:
    """Code pairs of blocks as one number each, a row per block."""
    codes = np.frombuffer(b"".join(blocks), np.uint8).reshape(len(blocks), 2, -1)
    return (codes[:, 0].astype(np.uint16) << 8) | codes[:, 1]


def dosages_of_codes(blocks: list[bytes]) -> np.ndarray:
    return _code_dosages()[_pairs(blocks)]


_COUNTS = "struct<n_het: long, n_hom_ref: long, n_hom_alt: long, n_missing: long>"
_COUNT_NAMES = ["n_het", "n_hom_ref", "n_hom_alt", "n_missing"]


def _counts(columns: list[list[np.ndarray]]) -> pa.Array:
    return pa.StructArray.from_arrays([pa.array(np.concatenate(c) if c else [], pa.int64()) for c in columns], _COUNT_NAMES)


def _summed(blocks: DataFrame, counted: Column, keys: tuple[str, ...], names: list[str]) -> DataFrame:
    per_block = blocks.select(*keys, counted.alias("_n"))
    return per_block.groupBy(*keys).agg(*[F.sum(f"_n.{n}").alias(n) for n in names])


def count_codes(blocks: DataFrame, keys: tuple[str, ...] = tuple(CALL_KEYS)) -> DataFrame:
    """Calls per genotype and variant from blocks of codes; missing and absent calls do not count."""

    @F.arrow_udf(_COUNTS)
    def count(codes: pa.Array) -> pa.Array:
        columns, table = [[], [], [], []], _genotypes()
        for at in range(0, len(codes), _AT_ONCE):
            called = table[_pairs(codes[at : at + _AT_ONCE].to_pylist())]
            for column, kind in zip(columns, (1, 0, 2, 3)):
                column.append(np.count_nonzero(called == kind, axis=1))
        return _counts(columns)

    return _summed(blocks, count("codes"), keys, _COUNT_NAMES[:3])


def count_hard_calls(blocks: DataFrame, n_samples: int, keys: tuple[str, ...] = tuple(CALL_KEYS), width: int = SAMPLE_WIDTH) -> DataFrame:
    """Calls per genotype and variant from blocks of two-bit calls, by their bit planes; ``n_missing`` counts all others.

    Slots after the last of ``n_samples`` are padding, whatever their bits.
    """

    @F.arrow_udf(_COUNTS)
    def count(calls: pa.Array, block: pa.Array) -> pa.Array:
        columns = [[], [], [], []]
        for at in range(0, len(calls), _AT_ONCE):
            part = calls[at : at + _AT_ONCE].to_pylist()
            bits = np.frombuffer(b"".join(part), np.uint8).reshape(len(part), -1)
            real = np.clip(n_samples - block[at : at + _AT_ONCE].to_numpy() * width, 0, width)
            # One set bit per real sample, at the lower bit of its slot.
            slots = (np.arange(width)[None, :] < real[:, None]).reshape(len(part), -1, 4)
            mask = (slots << np.array([0, 2, 4, 6])).sum(axis=2).astype(np.uint8)
            low, high = bits & mask, (bits >> 1) & mask
            ones = [np.bitwise_count(plane).sum(axis=1, dtype=np.int64) for plane in (high & ~low, high & low, low & ~high)]
            for column, n in zip(columns, (ones[0], real - sum(ones), ones[1], ones[2])):
                column.append(n)
        return _counts(columns)

    found = _summed(blocks, count("hard_calls", "sample_block"), keys, _COUNT_NAMES[:3])
    return found.withColumn("n_missing", F.lit(n_samples) - F.col("n_het") - F.col("n_hom_ref") - F.col("n_hom_alt"))


def codes_of_hard_calls(blocks: DataFrame, width: int = SAMPLE_WIDTH) -> DataFrame:
    """Two-bit blocks as blocks of codes, for what takes probabilities: certain genotypes, missing ones missing."""
    # Codes of the calls 0 (homozygous first), 1 (missing), 2 (heterozygous), 3 (homozygous second).
    het, alt = np.array([1, 0, 255, 1], np.uint8), np.array([1, 0, 1, 255], np.uint8)

    @F.arrow_udf(T.BinaryType())
    def widen(calls: pa.Array) -> pa.Array:
        out = []
        for block in calls.to_pylist():
            bits = np.frombuffer(block, np.uint8)
            call = ((bits[:, None] >> np.array([0, 2, 4, 6], np.uint8)) & 3).ravel()
            out.append(np.concatenate([het[call], alt[call]]).tobytes())
        return pa.array(out, pa.binary())

    return blocks.select(*[c for c in blocks.columns if c != "hard_calls"], widen("hard_calls").alias("codes"))


def keep_samples(blocks: DataFrame, samples: DataFrame, width: int = SAMPLE_WIDTH) -> DataFrame:
    """Blocks of codes with the calls of other samples missing; a block without a kept sample goes.

    There is one mask of ``width`` bytes per sample block: half a megabyte for half a million samples, so the join does
    not move the calls unless the cohort is far larger.
    """

    @F.arrow_udf(T.BinaryType())
    def as_mask(positions: pa.Array) -> pa.Array:
        out = []
        for at in positions.to_pylist():
            mask = np.zeros((2, width), np.uint8)
            mask[:, at] = 255
            out.append(mask.tobytes())
        return pa.array(out, pa.binary())

    @F.arrow_udf(T.BinaryType())
    def masked(codes: pa.Array, mask: pa.Array) -> pa.Array:
        out = [(np.frombuffer(c, np.uint8) & np.frombuffer(m, np.uint8)).tobytes() for c, m in zip(codes.to_pylist(), mask.to_pylist())]
        return pa.array(out, pa.binary())

    masks = samples.select(*_placed(F.col("sample_index"), width)).groupBy("sample_block").agg(F.collect_list("pos").alias("_at"))
    masks = masks.select("sample_block", as_mask("_at").alias("_mask"))
    return blocks.join(masks, "sample_block").select(*BLOCK_KEYS, masked("codes", "_mask").alias("codes"))
