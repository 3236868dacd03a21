"""Words, hashes and membership tests the operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.session import shared_path

# A word is a run of bytes other than space and the five ASCII control spaces, which is what
# bytes.split() cuts at as well; bytes.lower() changes A-Z only.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

MASK = (1 << 64) - 1
_MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)
BITMAP_BITS = 1 << 23
_PAGE = 32768  # bits in one page of Spark's bitmap functions


def binary(batch: pa.RecordBatch, name: str) -> list[bytes | None]:
    """A text or binary column as bytes, without decoding."""
    column = batch.column(batch.schema.get_field_index(name))
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


class WordHashes(dict):
    """64-bit hash of each word; forgets its words when there are too many, the hashes stay the same."""

    def __init__(self, most: int = 250_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def grams(ids: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words, from the words' hashes."""
    if len(ids) < size:
        return np.empty(0, np.uint64)
    total = np.zeros(len(ids) - size + 1, np.uint64)
    step = np.uint64(size)
    for j in range(size):
        total = mixed(total * _MULTIPLIERS[j % 5] + ids[j : len(ids) - size + 1 + j] + step)
    return total


_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)


def rolled(ids: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of ``size`` words at a cost that does not depend on ``size``."""
    n = len(ids)
    if n < size:
        return np.empty(0, np.uint64)
    power, inverse = np.full(n, _BASE, np.uint64), np.full(n, _INVERSE, np.uint64)
    power[0] = inverse[0] = 1
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(ids * np.cumprod(power, dtype=np.uint64), dtype=np.uint64)])
    return mixed((sums[size:] - sums[: n - size + 1]) * np.cumprod(inverse, dtype=np.uint64)[: n - size + 1])


def shingles(ids: np.ndarray, size: int = 5) -> np.ndarray:
    """The set of runs of ``size`` words, sorted; a shorter text is one run; no word, no run."""
    return np.unique(grams(ids, min(size, len(ids)))) if len(ids) else np.empty(0, np.uint64)


def batches(columns: dict[str, Iterable], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) for f in schema], schema=schema)


@contextmanager
def rows_per_batch(spark: SparkSession, rows: int) -> Iterator[None]:
    """Smaller Arrow batches for the jobs that run inside, whose rows are large."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(min(rows, int(before)) if int(before) > 0 else rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def bitmap(members: DataFrame, key: Column, bits: int = BITMAP_BITS) -> DataFrame:
    """One bit per hash value of the members, in pages of 4 KB: at most ``bits / 8`` bytes, however many members."""
    slot = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    return members.groupBy(F.bitmap_bucket_number(slot).alias("_page")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits"))


def maybe_member(df: DataFrame, key: Column, members: DataFrame, member_key: Column, bits: int = BITMAP_BITS) -> DataFrame:
    """Add ``_maybe``: false only for rows whose key is no member.

    The bitmap has a fixed size (1 MB by default), so it can be broadcast whatever the members'
    number; with very many members more rows are true, and exact joins behind it get more rows.
    """
    pages = bitmap(members, member_key, bits)
    slot = F.pmod(F.xxhash64(key), F.lit(bits)) + 1
    place = F.bitmap_bit_position(slot)
    byte = F.conv(F.hex(F.substring("_bits", (place / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    hit = F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    return df.withColumn("_page", F.bitmap_bucket_number(slot)).join(F.broadcast(pages), "_page", "left").withColumn("_maybe", hit).drop("_page", "_bits")


def document(id_column: str, text_column: str) -> Column:
    """64 bits that stand for an id with its text: rows that repeat an id with another text are other documents."""
    return F.xxhash64(F.col(f"`{id_column}`"), F.coalesce(F.col(f"`{text_column}`"), F.lit("")))


def give_back() -> None:
    """Return freed memory to the system, which a worker that is used again would hold on to."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # not every C library has it
    if trim:
        trim(0)


def without_ids(df: DataFrame, column: str | Column, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id, a column or an expression, is not in ``ids`` (one column, staged); only rows that may go are shuffled.

    Rows without an id stay. All columns of ``df`` are kept, whatever their names.
    """
    key = F.col(f"`{column}`") if isinstance(column, str) else column
    row = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), key.alias("_id"))
    tested = maybe_member(row, F.col("_id"), ids, F.col(ids.columns[0]))
    doubtful = tested.where("_maybe").join(ids.toDF("_gone"), F.col("_id") == F.col("_gone"), "left_anti")
    return tested.where("NOT _maybe").select("_row").union(doubtful.select("_row")).select("_row.*")


def with_ids(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose id is in ``ids`` (one column, staged); only rows that may stay are shuffled."""
    tested = maybe_member(df, F.col(column), ids, F.col(ids.columns[0])).where("_maybe").drop("_maybe")
    return tested.join(ids.toDF("_wanted"), F.col(column) == F.col("_wanted"), "left_semi")


def stage_in_buckets(df: DataFrame, column: str, n: int, label: str) -> DataFrame:
    """``stage`` as a table of ``n`` buckets of ``column``, written where its rows are: grouping it by the column moves none of them."""
    path = shared_path(df.sparkSession, label)
    name = "staged_" + path.rsplit("-", 1)[1]
    df.write.format("parquet").bucketBy(n, column).option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)
