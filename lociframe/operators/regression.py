"""Linear regression of every trait on every variant, adjusted for covariates.

For each trait batch the intercept and covariates are orthonormalised over the complete cases (Q)
and projected out of the traits. A variant's effect then needs only three kinds of sums over
samples: g.g, g.q and g.y. The steps are:

1. ``design``    samples x batches: covariates and trait values of the complete cases
2. ``moments``   per (batch, sample block): X'X and X'Y, added up by Spark
3. ``solve``     per batch: the k x k factor and the trait coefficients; batches with too few
                 complete cases end here
4. ``residuals`` per (batch, sample): Q and the trait residuals
5. ``contract``  the sums per (variant, batch). ``contract_stored`` takes blocks laid out by variant block: a
                 task goes through a variant block's sample blocks, multiplies matrices and adds up in memory, so
                 neither calls nor sums are shuffled. Calls in rows are shuffled to wide variant blocks and meet the same
                 matrices there (``contract_rows``). Packed blocks without that layout are cogrouped with sample rows
                 by (variant block, sample block), and partial sums are added by Spark
6. ``finish``    beta, t and p as column arithmetic. All joins and the one exchange of the results come before a row per
                 trait is made, when a batch of 100 traits is still one row per variant

Samples are cut into blocks of fixed width and variants into blocks by hash, so every group handed
to Python is bounded by the block widths, whatever the size of the cohort. The calls are shuffled
once per pass of about ``columns_per_pass`` columns, not once per batch; summing them with one built-in aggregate per
(batch, column) instead was measured at a tenth of the speed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.dataset
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from lociframe.functions.pvalues import t_p_value
from lociframe.operators.blocks import CALL_KEYS, SAMPLE_WIDTH, dosages_of_codes
from lociframe.operators.layout import BUCKET, ORDER, VARIANT_WIDTH
from lociframe.operators.reshape import array_items
from lociframe.operators.traits import MIN_SAMPLES, complete_cases
from lociframe.session import shared_path, stage

N_COMPONENTS = 20
RANK_TOLERANCE = 1e-10
MONOMORPHIC_TOLERANCE = 1e-12
FILL_FOR_PRODUCT = 0.05


@dataclass(frozen=True)
class Shape:
    """Sizes fixed before the run: covariates, largest batch, and tile widths.

    ``n_covariates`` leaves the intercept out. A tile holds ``variant_width`` x ``sample_width``
    dosages and meets about ``columns_per_pass`` sample-side columns at a time. Per pass the
    calls are shuffled once, and both the sample side and the partial sums come to
    2 x columns / width of their volume in 4-byte floats: with these widths as much again each for
    a full pass, and little for a few traits. Calls in rows are too few in a tile for that: their tiles are widened until
    a task's sums come to ``sums_bytes`` and a matrix of the sample side to ``matrix_bytes``. Each matrix is read by at most
    ``most_blocks`` variant blocks: with more variants the blocks get wider, see ``row_tiles``.
    """

    n_covariates: int
    batch_size: int
    sample_width: int = SAMPLE_WIDTH
    variant_width: int = VARIANT_WIDTH
    columns_per_pass: int = 2048
    sums_bytes: int = 8 << 20
    matrix_bytes: int = 8 << 20
    most_blocks: int = 32

    @property
    def k(self) -> int:
        return self.n_covariates + 1

    @property
    def n_sums(self) -> int:
        return self.k + self.batch_size

    @property
    def held_bytes(self) -> int:
        """Most that the sums of calls in rows take in a task before a block is shared by several."""
        return 8 * self.sums_bytes


def _names(prefix: str, shape: Shape) -> list[str]:
    return [f"{prefix}{i}" for i in range(shape.n_sums)]


# Covariates


def covariate_vector(samples: DataFrame, npc: int = N_COMPONENTS, name: str = "covariate") -> DataFrame:
    """Age, age^2, sex, sex x age, sex x age^2 and the first ``npc`` principal components as one vector."""
    age, sex = F.col("age_at_recruitment").cast("double"), F.col("genetic_sex").cast("double")
    age2 = F.pow(age, 2)
    derived = F.array(age, age2, sex, sex * age, sex * age2)
    return samples.withColumn(name, F.concat(derived, F.slice("principal_component", 1, npc)))


def standardise(samples: DataFrame, n: int, name: str = "covariate") -> DataFrame:
    """Centre and scale each of ``n`` vector elements by its mean and population deviation.

    One aggregate gives one row of 2n numbers; it enters the projection as a scalar subquery.
    A constant element gives NULL, which ``checks.require_finite_vector`` reports.
    """
    items = array_items(F.col(name), n)
    stats = samples.agg(
        F.array(*[F.struct(F.avg(x).alias("mean"), F.stddev_pop(x).alias("std")) for x in items])
    ).scalar()
    scaled = [F.try_divide(x - F.col("_stats")[i]["mean"], F.col("_stats")[i]["std"]) for i, x in enumerate(items)]
    return samples.withColumn("_stats", stats).withColumn(name, F.array(*scaled)).drop("_stats")


# Sample side


def _place(width: int) -> tuple[Column, Column]:
    """Block and position of a sample index."""
    index = F.col("sample_index")
    return F.floor(index / width).cast("long").alias("sample_block"), (index % width).cast("int").alias("pos")


def design(trait_values: DataFrame, batches: DataFrame, samples: DataFrame, shape: Shape) -> DataFrame:
    """Complete cases of all batches with their covariates, placed in sample blocks.

    ``samples`` has sample_id, sample_index and covariate.
    """
    placed = samples.select("sample_id", *_place(shape.sample_width), F.col("covariate").alias("x"))
    cases = complete_cases(trait_values, batches).join(placed, "sample_id")
    return cases.select("batch_key", "sample_block", "pos", "x", "y")


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    """A list column with lists of one length as a matrix."""
    values = column.combine_chunks()
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _matrices(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    x = _vectors(rows["x"])
    return np.column_stack([np.ones(len(x)), x]), _vectors(rows["y"])


def moments(rows: DataFrame) -> DataFrame:
    """X'X and X'Y of each (batch, sample block), flattened into one vector."""

    def block(key: tuple, table: pa.Table) -> pa.Table:
        x, y = _matrices(table)
        flat = np.concatenate([(x.T @ x).ravel(), (x.T @ y).ravel()])
        return pa.table({"batch_key": [key[0].as_py()], "sample_block": [key[1].as_py()], "flat": [flat]})

    return rows.groupBy("batch_key", "sample_block").applyInArrow(
        block, "batch_key string, sample_block long, flat array<double>"
    )


def solve(block_moments: DataFrame, k: int) -> DataFrame:
    """Per batch: complete cases, rank, the factor R^-1 (k x k) and the trait coefficients (k x t).

    Block moments are added element by element with map-side sums; a batch's total is a vector of
    fixed length k (k + t). A collinear covariate takes no part: its factor column is zero.
    """

    @F.pandas_udf("n long, rank int, factor array<double>, coef array<double>")
    def factorise(flat: pd.Series) -> pd.DataFrame:
        out = []
        for v in flat:
            v = np.asarray(v, dtype=float)
            gram, xy = v[: k * k].reshape(k, k), v[k * k :].reshape(k, -1)
            scale = 1 / np.sqrt(np.where(np.diag(gram) > 0, np.diag(gram), 1.0))
            values, vectors = np.linalg.eigh(gram * np.outer(scale, scale))
            used = values > RANK_TOLERANCE * values.max()
            factor = scale[:, None] * vectors * np.where(used, 1 / np.sqrt(np.where(used, values, 1.0)), 0.0)
            out.append((round(gram[0, 0]), int(used.sum()), factor.ravel(), (factor @ (factor.T @ xy)).ravel()))
        return pd.DataFrame(out, columns=["n", "rank", "factor", "coef"])

    total = (
        block_moments.select("batch_key", F.posexplode("flat").alias("i", "v"))
        .groupBy("batch_key", "i")
        .agg(F.sum("v").alias("v"))
        .groupBy("batch_key")
        .agg(F.array_sort(F.collect_list(F.struct("i", "v"))).alias("m"))
    )
    return total.select("batch_key", factorise(F.col("m.v")).alias("s")).select("batch_key", "s.*")


def residuals(rows: DataFrame, solved: DataFrame, shape: Shape) -> DataFrame:
    """Per (batch, sample): its place and one column per number, first Q, then the trait residuals.

    A batch smaller than ``batch_size`` leaves the last columns zero.
    """
    k, names = shape.k, _names("z", shape)
    blocks = rows.select("batch_key", "sample_block").distinct()
    by_block = blocks.join(solved.select("batch_key", "factor", "coef"), "batch_key")
    by_block = by_block.toDF("batch_key", "sample_block", "factor", "coef")

    schema = T.StructType(
        [
            T.StructField("batch_key", T.StringType()),
            T.StructField("sample_block", T.LongType()),
            T.StructField("pos", T.IntegerType()),
            *[T.StructField(n, T.DoubleType()) for n in names],
        ]
    )
    empty = to_arrow_schema(schema).empty_table()

    def block(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty
        x, y = _matrices(left)
        factor, coef = (_vectors(right[c])[0].reshape(k, -1) for c in ("factor", "coef"))
        z = np.zeros((len(x), shape.n_sums), order="F")
        z[:, :k] = x @ factor
        z[:, k : k + y.shape[1]] = y - x @ coef
        columns = {"batch_key": left["batch_key"], "sample_block": left["sample_block"], "pos": left["pos"]}
        return pa.table({**columns, **{n: z[:, j] for j, n in enumerate(names)}})

    keys = ["batch_key", "sample_block"]
    return rows.groupBy(*keys).cogroup(by_block.groupBy(*keys)).applyInArrow(block, schema)


# Contraction

def pack_blocks(calls: DataFrame, width: int = SAMPLE_WIDTH) -> DataFrame:
    """Calls in rows to one row per (variant, sample block): the stored form of dense dosages.

    ``dosage`` is a binary of ``width`` 4-byte floats in sample order, NaN where there is no call;
    ``width`` must be the ``sample_width`` of the run. Binaries go to Python as they are, which is
    over twice as fast as arrays of numbers.
    """

    @F.arrow_udf(T.BinaryType())
    def pack(block: pa.Array) -> pa.Array:
        lengths = np.diff(block.offsets.to_numpy())
        flat = block.flatten()
        _require_single(np.repeat(np.arange(len(lengths)), lengths) * width + flat.field("pos").to_numpy())
        dense = np.full((len(lengths), width), np.nan, dtype="<f4")
        dense[np.repeat(np.arange(len(lengths)), lengths), flat.field("pos").to_numpy()] = _numbers(flat.field("dosage"))
        return pa.array([row.tobytes() for row in dense], pa.binary())

    placed = calls.select(*CALL_KEYS, *_place(width), F.col("dosage").cast("float").alias("dosage"))
    blocks = placed.groupBy(*CALL_KEYS, "sample_block").agg(F.collect_list(F.struct("pos", "dosage")).alias("block"))
    return blocks.select(*CALL_KEYS, "sample_block", pack("block").alias("dosage"))


def _require_single(places: np.ndarray) -> None:
    """A variant and sample with two calls is an error, whichever way the calls are added."""
    if len(np.unique(places)) != len(places):
        raise ValueError("a variant has more than one call of a sample")


def _numbers(values: pa.Array) -> np.ndarray:
    """Doubles with NaN for NULL."""
    return values.cast(pa.float64()).to_numpy(zero_copy_only=False)


def _dense_sums(calls: pa.Table, columns: np.ndarray, member: np.ndarray) -> tuple:
    """Variants of a tile of packed blocks; their sums over samples of g x columns, g^2 and missing g."""
    width = len(columns)
    n, blocks = calls.num_rows, calls["dosage"].combine_chunks()
    if (np.asarray(pc.binary_length(blocks)) != 4 * width).any():
        raise ValueError(f"packed blocks are not {width} samples wide: pack and run with the same sample_width")
    sums, gg, n_bad = np.zeros((n, columns.shape[1])), np.zeros((n, member.shape[1])), np.zeros((n, member.shape[1]))
    for at in range(0, n, 512):  # doubles of some rows at a time
        part = slice(at, min(at + 512, n))
        g = np.stack([np.frombuffer(b.as_buffer(), dtype="<f4", count=width) for b in blocks[part]]).astype(float)
        bad = ~np.isfinite(g)
        if bad.any():
            n_bad[part] = bad @ member
            g[bad] = 0.0
        sums[part] = g @ columns
        gg[part] = np.square(g, out=g) @ member
    return calls.select(CALL_KEYS), sums, gg, n_bad


def _sparse_sums(calls: pa.Table, columns: np.ndarray, member: np.ndarray) -> tuple:
    """The same from calls in rows. A well filled tile is made dense, otherwise called rows are added up."""
    contig = calls["contig"].combine_chunks().dictionary_encode()
    code = calls["variant_index"].to_numpy().astype(np.int64) * len(contig.dictionary)
    code = code + contig.indices.to_numpy(zero_copy_only=False)
    _, first, row = np.unique(code, return_index=True, return_inverse=True)
    order = np.argsort(row, kind="stable")
    row, pos = row[order], calls["pos"].to_numpy()[order]
    g = _numbers(calls["dosage"].combine_chunks())[order]
    bad = ~np.isfinite(g)
    g = np.where(bad, 0.0, g)
    _require_single(row * len(columns) + pos)
    variants = calls.select(CALL_KEYS).take(pa.array(first))
    if len(row) > FILL_FOR_PRODUCT * len(first) * len(columns):
        tile, missing = np.zeros((2, len(first), len(columns)))
        tile[row, pos], missing[row, pos] = g, bad
        return variants, tile @ columns, (tile * tile) @ member, missing @ member
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])

    def add(weight: np.ndarray, over: np.ndarray) -> np.ndarray:
        out, at = [], 0
        step = max(1, (1 << 22) // max(1, over.shape[1]))
        while at < len(starts):  # whole variants, some four million products at a time
            to = max(at + 1, int(np.searchsorted(starts, starts[at] + step)))
            part = slice(starts[at], starts[to] if to < len(starts) else None)
            out.append(np.add.reduceat(over[pos[part]] * weight[part, None], starts[at:to] - starts[at]))
            at = to
        return np.concatenate(out)

    return variants, add(g, columns), add(g * g, member), add(bad.astype(float), member)


def contract(calls: DataFrame, adjusted: DataFrame, shape: Shape, n_variants: int) -> DataFrame:
    """Sums per (variant, batch) from calls in packed blocks, or in rows, for which see ``contract_rows``.

    Variants are spread over ceil(n_variants / variant_width) blocks by hash, so no block is hot.
    The sample side goes to every variant block, the calls to every pass (see ``Shape``). There is
    about one task per tile, so that their number follows the data and not a session default.
    """
    if "sample_block" not in calls.columns:
        return contract_rows(calls, adjusted, shape, n_variants)
    extent = adjusted.agg(F.countDistinct("batch_key").alias("batches"), F.countDistinct("sample_block").alias("blocks")).first()
    n_blocks = max(1, -(-n_variants // shape.variant_width))
    n_passes = max(1, -(-extent.batches * shape.n_sums // shape.columns_per_pass))
    n_tasks = max(2, n_blocks * n_passes * extent.blocks)
    m, width = shape.n_sums, shape.sample_width
    z_names, s_names = _names("z", shape), _names("s", shape)
    schema = _sums_schema(calls, s_names)
    empty = to_arrow_schema(schema).empty_table()

    def tile(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return empty
        batch = right["batch_key"].combine_chunks().dictionary_encode()
        b = len(batch.dictionary)
        where = right["pos"].to_numpy(), batch.indices.to_numpy(zero_copy_only=False)
        z, member = np.zeros((width, b, m)), np.zeros((width, b))
        for j, name in enumerate(z_names):
            z[(*where, j)] = right[name].to_numpy()
        member[where] = 1.0
        variants, sums, gg, n_bad = _dense_sums(left, z.reshape(width, b * m), member)
        n = variants.num_rows
        sums = np.asfortranarray(sums.reshape(n * b, m))
        each = pa.array(np.repeat(np.arange(n), b))
        out = {
            **{c: variants[c].take(each) for c in CALL_KEYS},
            "batch_key": batch.dictionary.take(pa.array(np.tile(np.arange(b), n))),
            "gg": gg.ravel(),
            "n_bad": n_bad.ravel(),
            **{name: sums[:, j] for j, name in enumerate(s_names)},
        }
        return pa.table(out)

    left = calls.select(
        *CALL_KEYS, "sample_block", "dosage", _hashed(n_blocks, *CALL_KEYS).alias("variant_block"), _every(n_passes, *CALL_KEYS).alias("pass")
    )
    right = adjusted.select("*", _hashed(n_passes, "batch_key").alias("pass"), _every(n_blocks, "batch_key").alias("variant_block"))
    keys = ["variant_block", "sample_block", "pass"]
    left, right = (side.repartition(n_tasks, *keys) for side in (left, right))
    partial = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(tile, schema)
    return partial.groupBy(*CALL_KEYS, "batch_key").agg(*[F.sum(n).alias(n) for n in ("gg", "n_bad", *s_names)])


def _hashed(n: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def _every(n: int, *columns: str) -> Column:
    # With n = 1 also a computed zero: Spark loses a partitioning by literals.
    return F.explode(F.sequence(F.lit(0), F.lit(n - 1))) if n > 1 else _hashed(1, *columns)


def _sums_schema(calls: DataFrame, s_names: list[str]) -> T.StructType:
    return T.StructType(
        [
            *[T.StructField(c, calls.schema[c].dataType) for c in CALL_KEYS],
            T.StructField("batch_key", T.StringType()),
            T.StructField("gg", T.DoubleType()),
            T.StructField("n_bad", T.DoubleType()),
            *[T.StructField(n, T.DoubleType()) for n in s_names],
        ]
    )


def row_tiles(shape: Shape, n_variants: int, n_batches: int, n_sample_blocks: int) -> tuple[int, int, int]:
    """Variant blocks, stretches of sample blocks that share one, and sample blocks per matrix, for ``n_batches`` in a pass.

    Blocks hold ``sums_bytes`` of sums each. Every block reads the whole sample side, so their number must not grow with the
    variants: beyond ``most_blocks`` they get wider instead, up to ``held_bytes``, and beyond that are cut into stretches, each of
    which reads its own sample blocks only. So the reads grow with the samples alone, and a task adds up no more than its calls.
    """
    per_variant = n_batches * (shape.n_sums + 2) * 8
    n_blocks = max(1, -(-n_variants // max(1, shape.sums_bytes // per_variant)))
    n_stripes = 1 if n_blocks > 1 else shape.sums_bytes // (max(1, n_variants) * per_variant)
    if n_blocks > shape.most_blocks:
        n_blocks = shape.most_blocks
        n_stripes = -(-n_variants * per_variant // (n_blocks * shape.held_bytes))
    n_stripes = max(1, min(n_sample_blocks, n_stripes))
    together = max(1, min(shape.matrix_bytes // (shape.sample_width * per_variant), n_sample_blocks // n_stripes))
    return n_blocks, n_stripes, together


def contract_rows(calls: DataFrame, adjusted: DataFrame, shape: Shape, n_variants: int) -> DataFrame:
    """Sums per (variant, batch) from calls in rows. A call that is not there has dosage zero, and a variant without calls
    among a batch's complete cases has no sums.

    Sparse calls are so few in a tile that sending the sample side to every variant block, or a sum for every call to its
    variant, would outweigh them by far. So only the calls are shuffled, to variant blocks as wide as ``sums_bytes`` allow,
    in order of sample block. A task streams them past the matrices of the sample side, which it reads one at a time,
    and adds up in memory. Where few variants have many samples, or very many variants are, several tasks share a variant block, each
    with a stretch of sample blocks (``row_tiles``); sums that outgrow ``held_bytes`` there are passed on in parts.
    """
    extent = adjusted.agg(
        F.countDistinct("batch_key").alias("batches"), F.countDistinct("sample_block").alias("blocks"), F.max("sample_block").alias("last")
    ).first()
    m, s_names = shape.n_sums, _names("s", shape)
    n_passes = max(1, -(-extent.batches * m // shape.columns_per_pass))
    n_blocks, n_stripes, together = row_tiles(shape, n_variants, max(1, -(-extent.batches // n_passes)), extent.blocks)
    most = shape.held_bytes if n_stripes > 1 else None
    width = shape.sample_width * together
    matrices = _sample_matrices(adjusted, shape, n_passes, together)
    per_stripe = max(1, -(-((extent.last or 0) // together + 1) // n_stripes))
    schema = _sums_schema(calls, s_names)
    arrow_schema = to_arrow_schema(schema)

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = fs.FileSystem.from_uri(matrices)
        held, task, sums = _Sums(m), None, None
        block, loaded, last = None, None, None
        waiting: list[pa.RecordBatch] = []

        def add() -> None:
            if loaded is not None and waiting:
                names, z, member = loaded
                variants, *found = _sparse_sums(pa.Table.from_batches(waiting), z, member)
                held.add(list(zip(variants["contig"].to_pylist(), variants["variant_index"].to_pylist())), names, *found)
            waiting.clear()

        for rows in batches:
            tasks, blocks = rows["task"].to_numpy(), rows["sample_block"].to_numpy()
            cuts = [0, *(np.flatnonzero((np.diff(blocks) != 0) | (np.diff(tasks) != 0)) + 1), len(blocks)]
            for a, c in zip(cuts, cuts[1:]):
                if a == c:
                    continue
                if (tasks[a], blocks[a]) != (task, block):
                    add()
                    if task is not None and (tasks[a] != task or (most and held.nbytes > most)):
                        yield from held.batches(arrow_schema)
                        held = _Sums(m)
                    task, block, last = tasks[a], blocks[a], None
                    loaded = _matrix(system, folder, int(task) % n_passes, int(block), width, m)
                part = rows.slice(a, c - a)
                ends = [tuple(part[n][i].as_py() for n in (*CALL_KEYS, "pos")) for i in (0, c - a - 1)]
                if ends[0] == last:
                    raise ValueError("a variant has more than one call of a sample")
                last = ends[1]
                waiting.append(part)
                if sum(w.num_rows for w in waiting) > 200_000:
                    add()
        add()
        yield from held.batches(arrow_schema)

    stripe = F.least(F.floor(F.col("sample_block") / per_stripe), F.lit(n_stripes - 1))
    part = (_hashed(n_blocks, *CALL_KEYS) * n_stripes + stripe) * n_passes + F.col("pass")
    placed = calls.filter(F.col("sample_index").isNotNull()).select(*CALL_KEYS, *_place(width), F.col("dosage").cast("double").alias("dosage"))
    placed = placed.withColumn("pass", _every(n_passes, *CALL_KEYS)).withColumn("task", part.cast("int")).drop("pass")
    # In order of sample block, and within it so that two calls of a variant and sample follow each other.
    ordered = placed.repartitionById(n_blocks * n_stripes * n_passes, "task").sortWithinPartitions("task", "sample_block", *CALL_KEYS, "pos")
    sums = ordered.mapInArrow(stream, schema)
    if n_stripes > 1:
        sums = sums.groupBy(*CALL_KEYS, "batch_key").agg(*[F.sum(n).alias(n) for n in ("gg", "n_bad", *s_names)])
    return sums.filter((F.col("gg") > 0) | (F.col("n_bad") > 0))


class _Sums:
    """Sums per (variant, batch) of one task, which grow with the variants and batches met."""

    def __init__(self, m: int):
        self.m = m
        self.place: dict[tuple, int] = {}  # variant -> row of the sums
        self.batch_at: dict[str, int] = {}
        self.sums, self.extra = np.zeros((0, 0, m)), np.zeros((0, 0, 2))

    def cell(self, keys: list[tuple], names: list[str]) -> tuple:
        """Where the sums of these variants and batches are."""
        where = [self.place.setdefault(k, len(self.place)) for k in keys]
        columns = [self.batch_at.setdefault(n, len(self.batch_at)) for n in names]
        grown = max(len(self.sums), 1 << (len(self.place) - 1).bit_length()), max(self.sums.shape[1], len(self.batch_at))
        if grown != self.sums.shape[:2]:
            more = [(0, grown[0] - len(self.sums)), (0, grown[1] - self.sums.shape[1]), (0, 0)]
            self.sums, self.extra = np.pad(self.sums, more), np.pad(self.extra, more)
        return np.ix_(np.array(where), np.array(columns))

    def add(self, keys: list[tuple], names: list[str], sums: np.ndarray, gg: np.ndarray, n_bad: np.ndarray) -> None:
        cell = self.cell(keys, names)
        self.sums[cell] += sums.reshape(len(keys), len(names), self.m)
        self.extra[(*cell, 0)] += gg
        self.extra[(*cell, 1)] += n_bad

    @property
    def nbytes(self) -> int:
        return self.sums.nbytes + self.extra.nbytes

    def batches(self, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
        n, b = len(self.place), len(self.batch_at)
        if not n or not b:
            return
        contig, index = zip(*self.place)
        each = pa.array(np.repeat(np.arange(n), b))
        out = [
            pa.array(contig, schema.field("contig").type).take(each),
            pa.array(index, schema.field("variant_index").type).take(each),
            pa.array(list(self.batch_at) * n, pa.string()),
            pa.array(self.extra[:n, :b, 0].ravel()),
            pa.array(self.extra[:n, :b, 1].ravel()),
            *[pa.array(self.sums[:n, :b, j].ravel()) for j in range(self.m)],
        ]
        yield pa.RecordBatch.from_arrays(out, schema=schema)


def _matrix(system: fs.FileSystem, folder: str, number: int, block: int, width: int, m: int) -> tuple | None:
    """Batches, numbers and members of a sample block in pass ``number``."""
    place = f"{folder}/pass={number}/sample_block={block}"
    if system.get_file_info(place).type == fs.FileType.NotFound:
        return None  # no complete case has a sample here
    row = pyarrow.dataset.dataset(place, filesystem=system, format="parquet").to_table(columns=["batches", "z", "member"]).to_pylist()[0]
    b = len(row["batches"])
    return row["batches"], np.frombuffer(row["z"]).reshape(width, b * m), np.frombuffer(row["member"]).reshape(width, b)


def _sample_matrices(adjusted: DataFrame, shape: Shape, n_passes: int, together: int = 1) -> str:
    """The sample side as one matrix per (pass, sample block), written as files of the shared folder; their path.

    A matrix is ``together`` times ``sample_width`` by the columns of a pass, doubles, with zeros for samples outside a batch;
    ``member`` says who is inside. A block's file is read by every task of the contraction, one block at a time.
    """
    m, width, z_names = shape.n_sums, shape.sample_width * together, _names("z", shape)
    if together > 1:
        pos = (F.col("sample_block") % together * shape.sample_width + F.col("pos")).cast("int")
        adjusted = adjusted.withColumns({"pos": pos, "sample_block": F.floor(F.col("sample_block") / together)})

    def build(key: tuple, rows: pa.Table) -> pa.Table:
        batch = rows["batch_key"].combine_chunks().dictionary_encode()
        b = len(batch.dictionary)
        where = rows["pos"].to_numpy(), batch.indices.to_numpy(zero_copy_only=False)
        z, member = np.zeros((width, b, m)), np.zeros((width, b))
        for j, name in enumerate(z_names):
            z[(*where, j)] = rows[name].to_numpy()
        member[where] = 1.0
        packed = [pa.array([v.tobytes()], pa.large_binary()).cast(pa.binary()) for v in (z, member)]
        return pa.table([*[pa.array([k.as_py()], k.type) for k in key], pa.array([batch.dictionary.to_pylist()]), *packed], ["pass", "sample_block", "batches", "z", "member"])

    path = shared_path(adjusted.sparkSession, "sample-matrices")
    placed = adjusted.withColumn("pass", F.pmod(F.xxhash64("batch_key"), F.lit(n_passes)).cast("int"))
    matrices = placed.groupBy("pass", "sample_block").applyInArrow(build, "pass int, sample_block long, batches array<string>, z binary, member binary")
    matrices.write.partitionBy("pass", "sample_block").parquet(path)
    return path


def contract_stored(calls: DataFrame, adjusted: DataFrame, shape: Shape) -> DataFrame:
    """Sums per (variant, batch) from blocks in the layout of ``layout.write_layout``.

    A variant block is one group, which its bucket already holds, so a pass scans the calls and exchanges nothing. The
    group streams by sample block: only a stretch of calls, one matrix of the sample side and the block's sums
    are in memory at a time, whatever the cohort.
    """
    spark = calls.sparkSession
    extent = adjusted.agg(F.countDistinct("batch_key").alias("batches")).first()
    n_passes = max(1, -(-extent.batches * shape.n_sums // shape.columns_per_pass))
    matrices = _sample_matrices(adjusted, shape, n_passes)
    m, width, s_names = shape.n_sums, shape.sample_width, _names("s", shape)
    value = "codes" if "codes" in calls.columns else "dosage"
    schema = _sums_schema(calls, s_names)
    arrow_schema = to_arrow_schema(schema)

    def numbers(blocks: pa.Array) -> np.ndarray:
        if (np.asarray(pc.binary_length(blocks)) != width * (2 if value == "codes" else 4)).any():
            raise ValueError(f"packed blocks are not {width} samples wide: pack and run with the same sample_width")
        held = blocks.to_pylist()
        return (dosages_of_codes(held) if value == "codes" else np.frombuffer(b"".join(held), "<f4").reshape(len(held), -1)).astype(float)

    def one_pass(number: int) -> DataFrame:
        def stream(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            system, folder = fs.FileSystem.from_uri(matrices)
            held = _Sums(m)
            seen: set[tuple] = set()
            block, loaded = None, None
            for rows in groups:
                blocks = rows["sample_block"].to_numpy()
                cuts = [0, *(np.flatnonzero(np.diff(blocks)) + 1), len(blocks)]
                for a, c in zip(cuts, cuts[1:]):
                    if a == c:
                        continue
                    if blocks[a] != block:
                        block, seen = blocks[a], set()
                        loaded = _matrix(system, folder, number, block, width, m)
                    keys = list(zip(rows["contig"][a:c].to_pylist(), rows["variant_index"][a:c].to_pylist()))
                    if len(set(keys)) != len(keys) or not seen.isdisjoint(keys):
                        raise ValueError("a variant has more than one call of a sample")
                    seen.update(keys)
                    if loaded is None:
                        continue
                    names, z, member = loaded
                    for at in range(a, c, 512):  # doubles of some rows at a time
                        to = min(at + 512, c)
                        g = numbers(rows[value][at:to])
                        bad = ~np.isfinite(g)
                        g[bad] = 0.0
                        held.add(keys[at - a : to - a], names, g @ z, np.square(g) @ member, bad @ member if bad.any() else 0.0)
            yield from held.batches(arrow_schema)

        # The order within a bucket is stated again, as Spark does not read it from the files.
        return calls.sortWithinPartitions(*ORDER).groupBy(BUCKET).applyInArrow(stream, schema)

    return reduce(DataFrame.unionByName, [one_pass(p) for p in range(n_passes)])


# Results


def trait_totals(adjusted: DataFrame, solved: DataFrame, batches: DataFrame, shape: Shape, described: DataFrame | None = None) -> DataFrame:
    """One row per trait of a batch that ran: residual sum of squares, complete cases and rank.

    ``described`` has one row per trait_id, whose other columns are added.
    """
    traits = _names("z", shape)[shape.k :]
    squares = adjusted.groupBy("batch_key").agg(*[F.sum(F.col(z) * F.col(z)).alias(z) for z in traits])
    yy = squares.select("batch_key", F.posexplode(F.array(*traits)).alias("trait_index", "yy"))
    dims = batches.select("batch_key", "trait_index", "trait_id", "batch_index", "batch_size", "trait_group_id")
    if described is not None:
        dims = dims.join(described, "trait_id")
    return yy.join(solved.select("batch_key", F.col("n").alias("sample_size"), "rank"), "batch_key").join(
        dims, ["batch_key", "trait_index"]
    )


_PER_BATCH = ["batch_key", "sample_size", "rank", "batch_index", "batch_size", "trait_group_id"]


def finish(
    sums: DataFrame,
    totals: DataFrame,
    shape: Shape,
    variants: DataFrame | None = None,
    only: DataFrame | None = None,
    together: Sequence[str] = (),
) -> DataFrame:
    """beta, standard error, t and p per (variant, trait).

    A variant without variation left after the covariates, one with a missing dosage, or a batch
    without residual degrees of freedom has NULL results. Columns of ``variants`` are added, which has one row per
    variant; ``only`` keeps the (contig, batch_index, trait_group_id) it lists; columns ``together`` say which rows
    should lie together, for a write by them. The traits of a batch are one value until the last step.
    """
    more = [c for c in totals.columns if c not in (*_PER_BATCH, "trait_index", "trait_id", "yy")]
    of_trait = F.array_sort(F.collect_list(F.struct("trait_index", "trait_id", "yy", *more)))
    per_batch = totals.groupBy(*_PER_BATCH).agg(of_trait.alias("_traits"))
    k = shape.k
    explained = reduce(lambda a, b: a + b, [F.col(f"s{j}") * F.col(f"s{j}") for j in range(k)])
    per_trait = F.array(*[F.col(f"s{j}") for j in range(k, shape.n_sums)])
    wide = sums.select(*CALL_KEYS, "batch_key", "gg", "n_bad", (F.col("gg") - explained).alias("grr"), per_trait.alias("_gy"))
    wide = wide.join(per_batch, "batch_key")
    if only is not None:
        wide = wide.join(only, ["contig", "batch_index", "trait_group_id"], "left_semi")
    of_variant = [c for c in variants.columns if c not in CALL_KEYS] if variants is not None else []
    if variants is not None:
        wide = wide.join(variants, CALL_KEYS)
    if together:
        wide = wide.hint("rebalance", *[F.col(c) for c in together])
    each = F.transform("_traits", lambda t: t.withField("gy", F.get(F.col("_gy"), t["trait_index"])))
    long = wide.select(*CALL_KEYS, *of_variant, *_PER_BATCH[1:], "gg", "n_bad", "grr", F.inline(each))
    dof = F.col("sample_size") - F.col("rank") - 1
    usable = (F.col("n_bad") == 0) & (F.col("grr") > MONOMORPHIC_TOLERANCE * F.col("gg")) & (dof > 0)
    beta = F.when(usable, F.col("gy") / F.col("grr"))
    fitted = long.withColumns({"beta": beta, "dof": F.when(usable, dof.cast("double"))})
    rss = F.greatest(F.col("yy") - F.col("beta") * F.col("gy"), F.lit(0.0))
    fitted = fitted.withColumn("se", F.sqrt(rss / F.col("dof") / F.col("grr")))
    fitted = fitted.withColumn("t", F.try_divide("beta", "se"))
    return fitted.select(
        *CALL_KEYS,
        "trait_id",
        "trait_group_id",
        "trait_index",
        "batch_index",
        "batch_size",
        "sample_size",
        "beta",
        "se",
        "t",
        "dof",
        t_p_value("t", "dof").alias("p_value"),
        *of_variant,
        *more,
    )


def associate(
    calls: DataFrame,
    samples: DataFrame,
    trait_values: DataFrame,
    batches: DataFrame,
    shape: Shape,
    min_samples: int = MIN_SAMPLES,
    n_variants: int | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = stage,
    variants: DataFrame | None = None,
    described: DataFrame | None = None,
    only: DataFrame | None = None,
    together: Sequence[str] = (),
) -> DataFrame:
    """All variants against all trait batches in one job.

    ``calls`` are blocks in the stored layout, or rows (contig, variant_index, sample_index, dosage), for sparse calls, or packed
    blocks of them, for dense ones; (variant, sample) must be unique. ``n_variants`` sets
    the tiling and is counted if not given. ``keep`` writes the sample side, each step of which is
    used more than once, to a table: a lost executor does not repeat it, and Spark knows the size
    of the trait table that the results are joined with. The table ``solved`` also has the batches with
    too few complete cases. ``described`` adds columns by trait, see ``trait_totals``; for ``variants``, ``only`` and
    ``together`` see ``finish``.
    """
    rows = keep(design(trait_values, batches, samples, shape), "design")
    solved = keep(solve(moments(rows), shape.k), "solved").filter(F.col("n") >= min_samples)
    adjusted = keep(residuals(rows, solved, shape), "residuals")
    if n_variants is None and BUCKET not in calls.columns:
        n_variants = calls.select(*CALL_KEYS).distinct().count()
    totals = keep(trait_totals(adjusted, solved, batches, shape, described), "totals")
    sums = contract_stored(calls, adjusted, shape) if BUCKET in calls.columns else contract(calls, adjusted, shape, n_variants)
    return finish(sums, totals, shape, variants, only, together)

