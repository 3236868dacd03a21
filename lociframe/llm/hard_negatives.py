"""Hard negatives of anchors: rows of another label that score just below the anchor's best rows of its own.

Each entry c of a vector becomes the integer floor(256 c), and the score of two rows is their integer inner product. A vector is
stored with the mean and the deviation of each of its segments. Over a segment of m entries, the product of two vectors is
m times (the product of the means plus at most the product of the deviations, either way), so sums of these bound the score. A pair
is looked at with few long segments first, then with more and shorter ones, then scored exactly, and is
left out as soon as its bounds lie outside what its anchor still has use for.

Anchors meet rows in tiles of bounded size: blocks of anchors by blocks of rows, the rows of the own label for positives, all rows
for negatives. A tile keeps the best few per anchor; Spark ranks those of all tiles.

Rows with a null id, label or vector, with a null or non-finite entry, or with a vector of another length than most (the
longer of equally frequent lengths) take no part. Of rows that repeat an id, the one with the smallest label, then
the smallest vector, takes part. Ties go to the smaller id. An anchor without positives, or whose positives have no
rows in range, has no result. Other columns do not matter, whatever their names. Entries of 2^23 or more
are an error, as are scores beyond 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociframe.llm.whitening import integers
from lociframe.session import stage

SEGMENTS = (4, 16)  # segments of a vector, each level dividing those of the one before
ANCHORS, ROWS = 8192, 32_768  # of a tile
CHUNK_ANCHORS, CHUNK_ROWS = 1024, 2048  # of a tile, looked at together
FEW = 0.2  # share of pairs below which they are looked at one by one
NONE = np.iinfo(np.int64).min


def _segments(x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and deviation of ``n`` segments of each row."""
    parts = np.array_split(x.astype(float), min(n, x.shape[1]), axis=1)
    return np.column_stack([p.mean(axis=1) for p in parts]), np.column_stack([p.std(axis=1) for p in parts])


def _lengths(d: int, n: int) -> np.ndarray:
    return np.array([len(p) for p in np.array_split(np.arange(d), min(n, d))], float)


class Side:
    """Vectors of a tile with the means and deviations of their segments, level by level."""

    def __init__(self, x: np.ndarray, summary: np.ndarray, weighted: bool):
        self.x, self.levels, at, d = x, [], 0, x.shape[1]
        for n in SEGMENTS:
            lengths = _lengths(d, n)
            k = len(lengths)
            mean, deviation = summary[:, at : at + k], summary[:, at + k : at + 2 * k]
            self.levels.append((mean * lengths, deviation * lengths) if weighted else (mean, deviation))
            at += 2 * k

    @classmethod
    def of(cls, table: pa.Table, weighted: bool) -> Side:
        x = np.frombuffer(b"".join(table["x"].to_pylist()), "<i4").reshape(table.num_rows, -1).astype(np.int64)
        return cls(x, np.frombuffer(b"".join(table["summary"].to_pylist()), "<f8").reshape(table.num_rows, -1), weighted)

    def take(self, part: slice) -> Side:
        out = object.__new__(Side)
        out.x, out.levels = self.x[part], [(m[part], s[part]) for m, s in self.levels]
        return out


def _exact(a: np.ndarray, b: np.ndarray, paired: bool) -> np.ndarray:
    """Integer inner products, of all rows or of rows in pairs."""
    bound = a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    if bound >= 1 << 63:
        raise OverflowError("scores do not fit 64 bits")
    if bound < 1 << 53:  # then doubles are exact, and faster
        a, b = a.astype(float), b.astype(float)
    return (np.einsum("ij,ij->i", a, b) if paired else a @ b.T).astype(np.int64)


def in_range(anchors: Side, rows: Side, low: np.ndarray, high: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (anchor, row, score) of ``wanted`` ones whose score lies between the anchor's ``low`` and ``high``."""
    pairs: tuple[np.ndarray, np.ndarray] | None = None
    low, high = low.astype(float), high.astype(float)
    for (ma, sa), (mr, sr) in zip(anchors.levels, rows.levels):
        if pairs is None:
            centre, radius = ma @ mr.T, sa @ sr.T
            slack = 1e-6 + 1e-9 * (np.abs(ma) @ np.abs(mr).T + radius)  # more than rounding
            wanted = wanted & (centre + radius + slack >= low[:, None]) & (centre - radius - slack <= high[:, None])
            if np.count_nonzero(wanted) < FEW * wanted.size:
                pairs = np.nonzero(wanted)
        else:
            a, r = pairs
            centre, radius = np.einsum("ij,ij->i", ma[a], mr[r]), np.einsum("ij,ij->i", sa[a], sr[r])
            slack = 1e-6 + 1e-9 * (np.einsum("ij,ij->i", np.abs(ma[a]), np.abs(mr[r])) + radius)
            stay = (centre + radius + slack >= low[a]) & (centre - radius - slack <= high[a])
            pairs = a[stay], r[stay]
    if pairs is None:
        scores = _exact(anchors.x, rows.x, paired=False)
        a, r = np.nonzero(wanted & (scores >= low[:, None]) & (scores <= high[:, None]))
        return a, r, scores[a, r]
    a, r = pairs
    scores = _exact(anchors.x[a], rows.x[r], paired=True)
    stay = (scores >= low[a]) & (scores <= high[a])
    return a[stay], r[stay], scores[stay]


class Best:
    """The ``k`` best (score, id) of each of ``n`` anchors so far, ties to the smaller id."""

    def __init__(self, n: int, k: int):
        self.scores, self.ids = np.full((n, k), NONE), np.zeros((n, k), np.int64)

    def add(self, anchor: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        n, k = self.scores.shape
        if not len(anchor):
            return
        touched = np.unique(anchor)
        held = np.repeat(touched, k), self.scores[touched].ravel(), self.ids[touched].ravel()
        real = held[1] != NONE
        anchor, score, ids = (np.concatenate([new, old[real]]) for new, old in zip((anchor, score, ids), held))
        order = np.lexsort((ids, -score, anchor))
        anchor, score, ids = anchor[order], score[order], ids[order]
        first = np.searchsorted(anchor, anchor)
        place = np.arange(len(anchor)) - first
        top = place < k
        self.scores[touched], self.ids[touched] = NONE, 0
        self.scores[anchor[top], place[top]], self.ids[anchor[top], place[top]] = score[top], ids[top]

    @property
    def least(self) -> np.ndarray:
        """The score that a further row must reach."""
        return self.scores[:, -1]


def _chunks(n: int, size: int) -> Iterator[slice]:
    return (slice(at, min(at + size, n)) for at in range(0, n, size))


def _best_positives(anchors: pa.Table, rows: pa.Table, k: int) -> pa.Table:
    """Up to ``k`` best rows of each anchor in a tile of one label."""
    a, r = Side.of(anchors, True), Side.of(rows, False)
    anchor_ids, row_ids = anchors["id"].to_numpy(), rows["id"].to_numpy()
    best = Best(len(anchor_ids), k)
    for ca in _chunks(len(anchor_ids), CHUNK_ANCHORS):
        side, top = a.take(ca), np.full(ca.stop - ca.start, np.iinfo(np.int64).max)
        for cr in _chunks(len(row_ids), CHUNK_ROWS):
            other = anchor_ids[ca, None] != row_ids[None, cr]
            i, j, score = in_range(side, r.take(cr), best.least[ca], top, other)
            best.add(i + ca.start, score, row_ids[cr][j])
    i, place = np.nonzero(best.scores != NONE)
    return pa.table({"anchor_id": anchor_ids[i], "positive_id": best.ids[i, place], "positive_score": best.scores[i, place]})


def _best_negatives(anchors: pa.Table, rows: pa.Table, k: int, percent: tuple[int, int], n_positives: int) -> pa.Table:
    """Up to ``k`` best rows of another label in each positive's range, in a tile."""
    a, r = Side.of(anchors, True), Side.of(rows, False)
    anchor_ids, row_ids = anchors["id"].to_numpy(), rows["id"].to_numpy()
    labels = pa.chunked_array([*anchors["label"].chunks, *rows["label"].chunks]).combine_chunks().dictionary_encode().indices.to_numpy()
    own, other = labels[: len(anchor_ids)], labels[len(anchor_ids) :]
    positives = np.full((len(anchor_ids), n_positives), NONE)
    for i, scores in enumerate(anchors["positive_scores"].to_pylist()):
        positives[i, : len(scores)] = scores
    low, high = -(-percent[0] * positives // 100), percent[1] * positives // 100
    low[positives == NONE], high[positives == NONE] = 1, 0
    best = [Best(len(anchor_ids), k) for _ in range(n_positives)]
    nothing, everything = np.iinfo(np.int64).max, NONE
    for ca in _chunks(len(anchor_ids), CHUNK_ANCHORS):
        side = a.take(ca)
        for cr in _chunks(len(row_ids), CHUNK_ROWS):
            # What each positive still has use for: its range, from its k-th best on.
            need = np.stack([np.maximum(low[ca, p], best[p].least[ca]) for p in range(n_positives)], axis=1)
            use = need <= high[ca]
            least = np.where(use, need, nothing).min(axis=1)
            most = np.where(use, high[ca], everything).max(axis=1)
            i, j, score = in_range(side, r.take(cr), least, most, own[ca, None] != other[None, cr])
            for p in range(n_positives):
                fits = (score >= need[i, p]) & (score <= high[ca][i, p])
                best[p].add(i[fits] + ca.start, score[fits], row_ids[cr][j[fits]])
    parts = []
    for p in range(n_positives):
        i, place = np.nonzero(best[p].scores != NONE)
        parts.append(pa.table({"anchor_id": anchor_ids[i], "place": np.full(len(i), p, np.int32), "negative_id": best[p].ids[i, place], "negative_score": best[p].scores[i, place]}))
    return pa.concat_tables(parts)


def _summarised(rows: DataFrame) -> DataFrame:
    """Vectors as binaries of 4-byte integers, with the means and deviations of their segments."""

    @F.arrow_udf("struct<x: binary, summary: binary>")
    def summarise(x: pa.Array) -> pa.Array:
        matrix = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)
        if len(matrix) and np.abs(matrix).max() >= 1 << 31:
            raise OverflowError("a vector entry is too large")
        summary = np.concatenate([part for n in SEGMENTS for part in _segments(matrix, n)], axis=1) if len(matrix) else np.zeros((0, 0))
        packed = [pa.array([row.tobytes() for row in m], pa.binary()) for m in (matrix.astype("<i4"), summary.astype("<f8"))]
        return pa.StructArray.from_arrays(packed, ["x", "summary"])

    return rows.withColumn("_s", summarise("x")).select("id", "label", "anchor", "_s.x", "_s.summary")


def _block(n: Column | int) -> Column:
    return F.pmod(F.xxhash64("id"), F.lit(n) if isinstance(n, int) else n).cast("int")


def _every(n: Column | int) -> Column:
    return F.explode(F.sequence(F.lit(0), (F.lit(n) if isinstance(n, int) else n).cast("int") - 1))


def _tiles(anchors: DataFrame, rows: DataFrame, keys: list[str], n_tasks: int, of, schema: str) -> DataFrame:
    """``of(anchors, rows)`` for each tile, all of whose rows have the same keys."""
    kinds = {"long": pa.int64(), "int": pa.int32()}
    result = pa.schema([(name, kinds[kind]) for name, kind in (c.split() for c in schema.split(", "))])

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        return of(left, right).cast(result) if left.num_rows and right.num_rows else result.empty_table()

    # Both sides come from one table; columns made anew keep Spark from taking them for the same.
    left, right = (side.select(*[F.col(c).alias(c) for c in side.columns]).repartition(n_tasks, *keys) for side in (anchors, rows))
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(tile, schema)


def _first(rows: DataFrame, keys: list[str], score: str, other: str, k: int) -> DataFrame:
    """The ``k`` best of each key with their rank; Spark limits each task's rows before it shuffles them."""
    order = Window.partitionBy(*keys).orderBy(F.desc(score), F.asc(other))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    vectors: DataFrame,
    anchors: Column,
    id_column: str = "vec_id",
    label_column: str = "label",
    vector_column: str = "embedding",
    n_positives: int = 5,
    n_negatives: int = 3,
    percent: tuple[int, int] = (50, 95),
) -> DataFrame:
    """Hard negatives of the rows that meet ``anchors``: anchor_id, positive_id, rank, negative_id and both scores.

    Positives are an anchor's ``n_positives`` best rows of its label. For each, the ``n_negatives`` best rows of other labels
    are taken whose score is at least the first and at most the second of ``percent`` of the positive's.
    """
    label, chosen = F.col(f"`{label_column}`").alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor")
    sound = integers(vectors, id_column, vector_column, label, chosen).where("id IS NOT NULL AND label IS NOT NULL")
    sound = sound.withColumn("id", F.col("id").cast("long"))
    single = sound.groupBy("id").agg(F.min(F.struct("label", "x", "anchor")).alias("_r")).select("id", "_r.*")
    rows = stage(_summarised(single), "hard-negatives")
    counts = rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("n_anchors")).where("n_anchors > 0")
    counts = stage(counts.select("label", F.ceil(F.col("n") / ROWS).alias("r_blocks"), F.ceil(F.col("n_anchors") / ANCHORS).alias("a_blocks")), "blocks")
    n_tiles = counts.agg(F.sum(F.col("r_blocks") * F.col("a_blocks"))).first()[0] or 0

    near = rows.join(counts, "label")
    queries = near.where("anchor").select("id", "label", "x", "summary", _block(F.col("a_blocks")).alias("a"), _every(F.col("r_blocks")).alias("r"))
    others = near.select("id", "label", "x", "summary", _block(F.col("r_blocks")).alias("r"), _every(F.col("a_blocks")).alias("a"))
    found = _tiles(
        queries, others, ["label", "a", "r"], max(2, 2 * n_tiles),
        lambda left, right: _best_positives(left, right, n_positives), "anchor_id long, positive_id long, positive_score long",
    )
    positives = stage(_first(found, ["anchor_id"], "positive_score", "positive_id", n_positives), "positives")

    # Up to n_positives numbers an anchor, best first.
    wanted = positives.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "positive_score"))).alias("p"))
    asking = rows.where("anchor").join(wanted.select(F.col("anchor_id").alias("id"), F.col("p.positive_score").alias("positive_scores")), "id")
    asking = stage(asking, "asking")
    a_blocks, r_blocks = max(1, -(-asking.count() // ANCHORS)), max(1, -(-rows.count() // ROWS))
    queries = asking.select("id", "label", "x", "summary", "positive_scores", _block(a_blocks).alias("a"), _every(r_blocks).alias("r"))
    others = rows.select("id", "label", "x", "summary", _block(r_blocks).alias("r"), _every(a_blocks).alias("a"))
    found = _tiles(
        queries, others, ["a", "r"], max(2, 2 * a_blocks * r_blocks),
        lambda left, right: _best_negatives(left, right, n_negatives, percent, n_positives),
        "anchor_id long, place int, negative_id long, negative_score long",
    )
    best = _first(found, ["anchor_id", "place"], "negative_score", "negative_id", n_negatives)
    named = positives.select("anchor_id", "positive_id", "positive_score", (F.col("rank") - 1).alias("place"))
    return best.join(named, ["anchor_id", "place"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score"
    )
