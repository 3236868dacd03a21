"""Near-duplicate vectors by a forest of random-projection trees with spill overlap.

Groups of many near copies are found first, at any size, and compared exactly around their centres. Every
tree cuts what belongs to none by random directions, again and again, until a cell holds
few enough to compare all of them. Vectors near a cut go to both sides. What a cut separates in
one tree the others keep together; all links are verified by their cosine, and united.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import batches, binary
from lociframe.llm.components import components
from lociframe.session import stage

COSINE = 0.98
TREES = 10
LEAF = 512  # rows of a cell that are compared with each other
SPILL = 0.15  # share of a cell's rows that go to both sides
DEPTH = 6  # cuts per round
SAMPLE = 2048  # rows of a cell, at most about, that its cuts or its dense spots are learnt from
CROWD = 4096  # rows of a dense spot that are compared at a time
SHARE = 0.04  # of a sample that makes a dense spot; of a cell that is no larger than its sample, a quarter of a leaf does


def _prepared(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("id", pa.int64()), ("grp", pa.string()), ("print", pa.binary()), ("vec", pa.binary())])
    for batch in stream:
        rows = {"id": [], "grp": [], "print": [], "vec": []}
        for vec_id, vector, label in zip(*(batch.column(i).to_pylist() for i in range(3))):
            group = value = mark = None
            if vec_id is not None and vector and label is not None and None not in vector:
                v = np.array(vector, float) + 0.0
                if np.isfinite(v).all() and v.any():
                    v /= np.abs(v).max()
                    value, group = v.tobytes(), f"{len(v)}:{label}"
                    mark = xxhash.xxh3_128_digest(value)
            for column, x in zip(rows.values(), (vec_id, group, mark, value)):
                column.append(x)
        yield batches(rows, schema)


def _matrix(vectors) -> np.ndarray:
    return np.frombuffer(b"".join(vectors), float).reshape(len(vectors), -1)


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.sqrt((m * m).sum(1, keepdims=True))


def _directions(cell: str, dim: int, count: int) -> np.ndarray:
    return np.random.default_rng(xxhash.xxh3_64_intdigest(cell)).standard_normal((count, dim))


def _places(keys: list) -> dict:
    """Places of each key."""
    places: dict = {}
    for i, key in enumerate(keys):
        places.setdefault(key, []).append(i)
    return places


def _sampled(cells: DataFrame, sizes: DataFrame, keys: list[str]) -> DataFrame:
    """About SAMPLE rows of each cell, chosen by a hash of the id."""
    draw = F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1 << 30)) / float(1 << 30)
    return cells.join(sizes, keys).where(draw * F.col("rows") < SAMPLE)


# ---- dense spots: neighbourhoods so full that trees would cut through them


def _spots(cosine: float, least: int):
    """Centres of a cell's dense spots, from its sample: means of the neighbourhoods that hold the most of it."""

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        m = _unit(_matrix(frame["vec"].tolist()))
        whole = frame["rows"].iloc[0] <= SAMPLE
        wanted = least if whole else max(8, SHARE * len(m))
        near = m @ m.T >= cosine
        held, free, centres = near.sum(1), np.ones(len(m), bool), []
        while True:
            best = int(np.where(free, held, -1).argmax())
            if not free[best] or held[best] < wanted:
                break
            mean = _unit(m[near[best] & free].mean(0, keepdims=True))[0]
            centres.append(mean.tobytes())
            gone = free & (m @ mean >= cosine)
            gone[best] = True
            free &= ~gone
            held = held - near[:, gone].sum(1)
        return pd.DataFrame({"grp": [frame["grp"].iloc[0]], "cell": [frame["cell"].iloc[0]], "centres": [b"".join(centres)]})

    return fit


def _sides(bits: int):
    schema = pa.schema([("id", pa.int64()), ("grp", pa.string()), ("cell", pa.string()), ("vec", pa.binary()), ("copies", pa.int64())])

    def run(stream):
        for batch in stream:
            grp, cell, vec = batch.column(1).to_pylist(), batch.column(2).to_pylist(), binary(batch, "vec")
            for (g, c), places in _places(list(zip(grp, cell))).items():
                m = _matrix([vec[i] for i in places])
                code = ((m @ _directions(f"spots {g} {c}", m.shape[1], bits).T > 0) << np.arange(bits)).sum(1)
                for i, side in zip(places, code):
                    cell[i] = f"{c}.{side}"
            yield batches({"id": batch.column(0).to_pylist(), "grp": grp, "cell": cell, "vec": vec, "copies": batch.column(4).to_pylist()}, schema)

    return run


def _around(rows: DataFrame, sizes: DataFrame, centres: DataFrame, keys: list[str], function, schema: str) -> DataFrame:
    """``function(rows, centres)`` on parts of about CROWD rows of each cell that has centres."""
    parts = sizes.select(*keys, F.ceil(F.col("rows") / CROWD).cast("int").alias("parts"))
    found = centres.join(parts, keys).select(*keys, "centres", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    dealt = rows.join(parts, keys).withColumn("part", F.pmod(F.xxhash64("id", F.lit(11)), F.col("parts")).cast("int")).drop("parts")
    return dealt.groupBy(*keys, "part").cogroup(found.groupBy(*keys, "part")).applyInPandas(function, schema)


def _outside(cosine: float):
    """Rows that are not near any of their cell's centres."""

    def run(rows: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        rows = rows[["id", "grp", "cell", "vec", "copies"]]
        if not len(rows) or not len(centres) or not centres["centres"].iloc[0]:
            return rows
        m = _unit(_matrix(rows["vec"].tolist()))
        at = m @ np.frombuffer(centres["centres"].iloc[0], float).reshape(-1, m.shape[1]).T
        return rows[at.max(1) < cosine]

    return run


def dense_centres(vectors: DataFrame, cosine: float, leaf: int) -> DataFrame | None:
    """(grp, centres) of the dense spots of vectors (id, grp, vec, copies); staged.

    A cell is searched by a bounded sample. What is near no centre of a cell larger than that is cut by the
    signs of random projections and searched again, until the samples are whole cells.
    """
    shape = "id long, grp string, cell string, vec binary, copies long"
    least = max(8, leaf // 4)
    rest = vectors.select("id", "grp", F.lit("").alias("cell"), "vec", "copies")
    found = None
    while True:
        sizes = stage(rest.groupBy("grp", "cell").agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") >= least), "spot-sizes")
        if not sizes.limit(1).count():
            break
        centres = _sampled(rest, sizes, ["grp", "cell"]).select("id", "grp", "cell", "vec", "rows").groupBy("grp", "cell").applyInPandas(_spots(cosine, least), "grp string, cell string, centres binary")
        centres = stage(centres, "spot-centres")
        found = centres if found is None else found.union(centres)
        large = sizes.where(F.col("rows") > SAMPLE)
        if not large.limit(1).count():
            break
        left = _around(rest, large, centres, ["grp", "cell"], _outside(cosine), shape)
        rest = stage(left.mapInArrow(_sides(4), shape), "spot-rest")
    if found is None:
        return None
    named = found.where(F.length("centres") > 0).groupBy("grp").agg(F.array_sort(F.collect_list("centres")).alias("c"))
    return stage(named.select("grp", F.expr("aggregate(c, cast('' as binary), (x, y) -> concat(x, y))").alias("centres")), "grp-centres")


def _homes(cosine: float):
    """Each row once per centre it may have links around; ``home`` marks the nearest centre of a row near one."""
    wide, half = math.cos(2 * math.acos(cosine)) - 1e-9, math.sqrt((1 + cosine) / 2) + 1e-9
    if cosine < math.sqrt(0.5):
        wide = -2.0

    def run(rows: pd.DataFrame, centres: pd.DataFrame) -> pd.DataFrame:
        out = pd.DataFrame({"id": [], "spot": [], "home": [], "free": [], "core": [], "vec": [], "copies": []})
        if not len(rows) or not len(centres):
            return out
        m = _unit(_matrix(rows["vec"].tolist()))
        at = m @ np.frombuffer(centres["centres"].iloc[0], float).reshape(-1, m.shape[1]).T
        best = at.argmax(1)
        top = at[np.arange(len(m)), best]
        r, c = np.nonzero(at >= wide)
        home = (best[r] == c) & (top[r] >= cosine)
        picked = rows.iloc[r]
        spot = [f"{picked['grp'].iloc[0]}/{x}" for x in c] if len(r) else []
        return pd.DataFrame({"id": picked["id"].to_numpy(), "spot": spot, "home": home, "free": top[r] < cosine, "core": home & (top[r] >= half), "vec": picked["vec"].to_numpy(), "copies": picked["copies"].to_numpy()})

    return run


def _forest_of(links: np.ndarray):
    """Edges (row, first row) that span the components of a symmetric matrix; each row is read once."""
    alone = links.any(1)
    while alone.any():
        first = int(alone.argmax())
        alone[first] = False
        front = np.array([first])
        while len(front):
            front = np.flatnonzero(links[front].any(0) & alone)
            alone[front] = False
            for x in front:
                yield x, first


def _block_links(cosine: float):
    """Degrees and spanning edges of one pair of blocks of a spot; pairs within its core are left out."""

    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        p, q = int(frame["p"].iloc[0]), int(frame["q"].iloc[0])
        frame = frame.sort_values(["block", "id"])
        raw = _matrix(frame["vec"].tolist())
        unit, n = _unit(raw), len(raw)
        ids, w = frame["id"].to_numpy(), frame["copies"].to_numpy().astype(float)
        home, free = frame["home"].to_numpy().astype(bool), frame["free"].to_numpy().astype(bool)
        block = frame["block"].to_numpy()
        cut = n if p == q else int((block == p).sum())
        rows, cols = slice(0, cut), slice(0, n) if p == q else slice(cut, n)
        dots = unit[rows] @ unit[cols].T
        links = dots >= cosine
        a, b = np.nonzero(np.abs(dots - cosine) < 1e-9)
        if len(a):
            x, y = raw[rows][a], raw[cols][b]
            links[a, b] = np.einsum("ij,ij->i", x, y) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y))) >= cosine
        if p == q:
            links[np.arange(n), np.arange(n)] = False
        links &= home[rows][:, None] | home[cols][None]  # the rest is another spot's, or the forest's
        total = np.zeros(n)
        total[rows] = np.where(home[rows] | free[rows], links @ w[cols], 0)
        if p != q:
            total[cols] = np.where(home[cols] | free[cols], w[rows] @ links, 0)
        whole = links
        if p != q:
            whole = np.zeros((n, n), bool)
            whole[rows, cols], whole[cols, rows] = links, links.T
        edges = list(_forest_of(whole))
        some = np.flatnonzero(total)
        u = np.concatenate([ids[some], ids[[x for x, _ in edges]]]) if edges else ids[some]
        v = np.concatenate([np.full(len(some), -1), ids[[y for _, y in edges]]]) if edges else np.full(len(some), -1)
        return pd.DataFrame({"u": u, "v": v, "n": np.concatenate([total[some], np.zeros(len(edges))]).astype(np.int64), "edge": np.arange(len(u)) >= len(some)})

    return compare


def spot_links(vectors: DataFrame, centres: DataFrame, cosine: float) -> tuple[DataFrame, DataFrame]:
    """The members (id, spot, home, free, core, vec, copies) of all spots, and their (u, v, n, edge); both staged.

    A vector as near to a centre as a link has its home there. By the triangle inequality all its links
    are within twice that angle of the centre, and two vectors within half of it (the core) are linked for sure. The
    others are compared block by block, a task for each pair of blocks. A link between two homes is counted for each
    end at its own home; one with a vector of no home (free), at the other's home for both.
    """
    sizes = stage(vectors.groupBy("grp").agg(F.count(F.lit(1)).alias("rows")).join(centres.select("grp"), "grp"), "grp-sizes")
    shape = "id long, spot string, home boolean, free boolean, core boolean, vec binary, copies long"
    members = stage(_around(vectors, sizes, centres, ["grp"], _homes(cosine), shape), "spot-members")
    counts = members.groupBy("spot").agg(F.count_if("core").alias("cores"), F.count_if(~F.col("core")).alias("others"))
    counts = stage(counts.select("spot", F.ceil(F.col("cores") / CROWD).cast("int").alias("c"), F.ceil(F.col("others") / CROWD).cast("int").alias("o")), "spot-blocks").where("o > 0")
    hashed = F.xxhash64("id", F.lit(13))
    # blocks 0 .. o - 1 hold the others, the next c the core
    block = F.when(F.col("core"), F.col("o") + F.pmod(hashed, F.greatest("c", F.lit(1)))).otherwise(F.pmod(hashed, F.col("o"))).cast("int")
    dealt = members.join(counts, "spot").withColumn("block", block)
    other = F.when(F.col("core"), F.sequence(F.lit(0), F.col("o") - 1)).otherwise(F.sequence(F.lit(0), F.col("o") + F.col("c") - 1))
    paired = dealt.withColumn("with", F.explode(other)).select("id", "spot", "home", "free", "vec", "copies", "block", F.least("block", "with").alias("p"), F.greatest("block", "with").alias("q"))
    compared = paired.groupBy("spot", "p", "q").applyInPandas(_block_links(cosine), "u long, v long, n long, edge boolean")
    return members, stage(compared, "spot-links")


# ---- the forest


def _cuts(leaf: int, spill: float):
    """Both thresholds of every cut of a cell, from its sample; a node's rows beyond one of them go to that side only."""

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        m, cell = _matrix(frame["vec"].tolist()), frame["cell"].iloc[0]
        depth = min(DEPTH, max(1, math.ceil(math.log(frame["rows"].iloc[0] / leaf) / math.log(2 / (1 + spill)))))
        directions = _directions(cell, m.shape[1], 2**depth - 1)
        low, high, nodes = np.zeros(2**depth - 1), np.zeros(2**depth - 1), {0: np.arange(len(m))}
        for node in range(2**depth - 1):
            rows = nodes.pop(node)
            at = m[rows] @ directions[node]
            if len(rows):
                low[node], high[node] = np.quantile(at, [0.5 - spill / 2, 0.5 + spill / 2])
            nodes[2 * node + 1], nodes[2 * node + 2] = rows[at <= high[node]], rows[at >= low[node]]
        return pd.DataFrame({"cell": [cell], "cuts": [np.stack([low, high]).tobytes()]})

    return fit


def _routed(stream):
    schema = pa.schema([("id", pa.int64()), ("cell", pa.string()), ("vec", pa.binary())])
    for batch in stream:
        ids, cell, vec, cuts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), binary(batch, "vec"), binary(batch, "cuts")
        out = {"id": [], "cell": [], "vec": []}
        for name, places in _places(cell).items():
            m = _matrix([vec[i] for i in places])
            low, high = np.frombuffer(cuts[places[0]], float).reshape(2, -1)
            directions, nodes = _directions(name, m.shape[1], len(low)), {0: np.arange(len(m))}
            for node in range(len(low)):
                rows = nodes.pop(node)
                at = m[rows] @ directions[node]
                nodes[2 * node + 1], nodes[2 * node + 2] = rows[at <= high[node]], rows[at >= low[node]]
            for node, rows in nodes.items():
                out["id"] += [ids[places[i]] for i in rows]
                out["vec"] += [vec[places[i]] for i in rows]
                out["cell"] += [f"{name}.{node}"] * len(rows)
        yield batches(out, schema)


def _linked(m: np.ndarray, cosine: float, block: int = 2048):
    """Pairs of places whose cosine is large enough, block by block."""
    unit = _unit(m)
    for i in range(0, len(m), block):
        for j in range(i, len(m), block):
            a, b = np.nonzero(unit[i : i + block] @ unit[j : j + block].T >= cosine - 1e-9)
            a, b = a + i, b + j
            a, b = a[a < b], b[a < b]
            dots = np.einsum("ij,ij->i", m[a], m[b]) / (np.sqrt(np.einsum("ij,ij->i", m[a], m[a])) * np.sqrt(np.einsum("ij,ij->i", m[b], m[b])))
            yield a[dots >= cosine], b[dots >= cosine]


def _compared(cosine: float):
    def compare(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("id")
        ids = frame["id"].to_numpy()
        parts = [(ids[a], ids[b]) for a, b in _linked(_matrix(frame["vec"].tolist()), cosine)]
        return pd.DataFrame({k: np.concatenate([p[i] for p in parts]) for i, k in enumerate(("a", "b"))}).drop_duplicates()

    return compare


def forest_links(vectors: DataFrame, cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL) -> DataFrame:
    """(a, b) of linked vectors (id, grp, vec); staged.

    Cells above ``leaf`` rows are cut up to ``DEPTH`` times a round; the cuts come from a bounded sample of each
    cell, all rows are routed by them. A cell whose rows the cuts do not spread is compared as it is, in blocks.
    """
    tree = F.explode(F.sequence(F.lit(1), F.lit(trees)))
    cells = vectors.select("id", "grp", "vec", tree.alias("tree")).select("id", F.concat_ws("|", F.col("tree").cast("string"), "grp").alias("cell"), "vec")
    done, stuck = None, None
    while True:
        sizes = stage(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("rows")), "forest-sizes")
        large = sizes.where(F.col("rows") > leaf)
        if stuck is not None:
            large = large.join(stuck, "cell", "left_anti")
        large = stage(large, "forest-large")
        small = cells.join(large, "cell", "left_anti")
        done = small if done is None else done.union(small)
        if not large.limit(1).count():
            break
        cuts = stage(_sampled(cells, large, ["cell"]).select("id", "cell", "vec", "rows").groupBy("cell").applyInPandas(_cuts(leaf, spill), "cell string, cuts binary"), "forest-cuts")
        routed = cells.join(cuts, "cell").select("id", "cell", "vec", "cuts").mapInArrow(_routed, "id long, cell string, vec binary")
        before = large.select(F.col("cell").alias("parent"), F.col("rows").alias("whole"))
        cells = stage(routed, "forest-cells")
        now = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("rows")).withColumn("parent", F.regexp_replace("cell", r"\.[^.]*$", ""))
        stuck = stage(now.join(before, "parent").where("rows > 0.9 * whole").select("cell"), "forest-stuck")
    pairs = done.groupBy("cell").applyInPandas(_compared(cosine), "a long, b long")
    return stage(pairs.distinct(), "forest-links")


def near_duplicates(rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label", cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF, spill: float = SPILL) -> DataFrame:
    """(id, n_links, component_id, kept) per row: rows linked directly, and the smallest id reachable.

    Only vectors of equal label and length are compared. Null, empty or zero vectors, null or non-finite
    components, null labels and null ids link with nothing. Vectors equal up to a factor that leaves their
    scaled components equal are compared once and counted as often as they occur; a
    repeated id counts as a row of its own. An empty table gives no rows.
    """
    picked = rows.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("vec"), F.col(label_column).cast("string").alias("label"))
    ready = stage(picked.mapInArrow(_prepared, "id long, grp string, print binary, vec binary"), "vectors")
    valid = ready.where("grp IS NOT NULL")
    firsts = stage(valid.groupBy("grp", "print").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), F.any_value("vec").alias("vec")), "vector-firsts")
    vectors = firsts.select(F.col("first").alias("id"), "grp", "vec", "copies")
    copies = firsts.select(F.col("first").alias("_id"), "copies")
    centres = dense_centres(vectors, cosine, leaf)
    if centres is None or not centres.limit(1).count():
        pairs = forest_links(vectors, cosine, trees, leaf, spill)
        edges, counted, inside = pairs, None, None
    else:
        members, found = spot_links(vectors, centres, cosine)
        pairs = forest_links(vectors.join(members.where("home").select("id"), "id", "left_anti"), cosine, trees, leaf, spill)
        core = members.where("core").select("id", "spot", "copies")
        inside = stage(core.join(core.groupBy("spot").agg(F.sum("copies").alias("all"), F.min("id").alias("least")), "spot"), "spot-cores")
        counted = found.where("NOT edge").select("u", F.col("n").alias("copies"))
        edges = pairs.union(found.where("edge").select("u", "v")).union(inside.select("least", "id"))
    both = pairs.union(pairs.select("b", "a")).toDF("u", "v")
    linked = both.join(copies, F.col("v") == F.col("_id")).select("u", "copies")
    outside = (linked if counted is None else linked.union(counted)).groupBy("u").agg(F.sum("copies").alias("outside"))
    within = F.lit(None).cast("long").alias("inside")
    inside = firsts.limit(0).select(F.col("first").alias("node"), within) if inside is None else inside.select(F.col("id").alias("node"), (F.col("all") - F.col("copies")).alias("inside"))
    roots = components(edges)

    known = firsts.select("grp", "print", F.col("first").alias("node"), "copies")
    known = known.join(outside.withColumnRenamed("u", "node"), "node", "left").join(inside, "node", "left").join(roots, "node", "left")
    nothing = F.lit(0)
    links = F.col("copies") - 1 + F.coalesce("outside", nothing) + F.coalesce("inside", nothing)
    known = stage(known.select("grp", "print", links.alias("n_links"), F.coalesce("root", "node").alias("component")), "vector-known")
    out = ready.select("id", "grp", "print").join(known, ["grp", "print"], "left")
    component = F.coalesce("component", "id")
    return out.select("id", F.coalesce("n_links", nothing).cast("long").alias("n_links"), component.alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
