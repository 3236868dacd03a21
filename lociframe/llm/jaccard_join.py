"""Set similarity join on word n-grams with adaptive multi-match prefixes.

All documents order their n-grams alike (by hash). Two sets that overlap enough share at least L
n-grams within their L-prefixes, the first ``n - need + L`` of each. A document's L is chosen by the
estimated cost of its prefix: every frequent n-gram it meets lengthens the prefix by one and raises by
one the number of matches asked for, so that the frequent ones need not be looked up at all, and the
more rows its other n-grams are likely to meet, the more of those must match before a pair is verified.
The first look keeps the head of each set; documents that need longer prefixes are read again.
Documents made of frequent n-grams (groups of many near copies) are joined among themselves on
these. No pair is lost by any of this.

Only components are wanted, so pairs within one component need no look: each n-gram's rows are
compared with the most central of them, and then only rows of different components are paired. Pairs that
share frequent n-grams alone cannot share more than the fewer of their frequent ones, which rules out
most of those that are left.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lociframe.llm.common import WordHashes, batches, binary, document, give_back, rows_per_batch, shingles, with_ids, without_ids
from lociframe.llm.components import components
from lociframe.session import stage

SIZE, PERCENT = 5, 80
HOT = 16  # n-grams in more documents than this are skipped at the price of a longer prefix
KNOWN = 1 << 18  # most frequent n-grams whose counts all tasks get: 4 MB at most; others count as rare
CHUNK = 2_000_000  # n-grams counted at a time
MOST_MATCHES = 8
ALL = 1 << 30  # matches asked for by a document that is looked up on all its infrequent n-grams: as many as its partner


def need(n, percent: int = PERCENT):
    """Least overlap of a set of ``n`` with any set that is similar enough."""
    return -(-percent * n // 100)


def longest(n, percent: int = PERCENT):
    """Largest L that the first look keeps n-grams for; documents that need a larger one are read again."""
    return np.minimum(16 + n // 20, need(n, percent))


_SKETCH = pa.schema([("kind", pa.int8()), ("id", pa.int64()), ("n", pa.int64()), ("print", pa.binary()), ("tokens", pa.binary()), ("counts", pa.binary())])


def _sketch(size: int, percent: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, waiting, held = WordHashes(), [], 0

        def counted():
            token, count = np.unique(np.concatenate(waiting), return_counts=True)
            twice = count > 1
            return batches({"kind": [1], "id": [None], "n": [None], "print": [None], "tokens": [token[twice].tobytes()], "counts": [count[twice].astype(np.int64).tobytes()]}, _SKETCH)

        for batch in stream:
            rows = {"kind": [], "id": [], "n": [], "print": [], "tokens": [], "counts": []}
            for doc, text in zip(batch.column(0).to_pylist(), binary(batch, "text")):
                found = shingles(hashes.of((text or b"").lower().split()), size)
                n = len(found)
                head = n - need(n, percent) + int(longest(n, percent))
                sums = np.array([np.bitwise_xor.reduce(found), np.add.reduce(found * found)], np.uint64) if n else np.zeros(2, np.uint64)
                for key, value in zip(rows, (0, doc, n, sums.tobytes(), found[:head].tobytes(), None)):
                    rows[key].append(value)
                if doc is not None and n:
                    waiting.append(found)
                    held += n
                if held > CHUNK:
                    yield counted()
                    waiting, held = [], 0
            yield batches(rows, _SKETCH)
        if held:
            yield counted()
        hashes.clear()
        waiting.clear()
        give_back()

    return run


def _unpack(stream):
    schema = pa.schema([("token", pa.int64()), ("n", pa.int64())])
    for batch in stream:
        for token, count in zip(binary(batch, "tokens"), binary(batch, "counts")):
            yield batches({"token": np.frombuffer(token, np.int64), "n": np.frombuffer(count, np.int64)}, schema)


def _held(stream):
    """How many documents of a batch hold each n-gram."""
    schema = pa.schema([("token", pa.int64()), ("n", pa.int64())])
    for batch in stream:
        token, count = np.unique(np.frombuffer(b"".join(binary(batch, "tokens")), np.int64), return_counts=True)
        yield batches({"token": token, "n": count}, schema)


_POSTING = pa.schema([("token", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("matches", pa.int64()), ("most", pa.int64())])


class Prefixes:
    """Which n-grams of a document are looked up, and how many of them have to match."""

    def __init__(self, known: np.ndarray, counts: np.ndarray, percent: int):
        self.known, self.counts, self.percent = known, counts, percent

    def with_counts(self, tokens: np.ndarray, counts: np.ndarray) -> Prefixes:
        """The same with other counts as well, the larger of two; at most ``KNOWN`` of them, the largest."""
        known, at = np.unique(np.concatenate([self.known, tokens]), return_inverse=True)
        most = np.zeros(len(known), np.int64)
        np.maximum.at(most, at, np.concatenate([self.counts, counts]))
        kept = np.sort(np.lexsort((known, -most))[:KNOWN])
        return Prefixes(known[kept], most[kept], self.percent)

    def of(self, tokens: np.ndarray, n: int) -> tuple[np.ndarray, int] | None:
        """From the first ``tokens`` of the ``n``; None if they hold too few infrequent ones."""
        base = n - need(n, self.percent) + 1
        df = self._frequency(tokens)
        rare = np.flatnonzero(df <= HOT)
        cost = int(df[rare].sum()) - len(rare)
        matches = min(2 + int(np.log2(1 + cost)), MOST_MATCHES, max(1, n // 5))
        wanted = base - 1 + matches
        return (tokens[rare[:wanted]], matches) if len(rare) >= wanted else None

    def rare(self, tokens: np.ndarray) -> np.ndarray:
        return tokens[self._frequency(tokens) <= HOT]

    def _frequency(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.known):
            return np.ones(len(tokens), np.int64)
        at = np.minimum(np.searchsorted(self.known, tokens), len(self.known) - 1)
        return np.where(self.known[at] == tokens, self.counts[at], 1)


def _rows(listed: list[tuple[int, int, np.ndarray, int, int]]) -> pa.RecordBatch:
    tokens = [x[2] for x in listed] or [np.empty(0, np.uint64)]
    repeat = lambda i: np.repeat(np.array([x[i] for x in listed], np.int64), [len(t) for t in tokens] if listed else [])
    return batches({"token": np.concatenate(tokens).view(np.int64), "id": repeat(0), "n": repeat(1), "matches": repeat(3), "most": repeat(4)}, _POSTING)


def _listed(prefixes: Prefixes):
    """Look-ups of the documents whose heads do (id, n, tokens)."""

    def run(stream):
        for batch in stream:
            found = ((doc, n, prefixes.of(np.frombuffer(t, np.uint64), n)) for doc, n, t in zip(*_columns(batch)))
            yield _rows([(doc, n, *kept, n) for doc, n, kept in found if kept])

    return run


def _unlisted(prefixes: Prefixes):
    """Ids of the others."""
    schema = pa.schema([("id", pa.int64())])

    def run(stream):
        for batch in stream:
            yield batches({"id": [doc for doc, n, t in zip(*_columns(batch)) if not prefixes.of(np.frombuffer(t, np.uint64), n)]}, schema)

    return run


def _listed_whole(prefixes: Prefixes, often: bool):
    """Look-ups of documents known whole (id, tokens): on infrequent n-grams or, ``often``, on any.

    Documents with too few infrequent n-grams are looked up on all they have, so that others find them,
    and on the plain prefix of all n-grams, so that they find each other.
    """

    def run(stream):
        for batch in stream:
            out = []
            for doc, t in zip(batch.column(0).to_pylist(), binary(batch, "tokens")):
                tokens = np.frombuffer(t, np.uint64)
                n = len(tokens)
                kept = prefixes.of(tokens, n)
                if often and not kept:
                    most = int(min(MOST_MATCHES, need(n, prefixes.percent)))
                    common = n - len(prefixes.rare(tokens))
                    out.append((doc, n, tokens[: n - need(n, prefixes.percent) + most], most, common))
                elif not often:
                    out.append((doc, n, *(kept or (prefixes.rare(tokens), ALL)), n))
            yield _rows(out)

    return run


def _columns(batch: pa.RecordBatch) -> tuple[list, list, list]:
    return batch.column(0).to_pylist(), batch.column(1).to_pylist(), binary(batch, "tokens")


_LIST = "token long, id long, n long, matches long, most long"


def _sets(size: int):
    schema = pa.schema([("id", pa.int64()), ("tokens", pa.binary())])

    def run(stream):
        hashes = WordHashes()
        for batch in stream:
            yield batches({"id": batch.column(0).to_pylist(), "tokens": [shingles(hashes.of((t or b"").lower().split()), size).tobytes() for t in binary(batch, "text")]}, schema)
        hashes.clear()
        give_back()

    return run


def _most_frequent(counts: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The ``KNOWN`` n-grams with the largest counts, sorted, and their counts."""
    top = counts.orderBy(F.desc("n"), "token").limit(KNOWN).toArrow()
    known, often = top.column("token").to_numpy().view(np.uint64), top.column("n").to_numpy()
    order = np.argsort(known)
    return known[order], often[order]


def _whole(texts: DataFrame, heads: DataFrame, prefixes: Prefixes, size: int) -> DataFrame:
    """(id, tokens) of the documents whose heads do not do, from their texts; staged."""
    short = stage(heads.mapInArrow(_unlisted(prefixes), "id long").distinct(), "join-short")
    with rows_per_batch(texts.sparkSession, 1000):
        whole = with_ids(texts, "id", short).mapInArrow(_sets(size), "id long, tokens binary").where("octet_length(tokens) > 0")
        return stage(whole.dropDuplicates(["id", "tokens"]), "join-whole")


def _verified(percent: int):
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(stream):
        for batch in stream:
            a, b = [], []
            for x, y, s, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), binary(batch, "s"), binary(batch, "t")):
                s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
                common = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * common >= percent * (len(s) + len(t) - common):
                    a.append(x)
                    b.append(y)
            yield batches({"a": a, "b": b}, schema)

    return run


def _verify(docs: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """Links among ``pairs`` (a, b; staged), from whole texts of the documents in a pair; staged."""
    wanted = stage(pairs.select("a").union(pairs.select("b")).distinct(), "join-wanted")
    with rows_per_batch(docs.sparkSession, 1000):
        sets = stage(with_ids(docs, "id", wanted).mapInArrow(_sets(size), "id long, tokens binary"), "join-sets")
        left, right = sets.toDF("a", "s"), sets.toDF("b", "t")
        both = pairs.join(left, "a").join(right, "b").select("a", "b", "s", "t")
        return stage(both.mapInArrow(_verified(percent), "a long, b long").distinct(), "join-links")


def _may_link(percent: int):
    """Whether the most that a pair can share would do: all of the smaller set, or all of its frequent n-grams."""
    return F.least("most_a", "most_b") * (100 + percent) >= (F.col("n_a") + F.col("n_b")) * percent


def _pairs(met: DataFrame, percent: int) -> DataFrame:
    """(kind, a, b, ask) of met rows that may link. Two documents that both ask for ALL share any number."""
    least = F.least("matches_a", "matches_b")
    ask = F.when(least == ALL, 1).otherwise(least).alias("ask")
    return met.where(_may_link(percent)).select("kind", F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b"), ask)


def _enough(pairs: DataFrame) -> DataFrame:
    """Pairs (kind, a, b, matches asked for; one row per shared n-gram) that share what is asked for."""
    counted = pairs.groupBy("kind", "a", "b", "ask").agg(F.count(F.lit(1)).alias("shared"))
    return counted.where("shared >= ask").select("a", "b").distinct()


def similar_groups(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """(id, n_shingles, component_id) per row of ``docs``; component_id is the smallest id reachable by links.

    Words are lower-cased in A-Z only. Null and empty texts have no n-grams and are linked with nothing; a text
    shorter than ``size`` words is one n-gram. Rows without id are linked with nothing and get a null
    component. A row gets the component of its own text; rows that repeat an id with other texts are one node.
    An empty table gives no rows.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    with rows_per_batch(docs.sparkSession, 2000):
        sketch = stage(texts.mapInArrow(_sketch(size, percent), "kind byte, id long, n long, print binary, tokens binary, counts binary"), "join-sketch")
    rows = sketch.where("kind = 0").select("id", "n", "print", "tokens")

    # equal sets: the smallest id stands for all
    nodes = rows.where("n > 0 AND id IS NOT NULL").select("id", "n", "print")
    classes = stage(nodes.groupBy("n", "print").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("rows")).where("rows > 1"), "join-classes")
    key = F.xxhash64("id", "print").alias("key")
    copies = stage(nodes.join(classes.select("n", "print", "first"), ["n", "print"]).where("id <> first").select(key), "join-copies")
    heads = without_ids(rows.where("n > 0 AND id IS NOT NULL").select("id", "n", "tokens", key), "key", copies).drop("key")

    # Counts of a chunk leave out what is once in it, and chunks grow in number with the documents; those of the heads are whole.
    chunks = sketch.where("kind = 1").select("tokens", "counts").mapInArrow(_unpack, "token long, n long")
    counts = chunks.withColumn("in_heads", F.lit(0)).union(heads.select("tokens").mapInArrow(_held, "token long, n long").select("token", F.lit(0), "n"))
    counts = counts.groupBy("token").agg(F.greatest(F.sum("n"), F.sum("in_heads")).alias("n"))
    prefixes = Prefixes(*_most_frequent(counts.where("n >= 4")), percent)
    # Documents read whole bring n-grams that were in no head. Their counts may lengthen prefixes, so the choice is made once more.
    held = _whole(texts, heads, prefixes, size).mapInArrow(_held, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    prefixes = prefixes.with_counts(*_most_frequent(held.where(F.col("n") > HOT)))
    whole = _whole(texts, heads, prefixes, size)
    listed = heads.mapInArrow(_listed(prefixes), _LIST).union(whole.mapInArrow(_listed_whole(prefixes, False), _LIST))
    one = Window.partitionBy("token")
    rare = listed.withColumn("rows", F.count(F.lit(1)).over(one)).where("rows > 1").drop("rows")
    often_listed = stage(whole.mapInArrow(_listed_whole(prefixes, True), _LIST), "join-often")
    shared = often_listed.groupBy("token").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    frequent = often_listed.join(shared.select("token"), "token", "left_semi")
    rows_of = stage(rare.withColumn("kind", F.lit(0)).unionByName(frequent.withColumn("kind", F.lit(1))), "join-lists")

    # rows of one n-gram against the most central of them
    key, fields = ["kind", "token"], ["id", "n", "matches", "most"]
    side = lambda df, name, *more: df.select(*key, *more, *[F.col(c).alias(f"{c}_{name}") for c in fields])
    central = rows_of.groupBy(*key).agg(F.max_by(F.struct(*fields), F.struct("most", -F.col("id"))).alias("first"))
    central = stage(central.select(*key, "first.*"), "join-central")
    met = side(rows_of, "a").join(side(central, "b"), key).where("id_a <> id_b")
    star = stage(_enough(_pairs(met, percent)), "join-star")
    links = _verify(texts, star, size, percent)
    roots = components(links)
    home = rows_of.join(roots, F.col("id") == F.col("node"), "left").select(*key, *fields, F.coalesce("root", "id").alias("home"))
    shares = home.groupBy(*key, "home").agg(F.count(F.lit(1)).alias("rows"))
    main = shares.groupBy(*key).agg(F.max_by("home", F.struct("rows", "home")).alias("main"), F.count(F.lit(1)).alias("homes"))
    left = stage(home.join(main.where("homes > 1").select(*key, "main"), key), "join-left")

    # what is left: rows of one n-gram in different components
    strays = side(left.where("home <> main"), "a", F.col("home").alias("home_a"))
    other = side(left, "b", "main", F.col("home").alias("home_b"))
    apart = (F.col("home_a") != F.col("home_b")) & ((F.col("home_b") == F.col("main")) | (F.col("id_a") < F.col("id_b")))
    across = _pairs(strays.join(other, key).where(apart), percent)
    across = stage(_enough(across).join(star, ["a", "b"], "left_anti"), "join-across")
    more = _verify(texts, across, size, percent)
    if more.limit(1).count():
        roots = components(roots.toDF("b", "a").select("a", "b").union(more))

    every = rows.select("id", "n", "print").join(classes.drop("rows"), ["n", "print"], "left")
    named = every.withColumn("node", F.when(F.col("id").isNotNull(), F.coalesce("first", "id"))).join(roots.toDF("_node", "root"), F.col("node") == F.col("_node"), "left")
    return named.select("id", F.col("n").alias("n_shingles"), F.coalesce("root", "node").alias("component_id"))


def drop_similar(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id; rows without id stay.

    Where ids repeat with other texts, each (id, text) is a document of its own, is compared as such, and
    goes only if its own text does.
    """
    named = F.col(f"`{id_column}`").isNotNull()
    once = docs.where(named).groupBy(F.col(f"`{id_column}`").alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    if once:
        found = similar_groups(docs, id_column, text_column, size, percent)
        return without_ids(docs, id_column, stage(found.where("component_id <> id").select("id").distinct(), "join-gone"))
    key = document(id_column, text_column)
    nodes = docs.where(named).select(key.alias("node"), F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    found = similar_groups(nodes, "node", "text", size, percent).select(F.col("id").alias("node"), "component_id").distinct()
    members = stage(nodes.select("node", "id").distinct().join(found, "node"), "join-members")
    keep = members.groupBy("component_id").agg(F.min(F.struct("id", "node")).alias("keep")).select("component_id", F.col("keep.node").alias("keep"))
    gone = stage(members.join(keep, "component_id").where("node <> keep").select("node").distinct(), "join-gone")
    return without_ids(docs, F.when(named, key), gone)
