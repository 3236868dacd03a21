"""Mixing sources to target token shares by entropy balancing."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lociframe.llm.common import WORD
from lociframe.operators.reshape import number_rows
from lociframe.session import stage

LIMIT = 3.0  # no document is taken more often, no source beyond this multiple of its size
WEIGHTS = (1.0, 2.0, 3.0)
ROUNDS = 200  # far beyond what the bracketed Newton steps need; more means a fault
CLOSE = 1e-9
OFFSETS = 64
DIGITS = "decimal(38,9)"  # exact sums, so the order in which tasks end changes nothing


def _exact(c: Column) -> Column:
    return F.coalesce(F.sum(c.cast(DIGITS)).cast("double"), F.lit(0.0))


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT) -> DataFrame:
    """(source, source_size, target): the sources' shares of all words, capped and reshared by weight; staged.

    Sources in code point order, null last, get the weights in turn. A target is
    ``min(limit * size, level * weight)`` for the level at which the targets sum to all words; the level is
    found by Newton steps on the sum, one aggregation each, which end after finitely many as the sum is
    concave and piecewise linear in the level.
    """
    named = sizes.select("source", "source_size", F.col("source").isNull().alias("_last"))
    ranked = number_rows(named, "rank", ["_last", "source"])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    table = stage(ranked.select("source", "source_size", weight.alias("weight"), (limit * F.col("source_size")).alias("most")), "mix-sources")
    total, level = table.agg(F.sum("source_size")).first()[0] or 0, 0.0
    while True:
        capped = F.col("most") <= level * F.col("weight")
        fixed, free = table.agg(_exact(F.when(capped, F.col("most")).otherwise(0.0)), _exact(F.when(capped, 0.0).otherwise(F.col("weight")))).first()
        higher = (total - fixed) / free if free else level
        if higher <= level:
            break
        level = higher
    return stage(table.select("source", "source_size", F.least("most", level * F.col("weight")).alias("target")), "mix-targets")


def _tilts(bins: DataFrame, targets: DataFrame, limit: float) -> DataFrame:
    """(source, tilt): the minimum of each source's convex dual, by Newton steps kept in a bracket; staged.

    The rates ``min(limit, exp(tilt * size))`` are those closest in entropy to one copy each whose words sum to
    the target. The dual's gradient is words taken minus target, its curvature the sum of squared sizes
    over the documents below the limit.
    """
    spans = bins.where("size > 0").groupBy("source").agg(F.min("size").cast("double").alias("least"))
    ratio = F.log(F.col("target") / F.col("source_size")) / F.col("least")
    full = F.col("target") >= limit * F.col("source_size") * (1 - 1e-12)
    state = targets.where("target > 0").join(spans, targets["source"].eqNullSafe(spans["source"])).select(
        targets["source"], "target",
        F.least(ratio, F.lit(0.0)).alias("low"), (F.lit(math.log(limit)) / F.col("least")).alias("high"),
        F.when(full, F.lit(math.log(limit)) / F.col("least")).otherwise(0.0).alias("tilt"), full.alias("done"),
    )
    state = stage(state, "mix-tilts")
    for _ in range(ROUNDS):
        if not state.where("NOT done").limit(1).count():
            return state.select("source", "tilt")
        rate = F.least(F.lit(limit), F.exp(F.col("tilt") * F.col("size")))
        words = F.col("n") * F.col("size") * rate
        now = state.select(F.col("source").alias("_source"), "target", "low", "high", "tilt", "done")
        sums = (
            bins.join(now.where("NOT done").select("_source", "tilt"), F.col("source").eqNullSafe(F.col("_source")))
            .groupBy("source")
            .agg(_exact(words).alias("taken"), _exact(F.when(rate < limit, words * F.col("size")).otherwise(0.0)).alias("curve"))
        )
        over = F.col("taken") > F.col("target")
        low, high = F.when(over, F.col("low")).otherwise(F.col("tilt")), F.when(over, F.col("tilt")).otherwise(F.col("high"))
        step = F.col("tilt") - F.try_divide(F.col("taken") - F.col("target"), F.col("curve"))
        next_tilt = F.when((step > low) & (step < high), step).otherwise((low + high) / 2)
        near = (F.abs(F.col("taken") - F.col("target")) <= CLOSE * F.col("target")) | (low >= high) | (next_tilt == F.col("tilt"))
        moved = now.join(sums, F.col("_source").eqNullSafe(F.col("source")), "left")
        state = stage(
            moved.select(
                F.col("_source").alias("source"), "target",
                F.when(F.col("done"), F.col("low")).otherwise(low).alias("low"), F.when(F.col("done"), F.col("high")).otherwise(high).alias("high"),
                F.when(F.col("done") | near, F.col("tilt")).otherwise(next_tilt).alias("tilt"), (F.col("done") | near).alias("done"),
            ),
            "mix-tilts",
        )
    raise RuntimeError(f"the dual did not settle in {ROUNDS} rounds")


def _extras(classes: DataFrame) -> DataFrame:
    """(source, size, n, whole, extra): copies of every document of a class, and how many of them get one more.

    The fractions are rounded along the classes of a source in the order of size, so the words are off by less
    than one document; of ``OFFSETS`` starting points per source the one that comes closest is used.
    """
    before = Window.partitionBy("source").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    summed = classes.withColumn("due", F.col("n") * F.col("part").cast(DIGITS))
    summed = summed.withColumn("start", F.coalesce(F.sum("due").over(before), F.lit(0).cast(DIGITS)))
    offsets = [F.lit((i + 0.5) / OFFSETS).cast(DIGITS) for i in range(OFFSETS)]
    given = [(F.floor(F.col("start") + F.col("due") + u) - F.floor(F.col("start") + u)).cast("long") for u in offsets]
    due = _exact(F.col("n") * F.col("part").cast(DIGITS) * F.col("size"))
    errors = summed.groupBy("source").agg(due.alias("wanted"), *[F.sum(g * F.col("size")).alias(f"u{i}") for i, g in enumerate(given)])
    best = F.array_min(F.array(*[F.struct(F.abs(F.col(f"u{i}") - F.col("wanted")).alias("off"), F.lit(i).alias("i")) for i in range(OFFSETS)]))
    best = stage(errors.select(F.col("source").alias("_source"), best["i"].alias("offset")), "mix-offsets")
    u = ((F.col("offset") + 0.5) / OFFSETS).cast(DIGITS)
    extra = (F.floor(F.col("start") + F.col("due") + u) - F.floor(F.col("start") + u)).cast("long")
    return summed.join(best, F.col("source").eqNullSafe(F.col("_source"))).select("source", "size", "n", "whole", extra.alias("extra"))


def mix_plan(rows: DataFrame, weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT) -> DataFrame:
    """(source, size, source_size, target, whole, cut) for every (source, size) of ``rows`` (source, size, draw); staged.

    A row is taken ``whole`` times, and once more if its draw is at most ``cut``. Only classes in which
    some rows get the extra copy and some do not are ranked, over as many tasks as their rows need.
    """
    bins = stage(rows.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "mix-bins")
    targets = source_targets(bins.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size")), weights, limit)
    tilts = _tilts(bins, targets, limit).withColumnRenamed("source", "_source")
    rate = F.round(F.least(F.lit(float(limit)), F.exp(F.coalesce("tilt", F.lit(0.0)) * F.col("size"))), 9)
    rated = bins.join(tilts, F.col("source").eqNullSafe(F.col("_source")), "left").select("source", "size", "n", rate.alias("rate"))
    classes = stage(rated.select("source", "size", "n", F.floor("rate").alias("whole"), F.round(F.col("rate") - F.floor("rate"), 9).alias("part")), "mix-classes")
    extras = stage(_extras(classes), "mix-extras")
    named = targets.withColumnRenamed("source", "_t")
    plan = extras.join(named, F.col("source").eqNullSafe(F.col("_t"))).drop("_t")
    split = extras.where("extra > 0 AND extra < n").select(F.col("source").alias("_s"), F.col("size").alias("_z"), "extra")
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))
    ranked = number_rows(rows.join(split, same).select("source", "size", "draw", "extra"), "place", ["draw"], ["source", "size"])
    cuts = ranked.where("place = extra - 1").select(F.col("source").alias("_s"), F.col("size").alias("_z"), F.col("draw").alias("_cut"))
    cut = F.when(F.col("extra") == F.col("n"), F.lit(2**63 - 1)).otherwise(F.col("_cut"))
    return stage(plan.join(cuts, same, "left").select("source", "size", "source_size", "target", "whole", cut.alias("cut")), "mix-plan")


def _columns(id_column: str, text_column: str, source_column: str) -> list[Column]:
    return [F.col(source_column).alias("source"), word_count(F.col(text_column)).alias("size"), F.xxhash64(F.col(id_column)).alias("draw")]


def _with_copies(rows: DataFrame, plan: DataFrame) -> DataFrame:
    named = plan.withColumnsRenamed({"source": "_s", "size": "_z"})
    same = F.col("source").eqNullSafe(F.col("_s")) & (F.col("size") == F.col("_z"))
    copies = F.col("whole") + F.coalesce(F.col("draw") <= F.col("cut"), F.lit(False)).cast("long")
    return rows.join(named, same).withColumn("copies", copies)


def mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT) -> DataFrame:
    """(id, source, size, source_size, target, copies) per row of ``docs``: how often the mix takes it.

    Sizes are words; null text has none. All but the first and last steps work on a histogram of
    (source, size), since a rate depends on nothing else, so a source with a third of all rows costs its
    distinct sizes. Documents without words are taken once. Null is a source of its own, after all others.
    Of equal sizes the hash of the id decides who gets an extra copy; rows that repeat an id get the same
    number. The same input gives the same copies; an empty table gives none.
    """
    rows = stage(docs.select(F.col(id_column).alias("id"), *_columns(id_column, text_column, source_column)), "mix-rows")
    plan = mix_plan(rows, weights, limit)
    return _with_copies(rows, plan).select("id", "source", "size", "source_size", "target", "copies")


def take_mix(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", source_column: str = "source", weights: tuple[float, ...] = WEIGHTS, limit: float = LIMIT) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it, with their own columns."""
    keys = _columns(id_column, text_column, source_column)
    plan = mix_plan(stage(docs.select(*keys), "mix-rows"), weights, limit)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), *keys)
    repeated = _with_copies(rows, plan).where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return repeated.select("_row.*")
