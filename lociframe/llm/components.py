"""Connected components of an undirected graph, as repeated joins over staged edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.session import stage


def _mark(edges: DataFrame):
    return edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("hi", "lo").cast("decimal(38,0)"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b) but the roots; the root is the smallest node.

    Alternates the two star steps: every node hands its larger neighbours, then its smaller ones,
    to the smallest node it knows. The number of rounds grows with the logarithm of the nodes.
    Minima are combined before each shuffle, and hub nodes' joins can be split.
    """
    pairs = links.where("a <> b").select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
    edges = stage(pairs.distinct(), "edges")
    mark = _mark(edges)
    while mark[0]:
        both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(edges.select("lo", "hi"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("hi"), F.col("m").alias("lo")).distinct()
        large = stage(large, "large-star")
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").where("lo <> m").select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
        edges = stage(small.union(least.select("hi", "m")).distinct(), "small-star")
        before, mark = mark, _mark(edges)
        if before == mark:
            break
    return edges.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
