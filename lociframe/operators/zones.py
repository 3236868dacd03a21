"""Call blocks and variants by stretches of neighbouring variants, so that a region is read from its own files only.

A zone is ``width`` consecutive variant indices of a contig; ``zones`` holds the positions it spans. A folder of both tables
holds one zone or, where that would make more than some ``FOLDERS``, a stretch of neighbouring ones in order, so that what
a write and a listing send to the driver does not grow with the table. Variant files are nearly in order of position, so a region meets few zones, whatever the genome's size.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lociframe.session import stage

ZONE_WIDTH = 65_536
ZONE_KEYS = ["contig", "zone"]
FOLDERS = 2000
FOLDER_KEYS = ["contig", "stretch"]


def zone_of(width: int) -> Column:
    return F.floor(F.col("variant_index") / width).cast("long")


def _write(df: DataFrame, path: str, width: int, n_together: int) -> None:
    """By contig and stretch of zones; a large one is split over several files, each in order of its variants."""
    placed = df.withColumn("zone", zone_of(width)).withColumn("stretch", F.floor(F.col("zone") / n_together).cast("long"))
    placed = placed.hint("rebalance", *[F.col(c) for c in FOLDER_KEYS])
    ordered = placed.sortWithinPartitions(*FOLDER_KEYS, "zone", "variant_index")
    ordered.write.mode("overwrite").partitionBy(*FOLDER_KEYS).parquet(path)


def _together(variants: DataFrame, width: int) -> int:
    """Zones in a folder: one, unless all contigs' zones are more than ``FOLDERS``."""
    of_contig = variants.groupBy("contig").agg((F.max(zone_of(width)) - F.min(zone_of(width)) + 1).alias("n"))
    return max(1, -(-(of_contig.agg(F.sum("n").alias("n")).first().n or 0) // FOLDERS))


def zone_map(variants: DataFrame, position: str) -> DataFrame:
    """(contig, zone, n_variants, first_position, last_position); variants without a position are counted only."""
    spans = F.min(position).alias("first_position"), F.max(position).alias("last_position")
    folder = [F.min("stretch").alias("stretch")] if "stretch" in variants.columns else []
    return variants.groupBy(*ZONE_KEYS).agg(F.count(F.lit(1)).alias("n_variants"), *spans, *folder)


def write_zones(calls: DataFrame, variants: DataFrame, path: str, position: str = "variant_position", width: int = ZONE_WIDTH) -> None:
    """Blocks and variants of a genotype folder by zone, with the zone map; replaces what is there."""
    n_together = _together(variants, width)
    _write(calls, f"{path}/calls", width, n_together)
    _write(variants, f"{path}/variants", width, n_together)
    mapped = zone_map(_read(calls.sparkSession, f"{path}/variants"), position)
    mapped.coalesce(1).write.mode("overwrite").parquet(f"{path}/zones")


def _read(spark: SparkSession, path: str) -> DataFrame:
    """Contigs are names, though folders look like numbers."""
    kinds = spark.read.parquet(path).schema
    for c, kind in zip(FOLDER_KEYS, ("string", "long")):
        kinds = type(kinds)([f for f in kinds.fields if f.name != c]).add(c, kind)
    return spark.read.schema(kinds).parquet(path)


def _span() -> list[Column]:
    """First and last zone, and the folders they lie in."""
    return [F.min("zone").alias("first"), F.max("zone").alias("last"), F.min("stretch").alias("low"), F.max("stretch").alias("high")]


def _inside(contig: str, span) -> Column:
    """Rows of a contig in the zones of a span, by their folders and zones."""
    if span.first is None:
        return F.lit(False)
    return (F.col("contig") == contig) & F.col("stretch").between(span.low, span.high) & F.col("zone").between(span.first, span.last)


def meet(regions: DataFrame, zones: DataFrame) -> DataFrame:
    """Regions (contig, start, end and other columns) with each zone of the map that they overlap, a row per pair.

    A contig is cut into bins about as long as its zones, at most as many as it has zones. Regions and zones are compared
    where they lie in one bin, and a pair that shares several is taken in the first of them.
    """
    zones = zones.filter(F.col("first_position").isNotNull())
    low, high = F.col("first_position").cast("long"), F.col("last_position").cast("long")
    extent = zones.groupBy("contig").agg(F.min(low).alias("_low"), F.max(high).alias("_high"), F.count(F.lit(1)).alias("_n"), F.avg(high - low).alias("_mean"))
    width = F.ceil(F.greatest(F.col("_mean"), (F.col("_high") - F.col("_low")) / F.col("_n"), F.lit(1.0))).cast("long")
    bins = extent.select("contig", "_low", "_high", width.alias("_width"))

    def binned(df: DataFrame, first: Column, last: Column, name: str) -> DataFrame:
        first, last = F.greatest(first.cast("long"), "_low"), F.least(last.cast("long"), "_high")
        inside = df.join(bins, "contig").withColumns({"_first": first, "_last": last}).filter("_first <= _last")
        inside = inside.withColumns({c: F.expr(f"({c} - _low) div _width") for c in ("_first", "_last")})
        return inside.withColumn("_bin", F.explode(F.sequence("_first", "_last"))).withColumnRenamed("_first", name).drop("_last", "_low", "_high", "_width")

    of_regions = binned(regions, F.col("start"), F.col("end"), "_bin_region")
    of_zones = binned(zones, F.col("first_position"), F.col("last_position"), "_bin_zone")
    near = of_regions.join(of_zones, ["contig", "_bin"]).filter((F.col("first_position") <= F.col("end")) & (F.col("last_position") >= F.col("start")))
    return near.filter(F.col("_bin") == F.greatest("_bin_region", "_bin_zone")).drop("_bin", "_bin_region", "_bin_zone", "first_position", "last_position")


def read_region(spark: SparkSession, path: str, contig: str, start: int, end: int, position: str = "variant_position") -> tuple[DataFrame, DataFrame]:
    """Variants whose position is from ``start`` to ``end``, both included, and their blocks.

    One row of the zone map, the first and last zone with their folders, is taken to the driver; the scans open files of the
    folders between, and in them the row groups of the zones between. Without such a zone both tables are empty.
    """
    met = spark.read.parquet(f"{path}/zones").filter(
        (F.col("contig") == contig) & (F.col("first_position") <= end) & (F.col("last_position") >= start)
    )
    inside = _inside(contig, met.agg(*_span()).first())
    variants = _read(spark, f"{path}/variants").filter(inside & F.col(position).between(start, end)).drop("stretch")
    calls = _read(spark, f"{path}/calls").filter(inside).drop("stretch")
    return variants, calls.join(variants.select(*ZONE_KEYS, "variant_index"), [*ZONE_KEYS, "variant_index"], "left_semi")


def join_regions(spark: SparkSession, path: str, regions: DataFrame, position: str = "variant_position") -> DataFrame:
    """Variants in each of many regions (contig, start, end and other columns), both ends included.

    Regions meet the zone map first, by equal contig and bin of positions, and then the variants of the zones they overlap, by
    equal contig and zone: variants are compared with regions of their own zone only. The first and last zone met of each contig
    are taken to the driver, a row per contig, and zones outside them are not read.
    """
    zones = spark.read.parquet(f"{path}/zones").select(*ZONE_KEYS, "stretch", "first_position", "last_position")
    near = stage(meet(regions, zones), "regions")
    spans = near.groupBy("contig").agg(*_span()).collect()
    met = [_inside(s.contig, s) for s in spans]
    variants = _read(spark, f"{path}/variants").filter(reduce(lambda a, b: a | b, met, F.lit(False))).drop("stretch")
    placed = near.drop("stretch").join(variants, ZONE_KEYS)
    return placed.filter(F.col(position).between(F.col("start"), F.col("end")))
