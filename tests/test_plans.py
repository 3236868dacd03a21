"""Plans that must hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entries
from lociframe.plans import domain as D
from lociframe.plans.registry import table

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


@pytest.mark.parametrize("name", ["qc_calls", "gwas_sparse", "gwas_batched", "sumstat_full_outer", "positional_merge", "covariate_scale"])
def test_no_cross_join(spark, name):
    text = plan(entries.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_filters_and_columns_reach_the_scan(spark):
    rows = table(spark, FOLDER, "part").filter("p_size > 10").select("p_partkey")
    text = plan(rows)
    assert "GreaterThan(p_size,10)" in text and "ReadSchema: struct<p_partkey:bigint,p_size:int>" in text


def test_sparse_calls_read_four_columns(spark):
    text = plan(D.sparse_dosages(spark, FOLDER))
    schemas = set(re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert schemas == {"l_orderkey:bigint,l_partkey:bigint", "o_orderkey:bigint,o_custkey:bigint"}


def test_only_the_contig_dimension_is_hinted(spark):
    import pathlib

    root = pathlib.Path(entries.__file__).parent / "lociframe"
    ours = [p for p in root.rglob("*.py") if "llm" not in p.relative_to(root).parts]  # which has a test of its own
    hits = [p.name for p in ours if "broadcast(" in p.read_text()]
    assert hits == ["ingest.py"]


def test_calls_are_shuffled_once_into_tiles(spark):
    df = entries.queries()["gwas_sparse"](spark, FOLDER)
    text = df._jdf.queryExecution().executedPlan().toString()
    tiles = [line for line in text.splitlines() if "Exchange hashpartitioning(variant_block" in line]
    assert len(tiles) == 2 and all("REPARTITION_BY_NUM" in line for line in tiles)


def test_stored_calls_and_their_sums_are_not_shuffled(spark):
    from lociframe.operators import layout, regression
    from lociframe.plans import association
    from lociframe.session import shared_path

    shape = regression.Shape(n_covariates=10, batch_size=2, sample_width=64, variant_width=16, columns_per_pass=60)
    path = shared_path(spark, "calls")
    layout.write_layout(regression.pack_blocks(D.dense_dosages(spark, FOLDER), 64), path, D.N_DENSE, 16)
    calls = layout.read_layout(spark, path)
    covariates, batches = association._covariates(spark, FOLDER, 5), D.trait_batches(spark, FOLDER)
    rows = regression.stage(regression.design(D.trait_values(spark, FOLDER), batches, covariates, shape), "design")
    adjusted = regression.stage(regression.residuals(rows, regression.solve(regression.moments(rows), shape.k), shape), "residuals")
    text = regression.contract_stored(calls, adjusted, shape)._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert text.count("FlatMapGroupsInArrow") > 1 and text.count("Bucketed: true") == text.count("FlatMapGroupsInArrow")
    assert "Exchange" not in text


def test_results_are_not_shuffled_once_a_trait_is_a_row(spark):
    from lociframe.operators import regression
    from lociframe.plans import association
    from lociframe.sources.sinks import RESULT_PARTITIONS

    shape = regression.Shape(n_covariates=10, batch_size=2)
    batches = D.trait_batches(spark, FOLDER)
    calls = regression.pack_blocks(D.dense_dosages(spark, FOLDER))
    variants = D.variants(spark, FOLDER).selectExpr("'1' AS contig", "variant_index", "variant_id AS name").distinct()
    only = batches.selectExpr("'1' AS contig", "batch_index", "trait_group_id").distinct()
    kinds = calls.select("contig").schema["contig"].dataType.simpleString()
    only, variants = (df.withColumn("contig", df["contig"].cast(kinds)) for df in (only, variants))
    described = batches.selectExpr("trait_id", "upper(trait_id) AS described")
    covariates = association._covariates(spark, FOLDER, 5)
    values = D.trait_values(spark, FOLDER)
    found = regression.associate(
        calls, covariates, values, batches, shape, 10, D.N_DENSE, variants=variants, described=described, only=only, together=RESULT_PARTITIONS
    )
    text = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    above, below = text.split("Generate inline", 1)
    assert "Exchange" not in above and "Join" not in above
    assert "REBALANCE_PARTITIONS_BY_COL" in below and "Generate inline" not in below
    plain = regression.associate(calls, covariates, values, batches, shape, 10, D.N_DENSE)
    keys = ["contig", "variant_index", "trait_id"]
    expected = plain.join(variants, ["contig", "variant_index"]).join(described, "trait_id").join(only, ["contig", "batch_index", "trait_group_id"], "left_semi")
    a, b = (df.select(*keys, "name", "described", "sample_size", "beta").toPandas().sort_values(keys, ignore_index=True) for df in (found, expected))
    assert len(a) and a.equals(b)


def files_read(df) -> dict[str, int]:
    """Files each scan of a plan opens when it is first run, by the last part of its folder."""
    df.collect()
    found, todo = {}, [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "FileSourceScanExec":
            folder = node.relation().location().rootPaths().head().getName()
            found[folder] = max(found.get(folder, 0), node.metrics().apply("numFiles").value())
        children = node.children().iterator()
        while children.hasNext():
            todo.append(children.next())
    return found


def test_regions_are_read_from_their_own_files(spark, tmp_path):
    from lociframe.operators import zones

    variants = spark.range(1000).selectExpr("CAST(1 + id % 2 AS STRING) AS contig", "id AS variant_index", "CAST(1000 + 10 * id AS INT) AS variant_position")
    calls = variants.selectExpr("contig", "variant_index", "0L AS sample_block", "CAST('x' AS BINARY) AS codes")
    path = str(tmp_path / "zones")
    zones.write_zones(calls, variants, path, width=50)
    assert files_read(zones.read_region(spark, path, "2", 3000, 3200)[1]) == {"calls": 1, "variants": 1}
    kept, blocks = zones.read_region(spark, path, "2", 3000, 3200)
    expected = [i for i in range(200, 221) if i % 2]
    assert sorted(r.variant_index for r in kept.collect()) == expected
    assert sorted(r.variant_index for r in blocks.collect()) == expected
    assert zones.read_region(spark, path, "2", 90_000, 90_001)[1].count() == 0
    assert zones.read_region(spark, path, "7", 3000, 3200)[0].count() == 0
    regions = spark.createDataFrame([(1, "1", 0, 1020), (2, "2", 1490, 1530), (3, "1", 1490, 1530), (4, "9", 0, 9)], "region_id int, contig string, start int, end int")
    found = zones.join_regions(spark, path, regions)
    assert 0 < files_read(found)["variants"] <= 4  # of 20
    assert sorted((r.region_id, r.variant_index) for r in found.collect()) == [(1, 0), (1, 2), (2, 49), (2, 51), (2, 53), (3, 50), (3, 52)]


def test_region_meets_zones_of_its_bins_only(spark):
    from lociframe.operators import zones

    spans = [("1", z, 1000 * z, 1000 * z + 900) for z in range(200)] + [("1", 200, 0, 199_900), ("2", 0, 5, 5), ("2", 1, 7_000_000, 7_000_001), ("3", 0, None, None)]
    mapped = spark.createDataFrame(spans, "contig string, zone long, first_position int, last_position int")
    given = [(1, "1", 950, 1000), (2, "1", -50, 10**15), (3, "1", 905, 960), (4, "2", 6, 7_000_000), (5, "2", 0, 5), (6, "3", 0, 9), (7, "1", 500, 400), (8, "1", None, 5), (1, "1", 950, 1000)]
    regions = spark.createDataFrame(given, "region_id long, contig string, start long, end long")
    found = zones.meet(regions, mapped)
    pairs = [(r, z) for r, c, s, e in given for d, z, a, b in spans if c == d and None not in (s, e, a) and s <= e and a <= e and b >= s]
    assert sorted((r.region_id, r.zone) for r in found.collect()) == sorted(pairs)
    joins = [line for line in found._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert any("_bin" in line for line in joins)  # not contig alone, which compares all regions with all zones


def test_zones_beyond_the_folders_share_them(spark, tmp_path, monkeypatch):
    from lociframe.operators import zones

    monkeypatch.setattr(zones, "FOLDERS", 10)
    index = spark.range(1000).select(F.col("id").alias("variant_index"), F.lit("4").alias("contig"))
    variants = index.withColumn("variant_position", F.col("variant_index") * 10)
    path = str(tmp_path / "zones")
    zones.write_zones(index.withColumn("sample_block", F.lit(0)), variants, path, width=10)
    for name in ("calls", "variants"):
        assert len(list((tmp_path / "zones" / name / "contig=4").iterdir())) == 10
    kept, calls = zones.read_region(spark, path, "4", 3005, 3300)
    assert sorted(r.variant_index for r in kept.collect()) == sorted(r.variant_index for r in calls.collect()) == list(range(301, 331))
    assert set(kept.columns) == {"contig", "zone", "variant_index", "variant_position"}


def test_tiled_run_keeps_traits_without_degrees_of_freedom(spark, tmp_path):
    import datetime

    import numpy as np

    rng = np.random.default_rng(5)
    customers = [(i, i % 5, float(100 * i + rng.integers(90)), "BUILDING") for i in range(12)]
    vectors = [(i, rng.normal(size=64).tolist()) for i in range(12)]
    events = [(i, datetime.datetime(2024, 1, 2), "click", float(rng.normal())) for i in range(12)]
    spark.createDataFrame(customers, "c_custkey long, c_nationkey int, c_acctbal double, c_mktsegment string").write.parquet(str(tmp_path / "customer.parquet"))
    spark.createDataFrame(vectors, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    spark.createDataFrame(events, "user_id long, ts timestamp, event_type string, value double").write.parquet(str(tmp_path / "events.parquet"))
    rows = entries.queries()["gwas_tiled"](spark, str(tmp_path)).collect()
    assert {(r.trait_id, r.sample_size, r.beta) for r in rows} == {("50_0", 12, None)} and len(rows) == D.N_DENSE
