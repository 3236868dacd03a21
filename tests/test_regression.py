"""Association against a direct least-squares solve."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lociframe.operators import checks
from lociframe.operators import regression as R
from lociframe.operators.traits import batch_traits
from lociframe.session import stage

N, V, K, T = 180, 13, 3, 5


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    g = rng.integers(0, 3, (N, V)).astype(float)
    g[:, 1] = 0.0  # never called
    g[:, 2] = 1.0  # constant
    g[rng.random(N) < 0.9, 3] = 0.0
    x = rng.normal(size=(N, K))
    y = g[:, :T] * 0.4 + x @ rng.normal(size=(K, T)) + rng.normal(size=(N, T)) + 1000
    y[rng.random((N, T)) < 0.06] = np.nan
    y[30:, 4] = np.nan  # a small batch
    values = [(i + 1000, f"{50 + t // 3}_{t}", None if np.isnan(y[i, t]) else float(y[i, t])) for i in range(N) for t in range(T)]
    trait_values = spark.createDataFrame(values, "sample_id long, trait_id string, value double")
    ids = trait_values.select("trait_id").distinct().withColumn("trait_group_id", F.substring_index("trait_id", "_", 1).cast("long"))
    batches = batch_traits(ids, 2)
    samples = spark.createDataFrame(pd.DataFrame({"sample_id": np.arange(N) + 1000, "sample_index": np.arange(N), "covariate": list(x)}))
    calls = spark.createDataFrame(
        [("1", j, i, float(g[i, j])) for i in range(N) for j in range(V)], "contig string, variant_index long, sample_index long, dosage double"
    )
    return g, x, y, trait_values, batches, samples, calls


def shape(**kw):
    return R.Shape(**{"n_covariates": K, "batch_size": 2, "sample_width": 64, "variant_width": 4, "columns_per_pass": 12, **kw})


def direct(g, x, y):
    design = np.column_stack([np.ones(len(g)), x, g])
    coef, rss, rank, _ = np.linalg.lstsq(design, y, rcond=None)
    dof = len(y) - rank
    se = np.sqrt(rss[0] / dof * np.linalg.inv(design.T @ design)[-1, -1])
    return coef[-1], se, dof


@pytest.mark.parametrize("form", ["rows", "tiles"])
def test_matches_least_squares(data, form):
    g, x, y, trait_values, batches, samples, calls = data
    given = calls.filter("dosage <> 0") if form == "rows" else R.pack_blocks(calls, 64)
    got = R.associate(given, samples, trait_values, batches, shape(), min_samples=40).toPandas()
    members = batches.toPandas().groupby("batch_key").trait_id.apply(list)
    seen = 0
    for ids in members:
        cols = [int(t.split("_")[1]) for t in ids]
        ok = ~np.isnan(y[:, cols]).any(axis=1)
        for t, col in zip(ids, cols):
            rows = got[got.trait_id == t].set_index("variant_index")
            if ok.sum() < 40:
                assert rows.empty
                continue
            assert (rows.sample_size == ok.sum()).all()
            for v in range(V):
                if v == 1 and form == "rows":
                    assert v not in rows.index
                elif v in (1, 2):
                    assert pd.isna(rows.beta[v]) and pd.isna(rows.p_value[v])
                else:
                    beta, se, dof = direct(g[ok, v], x[ok], y[ok, col])
                    assert rows.beta[v] == pytest.approx(beta, rel=1e-8) and rows.se[v] == pytest.approx(se, rel=1e-8)
                    assert rows.dof[v] == dof and 0 <= rows.p_value[v] <= 1
                    seen += 1
    assert seen >= 11 * 3


WIDE = {"sums_bytes": 2000, "matrix_bytes": 8 * 64 * 2 * 7 * 6}
STRIPED = {"sums_bytes": 8 << 20, "matrix_bytes": 1, "sample_width": 32, "columns_per_pass": 2048}


WIDER = {"sums_bytes": 300, "matrix_bytes": 1, "sample_width": 32, "most_blocks": 2}


@pytest.mark.parametrize("widths", [WIDE, STRIPED, WIDER], ids=["several variant blocks and passes", "stretches of samples", "wide blocks in stretches"])
def test_calls_in_rows_give_the_sums_of_packed_ones_whatever_the_widths(data, widths):
    _, _, _, trait_values, batches, samples, calls = data
    sized = shape(**widths)
    columns = ["variant_index", "trait_id", "sample_size", "beta", "se", "dof"]
    rows = R.associate(calls, samples, trait_values, batches, sized, min_samples=40).select(*columns).toPandas()
    tiles = R.associate(R.pack_blocks(calls, sized.sample_width), samples, trait_values, batches, sized, min_samples=40).select(*columns).toPandas()
    both = rows.merge(tiles, on=columns[:3], how="right")
    assert len(rows) == len(tiles[tiles.variant_index != 1]) > 0
    both = both[both.variant_index != 1]
    for c in ("beta", "se", "dof"):
        assert np.allclose(both[f"{c}_x"].astype(float), both[f"{c}_y"].astype(float), equal_nan=True)


def test_sparse_calls_are_shuffled_alone(data):
    """Neither the sample side nor a sum per call goes to every variant block, however many variants there are."""
    _, _, _, trait_values, batches, samples, calls = data
    wide = R.Shape(n_covariates=K, batch_size=2)
    rows = R.design(trait_values, batches, samples, wide)
    adjusted = stage(R.residuals(rows, R.solve(R.moments(rows), wide.k), wide), "adjusted")
    plan = R.contract(calls.filter("dosage <> 0"), adjusted, wide, 1_000_000)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "CoGroup" not in plan
    assert R.contract(calls.filter("dosage <> 0"), adjusted, wide, 1_000_000).rdd.getNumPartitions() < 60


def test_reads_of_the_sample_side_do_not_grow_with_the_variants(data):
    _, _, _, trait_values, batches, samples, calls = data
    wide = R.Shape(n_covariates=K, batch_size=2)
    rows = R.design(trait_values, batches, samples, wide)
    adjusted = stage(R.residuals(rows, R.solve(R.moments(rows), wide.k), wide), "adjusted")
    assert R.contract(calls, adjusted, wide, 4_000_000).rdd.getNumPartitions() <= 32  # a task reads every matrix once
    one, many = R.row_tiles(wide, 4_000_000, 3, 1000), R.row_tiles(wide, 400_000_000, 3, 100_000)
    assert one[0] == many[0] == 32 and many[1] > one[1]  # more variants: stretches, which share the reads of a block


def test_repeated_call_in_rows_is_an_error(data):
    _, _, _, trait_values, batches, samples, calls = data
    for doubled in (calls.union(calls.limit(1)), calls.crossJoin(calls.sparkSession.range(2)).drop("id")):
        with pytest.raises(Exception, match="more than one call"):
            R.associate(doubled, samples, trait_values, batches, shape(), 40).count()


def test_missing_dosage_gives_null_for_its_variant_only(data):
    _, _, _, trait_values, batches, samples, calls = data
    holed = calls.withColumn("dosage", F.when(~((F.col("variant_index") == 5) & (F.col("sample_index") == 7)), F.col("dosage")))
    for given in (holed, R.pack_blocks(holed, 64)):
        got = R.associate(given, samples, trait_values, batches, shape(), min_samples=40).toPandas()
        got = got[got.variant_index.isin([5, 6]) & (got.trait_id == "50_0")].set_index("variant_index")
        assert pd.isna(got.beta[5]) and not pd.isna(got.beta[6])


def test_collinear_covariate_takes_no_part(data):
    g, x, y, trait_values, batches, samples, calls = data
    doubled = samples.withColumn("covariate", F.concat("covariate", F.array(F.col("covariate")[0] * 2 + 1)))
    plain = R.associate(calls, samples, trait_values, batches, shape(), 40).toPandas()
    extra = R.associate(calls, doubled, trait_values, batches, shape(n_covariates=K + 1), 40).toPandas()
    keys = ["trait_id", "variant_index"]
    both = plain.merge(extra, on=keys)
    assert np.allclose(both.beta_x.astype(float), both.beta_y.astype(float), equal_nan=True)
    assert (both.dof_x.dropna() == both.dof_y.dropna()).all()


def test_no_degrees_of_freedom_gives_null(spark, data):
    _, _, _, trait_values, batches, samples, calls = data
    few = samples.filter("sample_index < 5")
    got = R.associate(calls, few, trait_values, batches, shape(), min_samples=1)
    assert got.filter("beta is not null").count() == 0


def test_standardise_flags_constant_covariate(spark):
    df = spark.createDataFrame([(1, [1.0, 5.0]), (2, [3.0, 5.0])], "sample_id long, covariate array<double>")
    scaled = R.standardise(df, 2)
    assert [r.covariate for r in scaled.orderBy("sample_id").collect()] == [[-1.0, None], [1.0, None]]
    with pytest.raises(checks.CheckFailed):
        checks.require_finite_vector(scaled, "covariate")


def test_covariate_vector_is_25_wide(spark):
    df = spark.createDataFrame([(40, 1, [float(i) for i in range(40)])], "age_at_recruitment int, genetic_sex int, principal_component array<double>")
    got = R.covariate_vector(df).first().covariate
    assert got == [40.0, 1600.0, 1.0, 40.0, 1600.0] + [float(i) for i in range(20)]
