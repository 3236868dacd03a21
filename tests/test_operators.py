import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lociframe.functions import genotype as G
from lociframe.functions import text as X
from lociframe.operators import checks, filters, reshape, sumstats, traits


def test_filter_report_counts_each_filter_over_all_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, 3.0), (None, 4.0)], "a int, b double")
    conditions = {"a_small": F.col("a") < 3, "has_b": F.col("b").isNotNull()}
    got = {r[0]: (r[1], r[2]) for r in filters.filter_report(df, conditions).collect()}
    assert got == {"a_small": (2, 2), "has_b": (3, 1), "overall": (1, 3)}
    assert filters.apply_filters(df, conditions).count() == 1
    assert [r[0] for r in filters.filter_report(df, {"only": F.col("a") < 3}).collect()] == ["only"]


def test_hard_call_ties_and_missing(spark):
    rows = [([0.4, 0.4, 0.2],), ([0.1, 0.2, 0.7],), ([0.1, None, 0.9],), ([float("nan"), 0.5, 0.5],), (None,)]
    df = spark.createDataFrame(rows, "gp array<double>")
    assert [r[0] for r in df.select(G.hard_call(F.col("gp"))).collect()] == [0, 2, None, None, None]
    counts = filters.genotype_counts(df.withColumn("variant_index", F.lit(0))).first()
    assert (counts.n_het, counts.n_hom_ref, counts.n_hom_alt) == (0, 1, 1)


def test_quantise_round_trip_and_missing(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (0.5,), (None,), (float("nan"),)], "p double")
    got = df.select(G.quantise(F.col("p")).alias("c")).select("c", G.dequantise(F.col("c")).alias("p")).collect()
    assert [r.c for r in got] == [1, 255, 128, 0, 0]
    assert got[0].p == 0.0 and got[1].p == 1.0 and got[3].p is None


def test_packed_calls(spark):
    # Lowest bits first: 00 no copy, 01 missing, 10 one copy, 11 two copies.
    df = spark.createDataFrame([(0b11100100,)], "b int")
    assert df.select(G.packed_calls(F.col("b"))).first()[0] == [0, None, 1, 2]


@pytest.mark.parametrize("size", [1, 2, 7, 100])
def test_batches_equal_array_split(spark, size):
    counts = {50: 1, 1990: 9, 20095: 23, 41210: 140}
    rows = [(f"{g}_{i:04d}", g, f"name {g} {i}") for g, n in counts.items() for i in range(n)]
    df = spark.createDataFrame(rows, "trait_id string, trait_group_id long, trait_name string").repartition(5)
    got = traits.batch_traits(df, size).toPandas()
    for group, n in counts.items():
        ids = sorted(t for t, g, _ in rows if g == group)
        parts = np.array_split(np.array(ids, dtype=object), int(np.ceil(n / size)))
        for b, part in enumerate(parts):
            rows_b = got[(got.trait_group_id == group) & (got.batch_index == b)].sort_values("trait_index")
            assert list(rows_b.trait_id) == list(part) and list(rows_b.trait_index) == list(range(len(part)))
            assert (rows_b.batch_size == len(part)).all() and (rows_b.group_name == f"name {group} 0").all()


def test_number_rows_in_hot_and_missing_groups(spark):
    rows = [("hot" if i % 10 else None, i) for i in range(5000)]
    df = spark.createDataFrame(rows, "g string, k long").repartition(13)
    got = reshape.number_rows(df, "at", ["k"], ["g"]).toPandas()
    for group in (got[got.g == "hot"], got[got.g.isna()]):
        assert list(group.sort_values("k")["at"]) == list(range(len(group)))
    assert len(got) == 5000
    everything = reshape.number_rows(df, "at", ["k"]).toPandas()
    assert (everything["at"] == everything["k"]).all()


def test_batch_key_padding(spark):
    df = spark.createDataFrame([(7, 50), (1234, 50)], "b int, g long")
    assert [r[0] for r in df.select(X.batch_key(F.col("b"), F.col("g"))).collect()] == ["007_50", "1234_50"]


def test_complete_cases_drop_partial_samples(spark):
    values = spark.createDataFrame(
        [(1, "50_a", 1.0), (1, "50_b", 2.0), (2, "50_a", 3.0), (2, "50_b", None), (3, "50_b", 5.0), (4, "50_a", float("nan")), (4, "50_b", 1.0)],
        "sample_id long, trait_id string, value double",
    )
    batches = traits.batch_traits(spark.createDataFrame([("50_b", 50), ("50_a", 50)], "trait_id string, trait_group_id long"))
    got = traits.complete_cases(values, batches).collect()
    assert [(r.sample_id, r.y) for r in got] == [(1, [1.0, 2.0])]


def test_exclusions(spark):
    df = spark.createDataFrame([("Sleep duration", None), ("Other", None), (None, None), ("Other", "YES")], "Field string, EXCLUDED string")
    assert [r.EXCLUDED for r in filters.mark_excluded(df, ["sleep"]).collect()] == [None, "YES-NOT_IN_SUBSET", "YES-NOT_IN_SUBSET", "YES"]
    assert filters.mark_excluded(df, None).collect() == df.collect()


def test_member_forms(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,), (3,)], "g long")
    table = spark.createDataFrame([("2",), ("3",)], "v string")
    assert filters.member_filter(df, "g", None).count() == 3
    assert filters.member_filter(df, "g", "1,3").count() == 2
    assert filters.member_filter(df, "g", [2, "3"]).count() == 2
    assert filters.member_filter(df, "g", table).count() == 2
    listed = tmp_path / "groups.tsv"
    listed.write_text("trait_group_id\n50\n1990\n")
    known = spark.createDataFrame([("50",), ("50",), ("7",)], "trait_group_id string")
    ids = lambda v: sorted(r[0] for r in filters.trait_group_members(spark, known, v).collect())
    assert ids(None) == [7, 50] and ids(str(listed)) == [50, 1990] and ids(["50", 7]) == [7, 50]


def test_checks_fail_the_job(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(checks.CheckFailed):
        checks.require_unique(df, ["k"])
    checks.require_unique(df, ["k", "v"])
    with pytest.raises(ValueError):
        filters.flag_sample_set(df, "flag")
    genotype = spark.createDataFrame([(1, 0), (2, 1)], "sample_id long, sample_index long")
    values = spark.createDataFrame([(1, "50", 1.0)], "sample_id long, trait_id string, value double")
    with pytest.raises(checks.CheckFailed):
        traits.order_as_genotypes(values, genotype)


def test_left_side_wins_on_shared_columns(spark):
    left = spark.createDataFrame([(1, "gt")], "sample_id long, batch string")
    right = spark.createDataFrame([(1, "qc", 5), (2, "qc", 6)], "sample_id long, batch string, age int")
    assert [tuple(r) for r in traits.add_sample_qc(left, right).collect()] == [(1, "gt", 5)]
    assert traits.add_traits(right, left).columns == ["sample_id", "batch", "age"]


def _sides(spark, own_rows, published_rows):
    own = spark.createDataFrame(
        own_rows, "trait_id string, contig string, variant_id string, gwas_p_value double, gwas_variant_beta double"
    )
    published = spark.createDataFrame(
        published_rows, "trait_id string, contig string, variant_id string, ot_p_value double, ot_beta double"
    )
    return own, published


def test_merge_keeps_both_sides(spark):
    own, published = _sides(
        spark, [("50", "21", "21:1:A:G", 0.0, 1.0), ("50", "21", "21:2:A:G", 0.01, 2.0)], [("50", "21", "21:2:A:G", 0.1, 2.5), ("50", "X", "X:9:A:G", 1.0, 3.0)]
    )
    merged = sumstats.merge_results(own, published)
    assert merged.columns == sorted(merged.columns)
    got = {r.variant_id: (r.gwas_log_p_value, r.ot_log_p_value) for r in merged.collect()}
    assert got == {"21:1:A:G": (float("inf"), None), "21:2:A:G": (2.0, 1.0), "X:9:A:G": (None, 0.0)}
    stats = sumstats.replication_stats(merged).first()
    assert (stats.n_both, stats.n_own_only, stats.n_published_only) == (1, 1, 1)


def test_merge_rejects_duplicate_keys(spark):
    own, published = _sides(spark, [("50", "21", "v", 0.1, 1.0)] * 2, [("50", "21", "v", 0.1, 2.5)])
    with pytest.raises(Exception, match="duplicate keys .* in own results; first: 50, 21, v"):
        sumstats.merge_results(own, published).collect()
    with pytest.raises(Exception, match="duplicate keys .* in published results"):
        sumstats.merge_results(own.limit(1), published.union(published)).count()


def test_merge_moves_each_side_once(spark):
    own, published = _sides(spark, [("50", "21", "v", 0.1, 1.0)], [("50", "21", "v", 0.1, 2.5)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = sumstats.merge_results(own, published)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2 and "SortMergeJoin" in text


def test_own_columns_accept_bytes(spark):
    row = [(bytearray(b"50_x"), "n", 50, "x", bytearray(b"21"), bytearray(b"21:5_A_G"), 5, 0.5, 0.1, 10, 0, 1)]
    df = spark.createDataFrame(
        row,
        "sample_trait_id binary, sample_trait_name string, sample_trait_group_id long, sample_trait_code_id string, variant_contig_name binary,"
        "variant_id binary, variant_position int, variant_p_value double, variant_beta double, sample_size long, batch_index int, batch_size int",
    )
    got = sumstats.own_result_columns(df).first()
    assert (got.trait_id, got.contig, got.variant_id, got.gwas_sample_size) == ("50_x", "21", "21:5:A:G", 10)


def test_column_profile(spark):
    df = spark.createDataFrame(pd.DataFrame({"a": [1, 2], "b": ["x", None]}))
    assert [tuple(r) for r in filters.column_profile(df).collect()] == [("a", "bigint", 2), ("b", "string", 1)]


def test_filters_are_counted_by_the_job_that_writes(spark, tmp_path):
    rows = spark.range(100).selectExpr("id", "CASE WHEN id % 10 > 0 THEN id % 10 END AS a")
    rows.write.parquet(str(tmp_path / "in"))
    conditions = {"high": F.col("a") > 5, "early": F.col("id") < 50}
    for n in (100, 0):  # a table without rows reports zeros
        df = spark.read.parquet(str(tmp_path / "in")).filter(f"id < {n}")
        kept, tally = filters.observed_filters(df, conditions, {"odd": F.col("id") % 2 == 1})
        spark.sparkContext.setJobGroup(f"write {n}", "")
        kept.write.parquet(str(tmp_path / f"out{n}"))
        got = tally()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(f"write {n}")
        assert len(jobs) <= 1
        of_first = [tuple(r) for r in filters.filter_report(df, conditions).collect()]
        met = filters.apply_filters(df, conditions)
        assert got == of_first + [tuple(r) for r in filters.filter_report(met, {"odd": F.col("id") % 2 == 1}).collect()]
        assert spark.read.parquet(str(tmp_path / f"out{n}")).count() == got[-1][1]


def test_only_common_variants_with_calls_are_tested(spark):
    variants = spark.createDataFrame([(0, 0.3), (1, 0.0), (2, 0.3), (3, None)], "variant_index long, maf double")
    counts = spark.createDataFrame([(0, 10, 10, 10), (1, 10, 10, 10), (3, 1, 1, 1)], "variant_index long, n_het long, n_hom_ref long, n_hom_alt long")
    got = {r.variant_index: (r.n_het, r.hwe_p_value is not None) for r in filters.counted_variants(variants, counts).collect()}
    assert got == {0: (10, True), 1: (None, False), 2: (None, False), 3: (None, False)}


def test_complete_cases_by_bitmap(spark):
    rng = np.random.default_rng(5)
    ids = rng.permutation(70_000)[:400]  # over three bitmaps
    samples = spark.createDataFrame([(int(i) + 7, int(i)) for i in ids], "sample_id long, sample_index long")
    rows = [(int(i) + 7, t, [1.0, None, float("nan")][rng.choice(3, p=[0.8, 0.1, 0.1])]) for i in ids for t in ("a", "b", "c") if rng.random() < 0.9]
    rows = [r for r in rows if r[1] != "c" or r[0] < 40_000]  # no bitmap of a whole block
    values = spark.createDataFrame([*rows, (999_999, "a", 1.0)], "sample_id long, trait_id string, value double")
    batches = spark.createDataFrame(
        [("a", "k1", 0, 2), ("b", "k1", 1, 2), ("c", "k2", 0, 1), ("d", "k3", 0, 1)], "trait_id string, batch_key string, trait_index int, batch_size int"
    )
    complete = traits.complete_case_bitmaps(traits.presence_bitmaps(values, samples), batches)
    got = {(r.batch_key, r.sample_index + 7) for r in traits.bitmap_samples(complete).collect()}
    known = traits.complete_cases(values.join(samples, "sample_id"), batches)
    assert got == {(r.batch_key, r.sample_id) for r in known.collect()} and got
    sizes = {r.batch_key: r.sample_size for r in traits.bitmap_sample_sizes(complete).collect()}
    assert sizes == {r.batch_key: r.sample_size for r in traits.sample_sizes(known).collect()}
    twice = traits.presence_bitmaps(values.union(values), samples)
    assert traits.bitmap_sample_sizes(traits.complete_case_bitmaps(twice, batches)).count() == len(sizes)
    assert traits.bitmap_samples(complete.limit(0)).count() == 0
