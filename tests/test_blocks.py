"""Calls as blocks, against the same work on rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from lociframe.functions import genotype as G
from lociframe.operators import blocks, filters, layout
from lociframe.plans import study
from lociframe.sources import genotypes

CALLS = "contig string, variant_index long, sample_index long, gp array<double>"


def _probabilities(spark, n_variants=5, n_samples=37, seed=3):
    rng = np.random.default_rng(seed)
    rows = []
    for v in range(n_variants):
        for s in range(n_samples):
            p = rng.dirichlet([0.4, 0.4, 0.4]).tolist()
            if rng.random() < 0.1:
                p[int(rng.integers(3))] = float("nan") if rng.random() < 0.5 else None
            if rng.random() < 0.9:
                rows.append(("21", v, s, p))
    rng.shuffle(rows)
    return spark.createDataFrame([(c, int(v), int(s), p) for c, v, s, p in rows], CALLS)


def test_counts_of_code_blocks_are_those_of_their_rows(spark):
    calls = _probabilities(spark).where("gp[0] IS NOT NULL").repartition(4)
    packed = blocks.pack_codes(calls, width=8)
    assert packed.columns == ["contig", "variant_index", "sample_block", "codes"] and packed.count() == 25
    assert {len(r.codes) for r in packed.collect()} == {16}
    stored = genotypes.pack_calls(calls)
    het, alt = G.dequantise(F.col("gp_het")), G.dequantise(F.col("gp_hom_alt"))
    rows = stored.select("contig", "variant_index", G.unpack_probability(het, alt).alias("gp"))
    keys = ("contig", "variant_index")
    want = {tuple(r) for r in filters.genotype_counts(rows, keys).collect()}
    got = {tuple(r) for r in blocks.count_codes(packed, keys).select(*keys, "n_het", "n_hom_ref", "n_hom_alt").collect()}
    assert got == want
    dosages = {(r.variant_index, r.sample_index): r.d for r in stored.select(*keys, "sample_index", G.dosage(het, alt).alias("d")).collect()}
    for r in packed.collect():
        for pos, d in enumerate(blocks.dosages_of_codes([bytes(r.codes)])[0]):
            expected = dosages.get((r.variant_index, r.sample_block * 8 + pos))
            assert (expected is None and np.isnan(d)) or d == pytest.approx(expected, abs=1e-6)


def test_blocks_refuse_a_second_call(spark):
    calls = spark.createDataFrame([("1", 0, 3, [0.1, 0.2, 0.7])] * 2, CALLS).repartition(2)
    with pytest.raises(Exception, match="more than one call"):
        blocks.pack_codes(calls, width=8).collect()


def test_other_samples_become_missing(spark):
    packed = blocks.pack_codes(_probabilities(spark), width=8)
    kept = spark.createDataFrame([(1,), (2,), (9,)], "sample_index long")
    left = blocks.keep_samples(packed, kept, width=8)
    assert {r.sample_block for r in left.collect()} == {0, 1}
    before = {(r.variant_index, r.sample_block): r.codes for r in packed.collect()}
    for r in left.collect():
        for plane in range(2):
            for pos in range(8):
                want = before[r.variant_index, r.sample_block][plane * 8 + pos] if r.sample_block * 8 + pos in (1, 2, 9) else 0
                assert r.codes[plane * 8 + pos] == want


@pytest.mark.parametrize("n_samples", [1, 15, 16, 17, 27, 32])
def test_bit_planes_count_hard_calls(spark, n_samples):
    rng = np.random.default_rng(n_samples)
    n_bytes = -(-n_samples // 4)
    data = rng.integers(0, 256, (3, n_bytes))
    rows = [("1", v, b, int(data[v, b])) for v in range(3) for b in range(n_bytes)]
    packed = blocks.pack_hard_calls(spark.createDataFrame(rows, "contig string, variant_index long, byte_index long, byte int").repartition(3), width=16)
    got = {r.variant_index: (r.n_het, r.n_hom_ref, r.n_hom_alt, r.n_missing) for r in blocks.count_hard_calls(packed, n_samples, width=16).collect()}
    for v in range(3):
        calls = [(int(data[v, s // 4]) >> 2 * (s % 4)) & 3 for s in range(n_samples)]
        assert got[v] == (calls.count(2), calls.count(0), calls.count(3), calls.count(1))
    wide = blocks.codes_of_hard_calls(packed, width=16)
    for r in wide.collect():
        for pos, d in enumerate(blocks.dosages_of_codes([bytes(r.codes)])[0]):
            s = r.sample_block * 16 + pos
            if s < n_samples:
                call = (int(data[r.variant_index, s // 4]) >> 2 * (s % 4)) & 3
                assert np.isnan(d) if call == 1 else d == [0, None, 1, 2][call]


def test_layout_survives_its_table(spark, tmp_path):
    packed = blocks.pack_codes(_probabilities(spark), width=8)
    path = str(tmp_path / "calls")
    layout.write_layout(packed, path, 5, 2)
    layout.write_layout(packed, path, 5, 2)  # once more in the same place
    stored = layout.read_layout(spark, path)
    assert {tuple(r) for r in stored.drop(layout.BUCKET).collect()} == {tuple(r) for r in packed.collect()}
    plan = stored.groupBy(layout.BUCKET).count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and spark.read.parquet(f"{path}_layout").first().n_blocks == 3


def test_hard_call_folder(spark, tmp_path):
    rng = np.random.default_rng(2)
    n, v = 90, 6
    calls = rng.choice([0, 2, 3, 1], (v, n), p=[0.35, 0.4, 0.2, 0.05])
    calls[2] = 0  # no variation
    calls[4] = np.where(rng.random(n) < 0.5, 0, 3)  # far from equilibrium
    padded = np.concatenate([calls, np.full((v, (-n) % 4), 3)], axis=1).reshape(v, -1, 4)
    data = (padded << np.array([0, 2, 4, 6])).sum(axis=2)
    at = lambda name: str(tmp_path / name)
    rows = [(i, b, int(data[i, b])) for i in range(v) for b in range(data.shape[1])]
    spark.createDataFrame(rows, "variant_index long, byte_index long, byte int").write.parquet(at("bytes"))
    (tmp_path / "x.variants").write_text("".join(f"25\trs{i}\t0\t{100 + i}\tA\tG\n" for i in range(v)))
    (tmp_path / "x.samples").write_text("".join(f"0 {500 + i} 0 0 {1 + i % 2} -9\n" for i in range(n)))
    study.convert_hard_calls(spark, at("bytes"), at("x.variants"), at("x.samples"), at("hard"), "XY")
    stored = spark.read.parquet(at("hard") + "/variants").orderBy("variant_index").collect()
    assert [(r.variant_id, r.variant_contig, r.variant_contig_name, r.contig) for r in stored[:1]] == [("rs0", 24, "25", "XY")]
    people = spark.read.parquet(at("hard") + "/samples").orderBy("sample_index").collect()
    assert [r.sample_id for r in people] == [500 + i for i in range(n)]
    assert spark.read.parquet(at("hard") + "/calls").columns == ["variant_index", "sample_block", "hard_calls", "contig"]
    study.run_hard_call_qc(spark, at("hard"), at("qc"))
    kept = {r.variant_index for r in spark.read.parquet(at("qc") + "/variants").collect()}
    assert kept == {0, 1, 3, 5}
    assert {r.variant_index for r in spark.read.parquet(at("qc") + "/calls").collect()} == kept
    report = {r.filter: (r.kept, r.removed) for r in spark.read.parquet(at("qc") + "/report").collect()}
    assert report == {"common": (5, 1), "in_equilibrium": (4, 1)}
