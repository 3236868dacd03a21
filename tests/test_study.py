"""A whole study on a small made-up cohort, from files to the comparison table."""

import gzip

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lociframe import schema
from lociframe.functions.pvalues import hwe_exact
from lociframe.functions.text import participant_header
from lociframe.plans import study
from lociframe.sources.sumstats import PUBLISHED_SCHEMA

N, V = 160, 12


@pytest.fixture(scope="module")
def inputs(tmp_path_factory):
    root = tmp_path_factory.mktemp("study")
    rng = np.random.default_rng(11)
    freq = rng.uniform(0.2, 0.6, V)
    freq[7] = 0.4
    g = rng.binomial(2, freq, (N, V))
    g[:, 7] = np.where(rng.random(N) < 0.5, 0, 2)  # far from equilibrium
    gp = np.full((N, V, 3), 0.02)
    gp[np.arange(N)[:, None], np.arange(V)[None, :], g] = 0.96
    info = np.full(V, 0.95)
    info[3] = 0.5
    maf = np.full(V, 0.3)
    maf[5] = 0.0005
    ids = 1000 + rng.permutation(N)
    people = {}
    for field, name in schema.SAMPLE_QC_FIELDS.items():
        if field == "eid":
            continue
        if name.startswith("genetic_principal"):
            people[participant_header(field)] = rng.normal(size=N).round(6)
        elif name == "age_at_recruitment":
            people[participant_header(field)] = rng.integers(40, 70, N)
        elif name == "genetic_sex":
            people[participant_header(field)] = rng.integers(0, 2, N)
        elif name == "ethnic_background":
            people[participant_header(field)] = 1001
        elif name == "sex_chromosome_aneuploidy":
            people[participant_header(field)] = [1 if i % 20 == 0 else None for i in range(N)]
        else:
            people[participant_header(field)] = 1
    table = pd.DataFrame({"eid": ids, **people})
    table.astype(object).where(table.notna(), "").to_csv(root / "main.csv", index=False)
    text = "".join(f"21:{100 + j}_A_G\trs{j}\t{100 + j}\tA\tG\t{maf[j]}\tG\t{info[j]}\n" for j in range(V))
    (root / "variants.txt").write_text(text)
    (root / "x.sample").write_text("ID_1 ID_2 missing sex\n0 0 0 D\n" + "".join(f"{i} {i} 0 1\n" for i in ids))
    traits = {"50": g[:, 0] * 0.5 + rng.normal(size=N), "20095_1": rng.normal(size=N), "20095_2": g[:, 1] + rng.normal(size=N)}
    phenotypes = pd.DataFrame({"userId": ids, "skipped": "x", **traits})
    phenotypes.loc[5, "20095_2"] = np.nan
    extra = phenotypes.iloc[[0]].assign(userId=1)
    pd.concat([phenotypes, extra]).to_csv(root / "phenotypes.tsv", sep="\t", index=False)
    (root / "dictionary.csv").write_text("FieldID,Field\n50,Standing height\n")
    (root / "published").mkdir()
    head = "\t".join(PUBLISHED_SCHEMA.names)
    for name in ("50_raw", "50_irnt", "20095_1", "7"):
        with gzip.open(root / "published" / f"{name}.both_sexes.tsv.gz", "wt") as f:
            f.write(head + "\n" + "".join(f"21\t21:{100 + j}:A:G\trs{j}\tG\t1000\t0.1\t0.01\t2.0\n" for j in range(8, V + 2)))
            f.write("22\t22:5:A:G\trs99\tG\t1000\t0.1\t0.01\t2.0\n")
    return root, g, table, ids, info, maf, phenotypes, gp


def test_study(spark, inputs, tmp_path):
    root, g, table, ids, info, maf, phenotypes, gp = inputs
    at = lambda name: str(tmp_path / name)
    rows = [("21", "21", j, i, gp[i, j].tolist()) for i in range(N) for j in range(V)]
    spark.createDataFrame(rows, "contig string, contig_name string, variant_index long, sample_index long, gp array<double>").write.parquet(at("gp"))

    study.convert_participants(spark, str(root / "main.csv"), at("main"))
    study.extract_sample_qc(spark, at("main"), at("qc.tsv"))
    study.pack_sample_qc(spark, at("qc.tsv"), at("qc"))
    study.integrate_genotypes(spark, at("gp"), str(root / "variants.txt"), str(root / "x.sample"), at("raw"), "21")
    study.run_qc_1(spark, at("raw"), at("qc1"))
    study.run_qc_2(spark, at("qc1"), at("qc"), at("gt"))
    kept = spark.read.parquet(at("gt") + "/variants").toPandas().set_index("variant_index")
    for j in range(V):
        p = hwe_exact(int((g[:, j] == 1).sum()), int((g[:, j] == 0).sum()), int((g[:, j] == 2).sum()))
        assert (j in kept.index) == (info[j] > 0.8 and maf[j] > 0.001 and p > 1e-10)
        if j in kept.index:
            assert kept.variant_hwe_p_value[j] == pytest.approx(p) and kept.variant_contig[j] == 20
            assert kept.variant_contig_name[j] == "21"
    assert {3, 5, 7}.isdisjoint(kept.index)
    report = {(r.table, r.filter): (r.kept, r.removed) for step in ("qc1", "gt") for r in spark.read.parquet(at(step) + "/report").collect()}
    high = sum(x > 0.8 for x in info)
    common = sum(x > 0.8 and y > 0.001 for x, y in zip(info, maf))
    assert report["variants", "high_info"] == (high, V - high)
    assert report["variants", "common"] == (common, high - common)
    assert report["variants", "in_equilibrium"] == (len(kept), common - len(kept))
    assert report["samples", "overall"][0] == sum(i % 20 > 0 for i in range(N))
    left = [i for i in range(N) if i % 20]
    assert sorted(r[0] for r in spark.read.parquet(at("gt") + "/samples").select("sample_index").collect()) == left

    study.extract_sample_ids(spark, at("gt"), at("ids.tsv"))
    study.filter_phenotypes(spark, str(root / "phenotypes.tsv"), at("ids.tsv"), at("kept.tsv"), report_path=at("phenotype_report"))
    assert [tuple(r) for r in spark.read.parquet(at("phenotype_report") + "/report").collect()] == [
        ("phenotypes", "in_genotype_samples", len(left), N + 1 - len(left))
    ]
    assert spark.read.csv(at("kept.tsv"), sep="\t", header=True).columns == list(phenotypes.columns)
    study.convert_phenotypes(spark, at("kept.tsv"), at("phenotypes"))
    assert spark.read.parquet(at("phenotypes")).count() == len(left)
    study.store_traits(spark, at("phenotypes"), str(root / "dictionary.csv"), at("gt"), at("traits"))
    names = {r.trait_id: r.trait_name for r in spark.read.parquet(at("traits") + "/traits").collect()}
    assert names == {"50": "Standing height", "20095_1": None, "20095_2": None}
    study.extract_trait_groups(spark, at("traits"), str(root / "published"), at("groups.tsv"))
    assert [r[0] for r in spark.read.csv(at("groups.tsv"), sep="\t", header=True).collect()] == ["50", "20095"]
    study.export_field_ids(spark, at("traits"), at("fields.tsv"))

    run = lambda **kw: study.run_association(spark, at("gt"), at("traits"), at("results"), npc=3, **kw)
    first = run(variables_path=at("variables"), trait_group_ids=at("groups.tsv"))
    assert sorted(tuple(r) for r in first.collect()) == [("21", 0, 50), ("21", 0, 20095)]
    assert run(trait_group_ids=[50, 20095, 999]).count() == 0  # nothing left to do
    results = spark.read.parquet(at("results")).toPandas()
    assert len(results) == len(kept) * 3
    study.run_association(spark, at("gt"), at("traits"), at("few"), npc=3, trait_group_ids=[50, 20095, 999], min_samples=len(left), report_path=at("report"))
    reported = {(r.trait_group_id, r.sample_size, r.ran) for r in spark.read.parquet(at("report") + "/batches").collect()}
    n_complete = len(left) - (5 in left)
    assert reported == {(50, len(left), True), (20095, n_complete, False)}
    assert [r[0] for r in spark.read.parquet(at("report") + "/missing_groups").collect()] == [999]
    assert spark.read.parquet(at("few")).count() == len(kept)

    pcs = [participant_header(f"x22009_0_{i}") for i in (1, 2, 3)]
    for trait, columns in (("50", ["50"]), ("20095_1", ["20095_1", "20095_2"]), ("20095_2", ["20095_1", "20095_2"])):
        use = np.array([i for i in left if phenotypes[columns].iloc[i].notna().all()])
        age, sex = (table[participant_header(f)].to_numpy(float)[use] for f in ("x21022_0_0", "x22001_0_0"))
        x = np.column_stack([age, age**2, sex, sex * age, sex * age**2, table[pcs].to_numpy()[use]])
        x = (x - x.mean(0)) / x.std(0)
        found = results[results.sample_trait_id == trait].set_index("variant_index")
        assert (found.sample_size == len(use)).all()
        for j in kept.index:
            code = 1 + np.rint(gp[use, j, 1:] * 254)
            dosage = ((code - 1) / 254) @ [1, 2]
            design = np.column_stack([np.ones(len(use)), x, dosage])
            beta = np.linalg.lstsq(design, phenotypes[trait].to_numpy()[use], rcond=None)[0][-1]
            assert found.variant_beta[j] == pytest.approx(beta, rel=1e-5, abs=1e-9)
            assert found.variant_id[j] == f"21:{100 + j}_A_G"

    variables = {n: spark.read.parquet(f"{at('variables')}/{n}") for n in schema.SNAPSHOT_COLUMNS}
    assert variables["samples"].count() == len(left) and variables["traits"].count() == 3 * len(left)

    study.merge_sumstats(spark, at("results"), str(root / "published"), at("merged"), trait_group_ids="50,20095")
    merged = spark.read.parquet(at("merged"))
    assert merged.columns == sorted(merged.columns) and merged.filter("contig <> '21'").count() == 0
    own, published = len(kept) * 3, 2 * (V + 2 - 8)
    both = 2 * len([j for j in kept.index if j >= 8])
    assert merged.count() == own + published - both
    assert merged.filter(F.col("ot_p_value").isNotNull() & F.col("gwas_p_value").isNotNull()).count() == both


def test_small_tables(spark, tmp_path):
    at = lambda name: str(tmp_path / name)
    (tmp_path / "vars.tsv").write_text("Field\tEXCLUDED\nSleep duration\t\nOther\t\nHeight\tYES\n")
    study.mark_variables(spark, at("vars.tsv"), at("marked.tsv"))
    marked = spark.read.csv(at("marked.tsv"), sep="\t", header=True)
    assert {tuple(r) for r in marked.collect()} == {("Sleep duration", None), ("Other", "YES-NOT_IN_SUBSET"), ("Height", "YES")}
    (tmp_path / "set.tsv").write_text("plate_name\twell\nP1\tA1\n")
    study.convert_sample_set(spark, at("set.tsv"), at("set.out"))
    assert [tuple(r) for r in spark.read.csv(at("set.out"), sep="\t", header=True).collect()] == [("P1", "A1", "true")]
    (tmp_path / "in.json").write_text('{"a": 1}\n{"a": 2}\n')
    study.convert_json(spark, at("in.json"), at("json.out"), 2)
    assert spark.read.parquet(at("json.out")).count() == 2
    packed = spark.createDataFrame([("1", 0, 0, 0b1110)], "contig string, variant_index long, byte_index int, byte int")
    samples = spark.createDataFrame([(0, 71), (1, 72)], "sample_index long, sample_id long")
    assert sorted((r.sample_id, r.call) for r in study.integrate_hard_calls(packed, samples, 2).collect()) == [(71, 1), (72, 2)]
