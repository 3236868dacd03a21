import gzip

import pytest
from pyspark.sql import functions as F

from lociframe import schema
from lociframe.sources import genotypes, participants, sinks, sumstats


def test_participants_code_page_and_bad_ids(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('eid,31-0.0,22000-0.10\n1,café,€5\n,x,y\nabc,x,y\n2,,b\n'.encode("cp1252"))
    (tmp_path / "b.csv").write_bytes(b"eid,31-0.0,22000-0.10\n3,,\n")
    df = participants.read_participants(spark, str(tmp_path))
    assert df.dtypes == [("eid", "int"), ("x31_0_0", "string"), ("x22000_0_10", "string")]
    assert sorted((tuple(r) for r in df.collect()), key=str) == [(1, "café", "€5"), (2, None, "b"), (3, None, None)]


def test_participants_need_the_id_first(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,31-0.0\n1,2\n")
    with pytest.raises(ValueError, match="eid"):
        participants.read_participants(spark, str(tmp_path))


def test_text_table_keeps_empty_and_na(spark, tmp_path):
    (tmp_path / "p.tsv").write_text("userId\ta\tb\n1\t\tNA\n2\tx\t\n")
    got = participants.read_text_table(spark, str(tmp_path / "p.tsv"), ("userId",)).collect()
    assert [tuple(r) for r in got] == [(1, "", "NA"), (2, "x", "")]


def test_dictionary(spark, tmp_path):
    (tmp_path / "d.csv").write_text('Path,FieldID,Field\np,50,"Standing height, cm"\n')
    assert [tuple(r) for r in participants.read_dictionary(spark, str(tmp_path / "d.csv")).collect()] == [("50", "Standing height, cm")]


def test_sample_ids_are_distinct(spark, tmp_path):
    (tmp_path / "ids.tsv").write_text("sample_id\n5\n5\n7\n")
    assert sorted(r[0] for r in participants.read_sample_ids(spark, str(tmp_path / "ids.tsv")).collect()) == [5, 7]


def test_variant_info_index_over_many_splits(spark, tmp_path):
    path = tmp_path / "mfi.txt"
    path.write_text("".join(f"21:{i}_A_G\trs{i}\t{i}\tA\tG\t0.25\tG\t0.5\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8192")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = genotypes.read_variant_info(spark, str(path), with_index=True)
        assert got.select("variant_allele").first()[0] == ["A", "G"]
        assert got.filter("variant_index <> variant_position").count() == 0 and got.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_sample_file_skips_type_row(spark, tmp_path):
    path = tmp_path / "s.sample"
    path.write_text("ID_1 ID_2 missing sex\n0 0 0 D\n101 101 0 1\n99 99 0 2\n")
    got = genotypes.read_sample_file(spark, str(path), with_index=True).orderBy("sample_index").collect()
    assert [tuple(r) for r in got] == [(101, 1, 0), (99, 2, 1)]


def test_hard_call_samples(spark, tmp_path):
    (tmp_path / "x.fam").write_text("f 7 0 0 1 -9\nf 8 0 0 2 -9\n")
    assert [tuple(r) for r in genotypes.read_hard_call_samples(spark, str(tmp_path / "x.fam")).collect()] == [(7, 1), (8, 2)]


def test_packed_calls_drop_padding(spark):
    df = spark.createDataFrame([(0, 0, 0b11100100, 6), (0, 1, 0b00001110, 6)], "variant_index long, byte_index int, byte int, n int")
    got = genotypes.expand_packed_calls(df, "byte", "n").orderBy("sample_index").collect()
    assert [(r.sample_index, r.call) for r in got] == [(0, 0), (1, None), (2, 1), (3, 2), (4, 1), (5, 2)]


def test_calls_masks_and_dynamic_overwrite(spark, tmp_path):
    path = str(tmp_path / "calls")
    cols = "contig string, variant_index long, sample_index long, gp_het short, gp_hom_alt short, call_mask int"
    sinks.write_calls(spark.createDataFrame([("1", 0, 0, 128, 1, 0), ("2", 0, 0, 0, 1, 1)], cols), path)
    sinks.write_calls(spark.createDataFrame([("2", 5, 0, 1, 255, 0)], cols), path)
    got = genotypes.read_calls(spark, path, unpack=True).orderBy("contig").collect()
    assert [r.variant_index for r in got] == [0, 5] and got[0].call_mask is False
    assert got[0].dosage == pytest.approx(0.5) and got[1].gp == [0.0, 0.0, 1.0]


def test_contigs(spark):
    imputed, hard = genotypes.contigs(spark), genotypes.contigs(spark, imputed=False)
    assert imputed.count() == 24 and hard.count() == 26
    assert imputed.agg(F.sum(F.col("n_variants").cast("long"))).first()[0] == 97059328
    last = imputed.filter("name = 'XY'").first()
    assert (last["index"], last.code, last.n_consent_samples) == ("24", "25", "486331")
    assert set(imputed.dtypes) == {(f.name, "string") for f in schema.CONTIG}


def test_manifests(spark, tmp_path):
    for name in ["ukb_chr21_003_41210_Z94_2.parquet", "ukb_chrXY_000_50.parquet", "notes.txt"]:
        (tmp_path / name).write_text("x")
    files = sumstats.list_files(spark, str(tmp_path))
    own = sumstats.own_manifest(files).collect()
    assert [(r.contig, r.batch, r.trait_id, r.trait_group_id, r.trait_code_id) for r in own] == [("21", 3, "41210_Z94_2", "41210", "Z94_2")]
    assert sumstats.own_manifest(files, all_contigs=True).count() == 2


HEADER = "variant\tchromosome\tvariant_id\textra\tminor_allele\tn_complete_samples\tbeta\tp-value\ttstat\n"


def test_published_files(spark, tmp_path):
    for name, p in [("50_raw.both.tsv.gz", 0.5), ("50_irnt.both.tsv.gz", 0.9), ("20095_2.both.tsv.gz", 0.1)]:
        with gzip.open(tmp_path / name, "wt") as f:
            f.write(HEADER + f"21:1:A:G\t21\trs1\tjunk\tA\t1000\t0.01\t{p}\t0.67\n")
    files = sumstats.list_files(spark, str(tmp_path))
    manifest = sumstats.published_manifest(files)
    assert sorted(r.trait_id for r in manifest.collect()) == ["20095_2", "50"]
    assert sorted(r[0] for r in sumstats.published_trait_groups(files).collect()) == [50, 20095]
    got = {r.trait_id: r for r in sumstats.read_published(spark, str(tmp_path)).collect()}
    assert sorted(got) == ["20095_2", "50"] and got["50"].ot_p_value == 0.5 and got["50"].contig == "21"
    assert got["20095_2"].ot_trait_code_id == "2" and got["50"].ot_variant_rsid == "rs1"
    only = sumstats.read_published(spark, str(tmp_path), manifest.filter("trait_id = '50'"))
    assert [r.trait_id for r in only.collect()] == ["50"]
    assert [f.rsplit("/", 1)[1] for f in only.inputFiles()] == ["50_raw.both.tsv.gz"]
    none = sumstats.read_published(spark, str(tmp_path), manifest.filter("trait_id = '7'"))
    assert none.count() == 0 and none.columns == only.columns


def test_published_files_with_other_column_orders(spark, tmp_path):
    names = HEADER.rstrip("\n").split("\t")
    row = dict(zip(names, ["21:1:A:G", "21", "rs1", "junk", "A", "1000", "0.01", "0.5", "0.67"]))
    for trait, order in (("50", names), ("60", names[::-1]), ("70", sorted(set(names) - {"extra"}))):
        with gzip.open(tmp_path / f"{trait}.both.tsv.gz", "wt") as f:
            f.write("\t".join(order) + "\n" + "\t".join(row[c] for c in order) + "\n")
    got = sumstats.read_published(spark, str(tmp_path)).drop("trait_id", "ot_trait_group_id").collect()
    assert len(got) == 3 and len(set(got)) == 1 and got[0].ot_p_value == 0.5 and got[0].variant_id == "21:1:A:G"


def test_published_files_with_missing_columns(spark, tmp_path):
    with gzip.open(tmp_path / "50.tsv.gz", "wt") as f:
        f.write("variant\tbeta\n")
    with pytest.raises(ValueError, match="columns missing"):
        sumstats.read_published(spark, str(tmp_path))


def test_headers_of_many_files_are_read_in_one_job(spark, tmp_path, monkeypatch):
    names = [*(f"{i} of%3A#1+.tsv.gz" for i in range(12)), "empty.tsv.gz", "long.tsv.gz", "plain.tsv"]
    lines = {n: f"a\t{n}" for n in names} | {"empty.tsv.gz": "", "long.tsv.gz": "x" * 10_000}
    for n in names:
        data = (lines[n] + "\r\nsecond\n").encode() if lines[n] else b""
        (tmp_path / n).write_bytes(data if n == "plain.tsv" else gzip.compress(data))
    files = [r.file for r in sumstats.list_files(spark, str(tmp_path)).collect()]
    expected = {n: line or None for n, line in lines.items()}
    spark.sparkContext.setJobGroup("headers", "headers")
    got = {r.file.rsplit("/", 1)[1]: r.line for r in sumstats.first_lines(spark, files).collect()}
    assert got == expected
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("headers")) == 1
    monkeypatch.setattr(sumstats, "_OPENED_BY_TASKS", ())  # as on a file system that only Spark opens
    scanned = {r.file.rsplit("/", 1)[1]: r.line for r in sumstats.first_lines(spark, files).collect()}
    assert scanned == {n: line for n, line in expected.items() if line}


def test_repartitioned_write_refuses_to_replace(spark, tmp_path):
    df = spark.range(10)
    sinks.write_repartitioned(df, str(tmp_path / "out"), 3)
    assert spark.read.parquet(str(tmp_path / "out")).count() == 10
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        sinks.write_repartitioned(df, str(tmp_path / "out"), 3)
