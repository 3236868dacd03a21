"""Hard negatives, whitening, token files, and what the filters drop, against brute force."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from lociframe.llm import exact_dedup, hard_negatives, jaccard_join, sentencepiece_codec, token_files, whitening

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
TEXTS = [
    "Plain words, with Capitals and commas; don't we'll I'VE 123 4.5",
    "J̌ J̌́ Ž é Ångström ẞ İstanbul ΣΣ ﬁ",
    "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> < | x |>",
    "a\tb\nc\rd\x0be\x0cf\x85g h i​j\x1ck\x00l",
    "中文 \U0001f600\U0001f600 ไทย " + "x" * 300 + " " + "é" * 80,
    "",
    None,
    " \n ",
    "one two three " * 2000,
]


def _direct(texts):
    tokenizer = Tokenizer.from_file(WORD_BPE)
    return [tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]


def test_chunks_give_the_ids_of_whole_texts(monkeypatch):
    monkeypatch.setattr(token_files, "REMEMBERED", 10)  # forget often
    monkeypatch.setattr(token_files, "ENCODED", 3)
    monkeypatch.setattr(token_files, "TOGETHER", 100)
    encoder = token_files.Encoder(WORD_BPE, 2, None)
    for _ in range(3):
        got = [np.frombuffer(b, "<u2").tolist() for b in encoder([None if t is None else t.encode() for t in TEXTS])]
        assert got == _direct(TEXTS)
    rng = np.random.default_rng(5)
    letters = np.array(list("aAbB.,'s!? \t\né̌̈中0<|>ß"))
    noise = ["".join(rng.choice(letters, 40)) for _ in range(300)]
    got = [np.frombuffer(b, "<u2").tolist() for b in encoder([t.encode() for t in noise])]
    assert got == _direct(noise)


def _token_table(spark, rows, tmp_path, per_part):
    docs = spark.createDataFrame(rows, "doc_id long, text string, tokens int, part string").repartition(3)
    path = f"file://{tmp_path}/files"
    token_files.write(docs, path, WORD_BPE, 1, rows_per_part=per_part)
    return path, token_files.read(spark, path).orderBy("start").collect()


@pytest.mark.parametrize("per_part", [2, 5, 1000])
def test_token_files_round_trip(spark, tmp_path, per_part):
    # Null, negative and repeated ids (one of them in a third of the rows), equal rows, columns named like the operator's own.
    rows = [(i, TEXTS[i % len(TEXTS)], 1, "x") for i in range(-3, 12)] + [(None, "no id", 2, None), (None, None, 3, "y")]
    rows += [(7, f"text number {i}", 1, "z") for i in range(9)] + [(7, "text number 1", 1, "z")]
    path, got = _token_table(spark, rows, tmp_path, per_part)
    assert [r.id for r in got] == sorted([r[0] for r in rows], key=lambda i: (i is not None, i or 0))
    ids = {t: _direct([t])[0] + [1] for _, t, *_ in rows}
    assert sorted((str(r.id), r.tokens) for r in got) == sorted((str(i), ids[t]) for i, t, *_ in rows)
    at = 0
    for r in got:
        assert (r.start, r.n_tokens) == (at, len(r.tokens))
        assert r.ids_crc32 == zlib.crc32(np.array(r.tokens, "<u4").tobytes())
        at += r.n_tokens
    files = token_files.TokenFiles(path)
    everything = [t for r in got for t in r.tokens]
    assert (files.n_docs, files.n_tokens) == (len(rows), at)
    assert files.tokens(0, at).tolist() == everything and files.tokens(5, at // 2).tolist() == everything[5 : 5 + at // 2]
    assert [files.document(n).tolist() for n in range(len(rows))] == [r.tokens for r in got]


def test_no_token_files(spark, tmp_path):
    path, got = _token_table(spark, [], tmp_path, 5)
    assert got == [] and token_files.TokenFiles(path).n_tokens == 0
    with pytest.raises(TypeError):
        token_files.write(spark.createDataFrame([("a", "b")], "doc_id string, text string"), f"{tmp_path}/other", WORD_BPE)


def _vectors(rng, n, d=12, spread=None):
    x = rng.normal(size=(n, d)) * (np.linspace(1, 3, d) if spread is None else spread)
    return x.round(3)


SHAPE = "vec_id long, embedding array<double>, label int, x string, n int"


def _table(spark, vectors, labels, extra=()):
    rows = [(i, v.tolist(), int(k), "x", 1) for i, (v, k) in enumerate(zip(vectors, labels))]
    return spark.createDataFrame([*rows, *extra], SHAPE).repartition(4)


UNFIT = [(900, None, 1, "x", 1), (950, [1.0, None] + [0.0] * 10, 1, "x", 1), (951, [float("nan")] * 12, 1, "x", 1), (952, [float("inf")] + [0.0] * 11, 2, "x", 1), (953, [], 2, "x", 1), (954, [1.0] * 5, 2, "x", 1)]


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(8)
    v = _vectors(rng, 300)
    v[200:] = v[100]  # a third are copies
    got = whitening.whiten(_table(spark, v, np.zeros(300), UNFIT)).toPandas().sort_values(["id", "component"])
    x = np.floor(256 * v).astype(np.int64)
    unique = np.unique(x, axis=0)
    n, sums = len(unique), unique.sum(0)
    values, axes = np.linalg.eigh(np.cov(unique.T, bias=True))
    values, axes = values[::-1], axes[:, ::-1]
    want = (x - sums / n) @ axes[:, :4] / np.sqrt(values[:4])
    found = got.whitened.to_numpy().reshape(300, 4)
    np.testing.assert_allclose(found * np.sign((found * want).sum(0)), want, atol=1e-10)
    assert (got.deviation.to_numpy().reshape(300, 4) == np.square(n * x - sums).sum(1)[:, None]).all() and set(got.n) == {n}
    np.testing.assert_allclose(got.explained.to_numpy()[:4], values[:4] / values.sum(), rtol=1e-12)
    assert got.identity_error.max() < 1e-10


@pytest.mark.parametrize("case", ["repeated eigenvalues", "low rank", "one direction", "no variation", "one row", "empty"])
def test_whitening_of_odd_tables(spark, case):
    rng = np.random.default_rng(4)
    if case == "repeated eigenvalues":  # opposite unit vectors: every direction varies alike
        v = np.concatenate([np.eye(12), -np.eye(12)])
    elif case == "low rank":
        v = rng.integers(-9, 9, (60, 2)) @ rng.integers(-3, 3, (2, 12)).astype(float)
    elif case == "one direction":
        v = np.outer(np.arange(5.0), np.ones(12))
    else:
        v = np.ones(({"no variation": 5, "one row": 1, "empty": 0}[case], 12))
    got = whitening.whiten(_table(spark, v, np.zeros(len(v)), UNFIT)).toPandas()
    rank = {"repeated eigenvalues": 4, "low rank": 2, "one direction": 1}.get(case, 0)
    assert len(got) == rank * len(v)
    if rank:
        assert got.identity_error.max() < 1e-9
        x = np.unique(np.floor(256 * v), axis=0)
        values = np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1]
        explained = got.groupby("component").explained.first().to_numpy()
        np.testing.assert_allclose(explained, values[:rank] / values.sum(), rtol=1e-9)


def test_deviations_beyond_64_bits():
    x = np.array([[1 << 30, 0], [3, 4]])
    assert whitening._deviations(x, 10, [0, 0]) == [None if 100 << 60 >= 1 << 63 else 100 << 60, 2500]
    assert whitening._deviations(x[1:], 1 << 31, [0, 0]) == [None]


def _brute(rows, is_anchor, n_positives=5, n_negatives=3, percent=(50, 95)):
    out = set()
    for a, x, k in rows:
        if not is_anchor(a):
            continue
        scored = sorted(((-int(x @ y), b, j) for b, y, j in rows if b != a))
        for s, p, _ in [t for t in scored if t[2] == k][:n_positives]:
            fits = [(t, b) for t, b, j in scored if j != k and percent[0] * -s <= 100 * -t <= percent[1] * -s][:n_negatives]
            out |= {(a, p, r + 1, b, -s, -t) for r, (t, b) in enumerate(fits)}
    return out


@pytest.mark.parametrize("spread", [1.0, "structured"])
def test_hard_negatives_against_brute_force(spark, monkeypatch, spread):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(7, 12))
    structured = np.repeat(rng.normal(size=(4, 3)), 3, axis=1).reshape(4, 9)[:, :3].repeat(4, axis=1)
    v = base[rng.integers(0, 7, 400)] + 0.4 * rng.normal(size=(400, 12)) if spread == 1.0 else structured[rng.integers(0, 4, 400)] * rng.uniform(0.2, 2, (400, 1))
    v[50:120] = v[50]  # ties
    v[0] = 0  # scores of zero
    labels = np.where(rng.random(400) < 0.4, 1, rng.integers(0, 6, 400))
    labels[399] = 99  # an anchor's label of one row
    extra = [*UNFIT, (401, [1.0] * 12, None, "x", 1), (None, [1.0] * 12, 1, "x", 1), (10, [9.0] * 12, 98, "x", 1)]
    monkeypatch.setattr(hard_negatives, "ANCHORS", 16)
    monkeypatch.setattr(hard_negatives, "ROWS", 90)
    monkeypatch.setattr(hard_negatives, "CHUNK_ROWS", 37)
    monkeypatch.setattr(hard_negatives, "CHUNK_ANCHORS", 7)
    got = hard_negatives.mine(_table(spark, v.round(3), labels, extra), F.col("vec_id") % 7 == 0).collect()
    x = np.floor(256 * v.round(3)).astype(np.int64)
    rows = [(i, x[i], int(labels[i])) for i in range(400)]
    want = _brute(rows, lambda i: i % 7 == 0)
    assert len(want) > 100 and {tuple(r) for r in got} == want and len(got) == len(want)


def test_no_hard_negatives(spark):
    assert hard_negatives.mine(_table(spark, np.ones((0, 12)), []), F.col("vec_id") % 7 == 0).collect() == []
    assert hard_negatives.mine(_table(spark, np.ones((4, 12)), [1, 1, 2, 2]), F.lit(False)).collect() == []


@pytest.mark.parametrize("few", [0.0, 1.1])
def test_bounds_never_lose_a_pair(monkeypatch, few):
    monkeypatch.setattr(hard_negatives, "FEW", few)
    rng = np.random.default_rng(3)
    for d in (1, 3, 15, 64):
        sides = []
        for weighted, n in ((True, 20), (False, 50)):
            x = (rng.normal(size=(n, d)) * 100).astype(np.int64)
            summary = np.concatenate([p for s in hard_negatives.SEGMENTS for p in hard_negatives._segments(x, s)], axis=1)
            sides.append(hard_negatives.Side(x, summary, weighted))
        scores = sides[0].x @ sides[1].x.T
        low, high = np.quantile(scores, 0.6, axis=1).astype(np.int64), np.quantile(scores, 0.8, axis=1).astype(np.int64)
        wanted = rng.random(scores.shape) < 0.9
        a, r, s = hard_negatives.in_range(*sides, low, high, wanted)
        inside = wanted & (scores >= low[:, None]) & (scores <= high[:, None])
        assert sorted(zip(a.tolist(), r.tolist(), s.tolist())) == [(i, j, int(scores[i, j])) for i, j in np.argwhere(inside).tolist()]


def test_filters_keep_other_texts_of_an_id(spark):
    shape = "doc_id long, text string"
    rows = [(4, "one"), (4, "a unique text"), (5, "one"), (None, "one")]
    kept = exact_dedup.drop_exact_duplicates(spark.createDataFrame(rows, shape)).collect()
    assert sorted(map(tuple, kept), key=str) == sorted([(4, "a unique text"), (5, "one"), (None, "one")], key=str)
    long = "the quick brown fox jumps over the lazy dog and then some more words follow here"
    rows = [(1, long), (7, long), (7, "quite different words are written in this one text"), (9, long + " x"), (9, "nine"), (None, long), (12, None), (12, "")]
    kept = {tuple(r) for r in jaccard_join.drop_similar(spark.createDataFrame(rows, shape)).collect()}
    assert kept == {r for r in rows if r not in ((7, long), (9, long + " x"))}


def test_quality_stage_drops_one_text_of_an_id(spark, tmp_path):
    rng = np.random.default_rng(1)
    good = [" ".join(rng.choice("the river runs past old green hills and small quiet towns".split(), 40)) + "." for _ in range(60)]
    bad = [" ".join(rng.choice("$$$ !!! http://x | ### WIN %% @@ ==".split(), 40)) for _ in range(60)]
    rows = [(i, t, len(t)) for i, t in enumerate([*good, *bad])] + [(3, bad[0] + " !!!", 5), (None, bad[1], 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long")
    spark.createDataFrame([(i, int(i < 60)) for i in range(120)], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    kept = {(r.doc_id, r.text) for r in corpus_pipeline.quality(spark, docs, str(tmp_path)).collect()}
    assert {(3, good[3]), (None, bad[1])} <= kept and (3, bad[0] + " !!!") not in kept


def test_pairs_are_looked_up():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 40, 5000))
    table = sentencepiece_codec._Lookup(keys[::2], np.arange(len(keys[::2])), -7)
    got = table(keys.reshape(1, -1))[0]
    assert (got[::2] == np.arange(len(keys[::2]))).all() and (got[1::2] == -7).all()


def test_broadcasts_are_bounded():
    """Hinted broadcasts of the subpackage: the bitmap of fixed size, one row of templates and a model of fixed size."""
    import pathlib

    root = pathlib.Path(token_files.__file__).parent
    hits = {p.name for p in root.glob("*.py") if "broadcast(" in p.read_text()}
    assert hits == {"common.py", "license_scan.py", "quality_fm.py"}
