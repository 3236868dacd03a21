"""The training-data operators against brute force, and on empty, null, repeated and odd rows."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entries
import check
import corpus_pipeline
from lociframe.llm import chat_format, embedding_dedup, exact_dedup, jaccard_join, license_scan, lm_scoring, mixing, quality_fm, sentencepiece_codec, suffix_dedup
from lociframe.llm.components import components

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, size long, kept string, component_id int"


def docs_of(spark, texts, sources=None):
    """Documents 0, 1, ... with extra columns whose names the operators use as well."""
    rows = [(i, t, "en", (sources or ["s"] * len(texts))[i], len(t or ""), 7, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def words(n, seed):
    rng = random.Random(seed)
    return [f"w{rng.randrange(5000)}" for _ in range(n)]


ODD = [None, "", " \n\t", "one", "one", "two words", "x " * 30000, "x " * 30000]


@pytest.mark.parametrize("name", sorted(n for n in entries.queries() if n.startswith("op") and n in entries.oracle_sql()))
def test_sql(spark, name):
    text, _, _ = check.compare(spark, check.connect(FOLDER), name, FOLDER)
    assert text.startswith("ok"), text


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(149, 200), (300, 300)]
    found = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert all(found[i] == 0 for i in range(1, 41))
    assert all(found[i] == 100 for i in [*range(101, 150), 200])
    assert 300 not in found


def test_exact_dedup_odd_rows(spark):
    docs = docs_of(spark, ODD).union(spark.createDataFrame([(None, "one", None, None, None, None, None, None), (4, "one", "en", "s", 3, 7, "x", 1)], DOCS))
    left = exact_dedup.drop_exact_duplicates(docs)
    assert left.columns == docs.columns
    # 0 and 1 are both empty; 4 repeats itself; the row without id stays
    assert sorted(r.doc_id if r.doc_id is not None else -1 for r in left.collect()) == [-1, 1, 2, 4, 4, 5, 7]
    assert exact_dedup.drop_exact_duplicates(docs.limit(0)).count() == 0


def jaccard_groups(texts, percent=80):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(texts)), 2):
        common = len(sets[i] & sets[j])
        if common and 100 * common >= percent * len(sets[i] | sets[j]):
            a, b = sorted((top(i), top(j)))
            root[b] = a
    return [(i, len(s), top(i)) for i, s in enumerate(sets)]


def near_copies(base, n, edits, seed):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        copy = list(base)
        for _ in range(rng.randrange(edits)):
            copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
        out.append(" ".join(copy))
    return out


def test_jaccard_join_against_all_pairs(spark, monkeypatch):
    # a large group of near copies, a passage that many share, small groups, sizes from one word up
    monkeypatch.setattr(jaccard_join, "CHUNK", 2000)
    passage = words(60, 1)
    texts = near_copies(words(120, 2), 60, 8, 3) + near_copies(words(90, 4), 5, 3, 5)
    texts += [" ".join(words(40, 100 + i) + passage + words(30, 200 + i)) for i in range(50)]
    texts += [" ".join(passage[: 50 + i % 12] + words(i % 9, 300 + i)) for i in range(40)]
    texts += [" ".join(["be"] * (i % 13)) for i in range(20)] + ODD
    got = jaccard_join.similar_groups(docs_of(spark, texts)).collect()
    assert sorted((r.id, r.n_shingles, r.component_id) for r in got) == jaccard_groups(texts)
    kept = jaccard_join.drop_similar(docs_of(spark, texts))
    assert sorted(r.doc_id for r in kept.collect()) == sorted({c for _, _, c in jaccard_groups(texts)})


def test_frequent_ngrams_are_known_however_many_chunks_hold_them(spark, monkeypatch):
    """Copies of one text that differ too much to be linked, one to a chunk: no chunk has any of their n-grams twice."""
    rng, base, listed = random.Random(3), words(400, 8), {}
    texts = [" ".join(w if rng.random() > 0.06 else f"x{i}_{j}" for j, w in enumerate(base)) for i in range(30)]
    texts += [" ".join(words(400, 100 + i)) for i in range(10)] + [texts[4] + " end", texts[9] + " end"]
    stage = jaccard_join.stage
    monkeypatch.setattr(jaccard_join, "stage", lambda df, label: listed.setdefault(label, stage(df, label)) if label == "join-lists" else stage(df, label))
    got = jaccard_join.similar_groups(docs_of(spark, texts).repartition(len(texts), "doc_id")).collect()
    assert sorted((r.id, r.n_shingles, r.component_id) for r in got) == jaccard_groups(texts)
    most = listed["join-lists"].where("kind = 0").groupBy("token").count().agg(F.max("count")).first()[0]
    assert 2 <= most <= jaccard_join.HOT


def test_jaccard_join_without_ids_and_rows(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (3, "a b c d e f"), (9, "A B c d e f")], "doc_id long, text string")
    got = jaccard_join.similar_groups(docs).collect()
    assert sorted((r.id or -1, r.component_id or -1) for r in got) == [(-1, -1), (3, 3), (3, 3), (9, 3)]
    assert jaccard_join.similar_groups(docs.limit(0)).count() == 0


def spans(texts, least):
    seen, out = {}, []
    lists = [(t or "").encode().split() for t in texts]
    for i, w in enumerate(lists):
        for s in range(len(w) - least + 1):
            seen.setdefault(tuple(w[s : s + least]), []).append((i, s))
    hits = sorted({x for places in seen.values() if len(places) > 1 for x in places})
    for i, s in hits:
        if out and out[-1][0] == i and s <= out[-1][1] + out[-1][2]:
            out[-1][2] = s - out[-1][1] + least
        else:
            out.append([i, s, least])
    return [tuple(x) for x in out]


def test_repeated_spans_against_all_windows(spark):
    shared = [words(n, n) for n in (49, 50, 51, 75, 120)]
    texts = [" ".join(words(i % 30, i) + shared[i % 5] + words(i % 17, 50 + i)) for i in range(60)]
    texts += [" ".join(words(20, 9) + shared[3] + words(200, 8) + shared[3]), " ".join(words(300, 77)), " ".join(["a"] * 70), *ODD]
    got = suffix_dedup.repeated_spans(docs_of(spark, texts)).collect()
    assert sorted((r.id, r.start_word, r.n_words) for r in got) == spans(texts, 50)
    assert suffix_dedup.repeated_spans(docs_of(spark, texts).limit(0)).count() == 0


def test_backoff_on_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK", 50)
    docs = docs_of(spark, ["a b a b", "a b c", None, "", "c"])
    got = {r.id: (r.n_words, r.log_score) for r in lm_scoring.stupid_backoff(docs).collect()}
    bigram, single = math.log(3 / 3), lambda c: math.log(c / 8)
    assert got[2] == got[3] == (0, 0.0)
    assert got[4][1] == pytest.approx(single(2))
    assert got[0][1] == pytest.approx(single(3) + bigram + math.log(0.4**2) + single(3) + math.log(0.4) + bigram)
    assert got[1][1] == pytest.approx(single(3) + bigram + math.log(0.4**2) + single(2))
    assert lm_scoring.stupid_backoff(docs.limit(0)).count() == 0


def test_backoff_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(lm_scoring, "BLOCK", 300)
    rng = random.Random(4)
    texts = [[f"w{min(int(rng.expovariate(0.1)), 60)}" for _ in range(rng.randint(0, 60))] for _ in range(150)]
    df = lm_scoring.stupid_backoff(docs_of(spark, [" ".join(t) for t in texts]).repartition(5))
    counts = [Counter(tuple(t[i : i + n]) for t in texts for i in range(len(t) - n + 1)) for n in (0, 1, 2, 3)]
    total = sum(len(t) for t in texts)

    def score(text, end, n):
        if n == 1:
            return math.log(counts[1][(text[end],)] / total)
        seen = counts[n][tuple(text[end - n + 1 : end + 1])]
        return math.log(seen / counts[n - 1][tuple(text[end - n + 1 : end])]) if seen >= 2 else math.log(0.4) + score(text, end, n - 1)

    got = {r.id: r.log_score for r in df.collect()}
    assert len(got) == 150
    for i, text in enumerate(texts):
        assert got[i] == pytest.approx(sum(score(text, at, min(3, at + 1)) for at in range(len(text))), abs=1e-9)
    plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
    assert plan.count("Exchange hashpartitioning(block") == 1  # of the answers; the blocks stay in their buckets


def test_mix_targets_and_limits(spark):
    rng = random.Random(1)
    texts = [" ".join(["w"] * rng.randrange(0, 400)) for _ in range(900)] + [None, ""]
    sources = [rng.choice(["a", "b", "c", "d", None]) if i % 3 else "hot" for i in range(len(texts))]
    got = mixing.mix(docs_of(spark, texts, sources)).collect()
    sizes = {}
    for r in got:
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[i % 3] for i, s in enumerate(order)}
    left, capped = float(sum(sizes.values())), set()
    while True:
        share = sum(weight[s] for s in order if s not in capped)
        rest = left - sum(3 * sizes[s] for s in capped)
        over = {s for s in order if s not in capped and rest * weight[s] / share > 3 * sizes[s]}
        if not over:
            break
        capped |= over
    for s in order:
        rows = [r for r in got if r.source == s]
        target = 3 * sizes[s] if s in capped else rest * weight[s] / share
        assert rows[0].target == pytest.approx(target) and rows[0].source_size == sizes[s]
        assert sum(r.size * r.copies for r in rows) == pytest.approx(target, abs=400)
        assert all(0 <= r.copies <= 3 for r in rows)
    again = mixing.mix(docs_of(spark, texts, sources)).collect()
    assert sorted((r.id, r.copies) for r in got) == sorted((r.id, r.copies) for r in again)
    taken = mixing.take_mix(docs_of(spark, texts, sources))
    assert taken.columns == DOCS.replace(",", "").split()[::2] and taken.count() == sum(r.copies for r in got)
    assert mixing.mix(docs_of(spark, texts, sources).limit(0)).count() == 0


def test_role_repair_is_cheapest(spark):
    legal = lambda seq: list(seq) == ([0] if seq[:1] == (0,) else []) + [1, 2] * ((len(seq) - (seq[:1] == (0,))) // 2) and seq[-1:] == (2,)

    def cheapest(roles):
        best = None
        for labels in itertools.product(range(3), repeat=len(roles)):
            cost = sum(0 if a == b else 1 if b == 9 else 2 for a, b in zip(labels, roles))
            for merges in itertools.product((False, True), repeat=len(roles)):
                if merges[0] or any(m and labels[i] != labels[i - 1] for i, m in enumerate(merges)):
                    continue
                seq = [x for x, m in zip(labels, merges) if not m]
                put, state = 0, 3
                for role in [*seq, "end"]:
                    path = chat_format.closing(state) if role == "end" else chat_format._PATHS.get((state, role))
                    if path is None:
                        break
                    put, state = put + len(path), role
                else:
                    total = cost + sum(merges) + 3 * put
                    best = total if best is None else min(best, total)
        return best

    rng = random.Random(2)
    chats = [[rng.choice([0, 1, 2, 9]) for _ in range(rng.randrange(1, 5))] for _ in range(25)]
    rows = [(c, t, None if r == 9 else ["System", "human", "gpt"][r], f"t{t} <|im_end|>") for c, chat in enumerate(chats) for t, r in enumerate(chat)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for segment in (100, 2):
        got = {r.conv: r for r in chat_format.render(chat_format.repair(turns, segment=segment)).collect()}
        for c, chat in enumerate(chats):
            assert got[c].cost == cheapest(chat), (chat, segment)
            roles = tuple(chat_format.ROLES.index(x.split("\n")[0]) for x in got[c].rendered.split("<|im_start|>")[1:])
            assert legal(roles) and len(roles) == got[c].n_turns
            assert [got[c].rendered.count(f"t{t} <|\\im_end|>") for t in range(len(chat))] == [1] * len(chat)
            assert got[c].n_escaped == len(chat)
    assert chat_format.repair(turns.limit(0)).count() == 0


def test_chat_texts_are_kept(spark):
    texts = ["f <| x", "a <|im_start|> b", "<|\\im_end|><|im_end|>", "< |im_end|>", "<|\\\\im_start|>", "<|im_end", "|>", "", "<|other|>"]
    for text in texts:
        assert chat_format.unescape(chat_format.escape(text)) == text
        assert not any(token in chat_format.escape(text) for token in ("<|im_start|>", "<|im_end|>"))
    assert len({chat_format.escape(t) for t in texts}) == len(texts)
    rows = [(i, t, ("user", "assistant")[t], text) for i, text in enumerate([*texts, None]) for t in range(2)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for r in chat_format.render(chat_format.repair(turns)).collect():
        text = (*texts, None)[r.conv] or ""
        kept = [part.split("\n", 1)[1].removesuffix("<|im_end|>\n") for part in r.rendered.split("<|im_start|>")[1:]]
        assert [chat_format.unescape(part) for part in kept] == [text, text]
        assert (r.n_escaped > 0) == (chat_format.escape(text) != text)


def test_licence_scan_finds_notices_only(spark):
    texts = ["Some words.\nReleased under the MIT License.\nmore", "Licensed under CC BY-NC 4.0.", "This work is licensed under the GNU General Public License, version 3.",
             "Her driving license was renewed in spring.", "Licensed under the Apache License, Version 2.0.\nAll rights reserved.", *ODD]
    got = {(r.id, r.place): r.family for r in license_scan.scan(docs_of(spark, texts)).collect()}
    assert got == {(0, 1): "MIT", (1, 0): "CC-BY-NC", (2, 0): "GPL-3.0", (3, 0): "unknown", (4, 0): "Apache-2.0", (4, 1): "Proprietary"}
    assert license_scan.scan(docs_of(spark, texts).limit(0)).count() == 0


NOTICES = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:""",
    "GPL-3.0": """# This program is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.""",
    "BSD": """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:""",
    "LGPL": """// This library is free software; you can redistribute it
// under the terms of the GNU Lesser General Public
// License, version 2.1.""",
    "MPL-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at http://mozilla.org/MPL/2.0/.""",
}


def test_licence_scan_finds_wrapped_notices(spark):
    prose = "All rights of the citizens were discussed in public.\nThe general read the terms of the public letter."
    texts = [f"Some words before.\n#\n{notice}\n\nSome words after." for notice in NOTICES.values()]
    texts += ["x " * 300 + "\n" + NOTICES["MIT"] + "\n" + "x " * 300, prose]
    got = license_scan.scan(docs_of(spark, texts)).collect()
    for i, family in enumerate([*NOTICES, "MIT"]):
        assert [r.family for r in got if r.id == i] == [family], (family, [(r.place, r.family, r.similarity) for r in got if r.id == i])
    assert all(r.family == "unknown" for r in got if r.id == len(texts) - 1)


TEXTS = ["  Hello  world\n\nx \té", "日本語 und Straße 🙂", "a" * 5000, "▁ mark ▁▁ here", " ", "many words of a plain text, again and again"]


def test_pieces_are_the_models_own_without_dropout():
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=sentencepiece_codec.MODEL)
    plain = sentencepiece_codec.Codec(dropout=0.0)
    for text in TEXTS:
        if "▁" not in text:
            assert plain.encode(text) == own.encode(text), text
        assert plain.decode(plain.encode(text)) == text


def test_dropout_varies_pieces_and_loses_nothing(spark):
    docs = docs_of(spark, [*TEXTS, TEXTS[-1], None, ""])
    got = {r.id: r for r in sentencepiece_codec.encode(docs, dropout=0.3).collect()}
    assert [got[i].lossless for i in range(9)] == [True] * 7 + [None, True]
    assert got[7].ids is None and got[8].ids == []
    assert got[5].ids != got[6].ids  # the same text under another id
    again = {r.id: r.ids for r in sentencepiece_codec.encode(docs, dropout=0.3).collect()}
    assert all(again[i] == got[i].ids for i in range(9))
    back = sentencepiece_codec.decode(sentencepiece_codec.encode(docs, dropout=0.3)).collect()
    assert {r.id: r.text for r in back} == {r.doc_id: r.text for r in docs.collect()}


@pytest.mark.parametrize("dropout", [0.0, 0.1, 0.5])
def test_chunks_segmented_together_and_alone_agree(dropout):
    own = sentencepiece_codec.Codec(dropout=dropout)
    words = ["▁wonderfulness", "▁", "▁▁▁", "x", "▁日本語", "\n\tq\x00", "▁ñandú😀", "e" * 32, '▁"1beb58b8af68854f0e01b4ad']
    for key in range(20):  # many chunks at a time, and one by one from an agenda, by the same draws
        streams = own._streams(key, len(words))
        ids, ends = own._varied(words, streams)
        for n, word in enumerate(words):
            pattern = own._long_pattern(word, streams[n : n + 1]) if dropout else 0
            assert ids[ends[n - 1] if n else 0 : ends[n]].tolist() == own._spelled_all(own.segment(word, pattern)), (key, word)
    texts = [*TEXTS, None, "", "y" * 500 + " ▁▁ end"]
    got = list(own.encode_all(texts, list(range(len(texts)))))
    assert got == [None if t is None else sentencepiece_codec.Codec(dropout=dropout).encode(t, i) for i, t in enumerate(texts)]


def test_every_occurrence_draws_its_own_merges():
    own = sentencepiece_codec.Codec(dropout=0.1)
    seen = [tuple(own.encode("information", key)) for key in range(3000)]
    plain = tuple(sentencepiece_codec.Codec(dropout=0.0).encode("information"))
    rng = random.Random(3)
    drawn = [tuple(own._spelled_all(own.segment("▁information", sum((rng.random() < 0.1) << i for i in range(40))))) for _ in range(3000)]
    assert len(set(seen)) == pytest.approx(len(set(drawn)), rel=0.25) and len(set(seen)) > 30
    assert seen.count(plain) / 3000 == pytest.approx(drawn.count(plain) / 3000, abs=0.04)
    text = "information " * 400
    assert len(set(tuple(x) for x in own.encode_all([text] * 5, list(range(5))))) == 5
    long = "information" * 4  # longer than LONGEST
    assert len({tuple(own.encode(long, key)) for key in range(200)}) > 100


def test_vector_links_against_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "CROWD", 300)
    rng = np.random.default_rng(3)
    base = rng.standard_normal((600, 16))
    crowd = base[0] + 0.02 * rng.standard_normal((300, 16))
    near = base[1:101] + 0.1 * rng.standard_normal((100, 16))
    m = np.concatenate([base, crowd, near, base[5:9], 4.0 * base[5:9]])
    label = [int(x) for x in rng.integers(0, 2, 600)]
    label = label + [label[0]] * 300 + label[1:101] + label[5:9] * 2
    rows = [(i, [float(x) for x in v], l) for i, (v, l) in enumerate(zip(m, label))]
    n = len(rows)
    odd = [(n, None, 1), (n + 1, [], 1), (n + 2, [0.0] * 16, 1), (n + 3, [None] * 16, 1), (n + 4, [float("nan")] * 16, 1), (n + 5, rows[0][1], None), (n + 6, [1.0, 2.0], 1)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    got = {r.id: r for r in embedding_dedup.near_duplicates(df, leaf=64).collect()}
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    linked = (unit @ unit.T >= 0.98) & (np.array(label)[:, None] == np.array(label)[None]) & ~np.eye(n, dtype=bool)
    true, found = linked.sum(1), np.array([got[i].n_links for i in range(n)])
    assert (found <= true).all() and found.sum() >= 0.95 * true.sum()
    assert all(got[i].n_links == 0 and got[i].kept and got[i].component_id == i for i in range(n, n + 7))
    assert len({got[i].component_id for i in [0, *range(600, 900)]}) == 1
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_large_groups_of_near_copies_are_linked_whole(spark):
    rng = np.random.default_rng(4)
    parts, label = [], []
    for name, (size, cosine) in enumerate([(1000, 0.98), (3000, 0.985), (5000, 0.986)]):
        centre = rng.standard_normal(64)
        centre /= np.linalg.norm(centre)
        noise = rng.standard_normal((size, 64))
        noise -= (noise @ centre)[:, None] * centre
        noise /= np.linalg.norm(noise, axis=1, keepdims=True)
        parts.append(math.sqrt(cosine) * centre + math.sqrt(1 - cosine) * noise)
        label += [name] * size
    m = np.concatenate(parts)
    rows = [(i, v, x) for i, (v, x) in enumerate(zip(m.tolist(), label))]
    got = embedding_dedup.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    found = np.zeros(len(m), np.int64)
    for r in got:
        found[r.id] = r.n_links
    at = 0
    for part in parts:
        unit = part / np.linalg.norm(part, axis=1, keepdims=True)
        assert found[at : at + len(part)].tolist() == ((unit @ unit.T >= 0.98).sum(1) - 1).tolist()
        at += len(part)
    assert len({r.component_id for r in got}) == 3


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = quality_fm.classify(docs, labels).join(labels, F.col("id") == F.col("doc_id")).where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in got]) > 0.9
    odd = quality_fm.classify(docs_of(spark, ODD), labels.limit(0)).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    model = quality_fm.Model(0.3, rng.normal(size=quality_fm.FEATURES), rng.normal(size=(quality_fm.FEATURES, quality_fm.FACTORS)))
    slots, values = np.array([3, 70, 900, 40]), rng.normal(size=4)
    pairs = sum(model.factors[a] @ model.factors[b] * x * y for (a, x), (b, y) in itertools.combinations(list(zip(slots, values)), 2))
    got = model.margins(slots, values, np.zeros(1, np.int64))[0][0]
    assert got == pytest.approx(0.3 + (model.linear[slots] * values).sum() + pairs)


def test_pipeline_stages(spark):
    folder = FOLDER
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, folder)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.dtypes == docs.dtypes
            docs = out.persist()
    assert out.where("NOT lossless").count() == 0 and out.count() == docs.count() > 0
    assert corpus_pipeline.run(spark, folder).count() == out.count()


def test_pipeline_encodes_each_copy_anew(spark):
    text = "many words of a plain text, again and again " * 20
    docs = docs_of(spark, [text, "other words", None, ""])
    docs = docs.union(docs.where("doc_id = 0")).union(docs.where("doc_id = 0")).union(docs.selectExpr("CAST(NULL AS LONG) AS doc_id", *[f"`{c}`" for c in docs.columns[1:]]).where("text = 'other words'"))
    got = corpus_pipeline.encode(spark, docs, FOLDER).collect()
    assert len(got) == 7 and all(r.lossless in (True, None) for r in got)
    assert len({tuple(r.ids) for r in got if r.doc_id == 0}) == 3
    again = corpus_pipeline.encode(spark, docs.repartition(3), FOLDER).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
