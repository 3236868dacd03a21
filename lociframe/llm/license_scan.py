"""Licence scan: a trained paragraph classifier, an unknown class, and templates that confirm it.

Everything is DataFrame work: n-grams are exploded and joined with a table of weights. The training
set is made of the fixed texts below, so its size and that of the weights are bounded.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lociframe.session import stage

# Notices by licence family, and lines that only sound like one.
TEMPLATES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, to deal in the software without restriction."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "You may not use this file except in compliance with the License. You may obtain a copy at http://www.apache.org/licenses/LICENSE-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("LGPL", "This library is free software; you can redistribute it under the terms of the GNU Lesser General Public License, version 2.1."),
    ("AGPL-3.0", "Licensed under the GNU Affero General Public License, version 3."),
    ("BSD", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("BSD", "Licensed under the 3-Clause BSD License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("CC-BY", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY", "Licensed under CC BY 4.0."),
    ("CC-BY-SA", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-SA", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC-BY-NC", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC0", "To the extent possible under law, the author has waived all copyright and related rights to this work. CC0 1.0 Universal."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted."),
    ("Proprietary", "All rights reserved."),
    ("Proprietary", "Copyright the authors. All rights reserved. Reproduction without permission is prohibited."),
]
UNKNOWN = "unknown"
OTHERS = [
    "The driver must show a valid license before the test.",
    "She renewed her fishing license at the town office.",
    "The court ruled on copyright law last year.",
    "Our warranty covers parts and labour for two years.",
    "He asked permission to leave the room early.",
    "The software is slow and needs more memory.",
    "The version of the story that he told was different.",
    "All rights of the citizens were discussed in public.",
    "The general read the terms of the public letter.",
    "This work was released in spring and sold well.",
    "You may use the file in the second drawer.",
    "A licensed electrician came to the house under the hill.",
    "They may not copy the answers of other people.",
    "Read the source of the river and the library on its banks.",
]
GATE = r"(?i)licen[sc]e|copyright|permission|rights reserved|redistribut|public domain|free software|creative commons|\bcc0\b|\bcc[ -]by\b"
WORD = r"[a-z0-9]+(?:[.+-][a-z0-9]+)*"
FAMILIES = [*dict.fromkeys(f for f, _ in TEMPLATES), UNKNOWN]
ROUNDS, RATE, DECAY = 8, 20.0, 1e-4
SHIFTS = [0.0, 0.5, 1.0, 1.5, 2.0, 2.5, 3.0]  # of the unknown class, tried on held-out examples
ALIKE = 0.6  # share of the template's n-grams that confirms
STEP = 56  # words from one window of a paragraph to the next; a window has twice as many, so no notice of so many words is cut


def _notice_words() -> list[str]:
    """Words such that a text without any of them shares less than ALIKE of every template's n-grams."""
    chosen: list[str] = []
    for _, text in TEMPLATES:
        words = re.findall(WORD, text.lower())
        grams = {(w,) for w in words} | set(zip(words, words[1:]))
        for word in ["", *sorted(set(words), key=lambda w: (-len(w), w))]:
            if sum(not set(g) & set(chosen) for g in grams) < ALIKE * len(grams):
                break
            if word and word not in chosen:
                chosen.append(word)
    return chosen


NOTICE = "(?i)" + "|".join(re.escape(w) for w in _notice_words())


def ngrams(text: Column) -> Column:
    """Distinct words and pairs of neighbouring words."""
    words = F.regexp_extract_all(F.lower(text), F.lit(f"({WORD})"))
    pairs = F.zip_with(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), F.slice(words, 2, F.greatest(F.size(words) - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
    return F.array_distinct(F.concat(words, pairs))


def _examples(spark: SparkSession) -> DataFrame:
    """(ex, truth, held_out, gram, x): every line whole, without each of its words, and its two ends."""
    lines = spark.createDataFrame([(i, f, t) for i, (f, t) in enumerate([*TEMPLATES, *[(UNKNOWN, t) for t in OTHERS]])], "line int, family string, text string").coalesce(1)
    words = lines.withColumn("w", F.split("text", " ")).withColumn("n", F.size("w"))
    dropped = F.transform(F.sequence(F.lit(1), F.col("n")), lambda i: F.filter("w", lambda _, k: k != i - 1))
    ends = F.when(F.col("n") >= 8, F.array(F.slice("w", 1, (F.col("n") * 0.7).cast("int")), F.slice("w", (F.col("n") * 0.3).cast("int") + 1, F.col("n")))).otherwise(F.array(F.col("w")))
    forms = words.select("line", "family", F.posexplode(F.concat(F.array("w"), dropped, ends)).alias("form", "w"))
    ex = forms.select((F.col("line") * 1000 + F.col("form")).alias("ex"), F.col("family").alias("truth"), (F.col("form") % 5 == 4).alias("held_out"), ngrams(F.concat_ws(" ", "w")).alias("grams"))
    return ex.select("ex", "truth", "held_out", F.explode("grams").alias("gram"), (1 / F.sqrt(F.size("grams").cast("double"))).alias("x"))


def _chances(grams: DataFrame, weights: DataFrame, key: str, more: tuple[str, ...] = (), shift: float = 0.0) -> DataFrame:
    """(key, more, family, p): softmax of the summed weights of the key's n-grams."""
    sums = grams.join(weights, "gram").groupBy(key, *more, "family").agg((F.sum(F.col("w") * F.col("x")) + F.when(F.col("family") == UNKNOWN, shift).otherwise(0.0)).alias("s"))
    one = Window.partitionBy(key)
    raised = sums.withColumn("s", F.exp(F.col("s") - F.max("s").over(one)))
    return raised.withColumn("p", F.col("s") / F.sum("s").over(one)).drop("s")


def train(spark: SparkSession) -> tuple[DataFrame, float]:
    """(gram, family, w), and the shift of the unknown class.

    Softmax regression by full gradients over the n-grams of the examples, from smoothed log shares.
    It runs in one partition, without a shuffle, as the examples are a fixed set. The shift is the
    one with the fewest errors on held-out examples.
    """
    examples = stage(_examples(spark), "licence-examples").coalesce(1)
    fitting = examples.where("NOT held_out").select("ex", "truth", "gram", "x")
    families = F.explode(F.array(*[F.lit(f) for f in FAMILIES])).alias("family")
    seen = fitting.groupBy("gram", F.col("truth").alias("family")).agg(F.sum("x").alias("n"))
    all_of = fitting.groupBy("gram").agg(F.sum("x").alias("all"))
    first = F.log((F.coalesce("n", F.lit(0.0)) + 0.1) / (F.col("all") + 0.1 * len(FAMILIES)) * len(FAMILIES))
    weights = all_of.select("gram", "all", families).join(seen, ["gram", "family"], "left").select("gram", "family", first.alias("w"))
    weights = stage(weights, "licence-weights").coalesce(1)
    count = fitting.select(F.countDistinct("ex")).first()[0]
    for _ in range(ROUNDS):
        errors = _chances(fitting, weights, "ex", ("truth",)).select("ex", "family", (F.col("p") - (F.col("family") == F.col("truth")).cast("double")).alias("e"))
        slopes = fitting.join(errors, "ex").groupBy("gram", "family").agg((F.sum(F.col("e") * F.col("x")) / count).alias("g"))
        moved = weights.join(slopes, ["gram", "family"]).select("gram", "family", (F.col("w") - RATE * (F.col("g") + DECAY * F.col("w"))).alias("w"))
        weights = stage(moved, "licence-weights").coalesce(1)
    tried = stage(_chances(examples.where("held_out"), weights, "ex", ("truth",)), "licence-tried").coalesce(1)
    moved = tried.withColumn("shift", F.explode(F.array(*[F.lit(x) for x in SHIFTS])))
    weighed = F.col("p") * F.exp(F.when(F.col("family") == UNKNOWN, F.col("shift")).otherwise(0.0))
    best = moved.groupBy("shift", "ex", "truth").agg(F.max_by("family", weighed).alias("best"))
    wrong = best.groupBy("shift").agg(F.sum((F.col("best") != F.col("truth")).cast("int")).alias("wrong")).orderBy("wrong", "shift").first()
    return weights, float(wrong["shift"])


def gated_lines(texts: DataFrame) -> DataFrame:
    """(row, id, place, last, par, paragraph) of the lines with a word of GATE."""
    lines = texts.select("row", "id", F.posexplode(F.split("text", r"\n")).alias("place", "paragraph")).where(F.col("paragraph").rlike(GATE))
    return lines.select("row", "id", "place", F.col("place").alias("last"), F.lit(None).cast("long").alias("par"), "paragraph")


def windows(texts: DataFrame) -> DataFrame:
    """(row, id, place, last, par, paragraph) of overlapping windows of each paragraph's words.

    A line without letters and digits, such as an empty one or a bare comment mark, ends a paragraph; the marks of other
    lines are in no n-gram. Only windows that can share enough with a template are returned.
    """
    lines = texts.where(F.col("text").rlike(NOTICE)).select("row", "id", F.posexplode(F.split("text", r"\n")).alias("place", "line"))
    border = ~F.col("line").rlike("[A-Za-z0-9]")
    lines = lines.withColumn("par", F.sum(border.cast("long")).over(Window.partitionBy("row").orderBy("place"))).where(~border)
    lines = lines.withColumn("words", F.split(F.trim(F.regexp_replace("line", r"\s+", " ")), " ")).drop("line")
    lines = lines.withColumn("end", F.sum(F.size("words")).over(Window.partitionBy("row", "par").orderBy("place")))
    lines = lines.withColumn("start", F.col("end") - F.size("words"))
    held = F.sequence(F.greatest(F.floor(F.col("start") / STEP) - 1, F.lit(0)), F.floor((F.col("end") - 1) / STEP))
    lines = lines.withColumn("k", F.explode(held))
    first = F.greatest(F.col("k") * STEP - F.col("start"), F.lit(0)).cast("int")
    stop = F.least((F.col("k") + 2) * STEP - F.col("start"), F.size("words")).cast("int")
    pieces = lines.select("row", "id", "par", "k", "place", F.concat_ws(" ", F.slice("words", first + 1, stop - first)).alias("piece"))
    whole = pieces.groupBy("row", "id", "par", "k").agg(F.min("place").alias("place"), F.max("place").alias("last"), F.array_sort(F.collect_list(F.struct("place", "piece"))).alias("pieces"))
    out = whole.select("row", "id", "place", "last", "par", F.concat_ws(" ", F.col("pieces.piece")).alias("paragraph"))
    return out.where(F.col("paragraph").rlike(NOTICE))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, place, family, probability, similarity, paragraph) of every line or paragraph that may be a licence notice.

    Lines with a word of GATE are returned, with the most likely family, if it is not the unknown class and its
    nearest template shares ALIKE of its n-grams with the line; else as unknown. Paragraphs are also
    classified in windows of neighbouring lines, whatever their words: of the families more likely than the unknown class the one whose
    template is shared most, if ALIKE of it is. Such a notice is a row at its window's first line, once per family and paragraph, unless
    a line of it says the same; it takes the place of the unknown lines it spans. Null and empty texts give no row.
    Equal rows give equal rows.
    """
    spark = docs.sparkSession
    weights, shift = train(spark)
    picked = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text")).where(F.col("text").rlike(GATE) | F.col("text").rlike(NOTICE))
    texts = stage(picked.withColumn("row", F.monotonically_increasing_id()), "licence-texts")
    lines = gated_lines(texts).unionByName(windows(texts)).withColumn("grams", ngrams(F.col("paragraph")))
    lines = stage(lines.withColumn("line", F.monotonically_increasing_id()), "licence-lines")
    grams = lines.select("line", F.explode("grams").alias("gram"), (1 / F.sqrt(F.size("grams").cast("double"))).alias("x"))
    chances = _chances(grams, F.broadcast(weights), "line", shift=shift)  # bounded by the n-grams of the fixed texts
    named = chances.groupBy("line").agg(F.max("p").alias("top"), F.max_by("family", "p").alias("likely"), F.map_from_entries(F.collect_list(F.struct("family", "p"))).alias("p"))
    kept = spark.createDataFrame(TEMPLATES, "of string, template string").coalesce(1).select("of", ngrams(F.col("template")).alias("t"))
    kept = kept.agg(F.collect_list(F.struct("of", "t")).alias("templates"))
    whole = F.col("par").isNotNull()
    allowed = F.filter("templates", lambda x: F.when(whole, F.col("p")[x["of"]] > F.col("p")[UNKNOWN]).otherwise(x["of"] == F.col("likely")))
    shares = F.transform(allowed, lambda x: F.struct((F.size(F.array_intersect(x["t"], F.col("grams"))) / F.size(x["t"])).alias("share"), F.size(x["t"]).alias("size"), x["of"].alias("of")))
    compared = lines.join(named, "line", "left").crossJoin(F.broadcast(kept)).withColumn("best", F.array_max(shares))
    compared = compared.withColumn("similarity", F.coalesce("best.share", F.lit(0.0)))
    likely = F.when(whole, F.col("best.of")).otherwise(F.col("likely"))
    sure = (likely != UNKNOWN) & (F.col("similarity") >= ALIKE)
    probability = F.when(whole, F.col("p")[F.col("best.of")]).otherwise(F.coalesce("top", F.lit(1.0)))  # no known n-gram: unknown for sure
    out = compared.select("row", "id", "place", "last", "par", F.when(sure, likely).otherwise(UNKNOWN).alias("family"), probability.alias("probability"), "similarity", "paragraph")
    out = stage(out.where(F.col("par").isNull() | (F.coalesce(sure, F.lit(False)))), "licence-compared")

    single, wide = out.where("par IS NULL"), out.where("par IS NOT NULL")
    one = Window.partitionBy("row", "par", "family").orderBy(F.desc("similarity"), "place")
    wide = wide.withColumn("nth", F.row_number().over(one)).where("nth = 1").drop("nth").alias("w")
    said = single.where(F.col("family") != UNKNOWN).select("row", "family", "place").alias("s")
    alone = (F.col("w.row") == F.col("s.row")) & (F.col("w.family") == F.col("s.family")) & F.col("s.place").between(F.col("w.place"), F.col("w.last"))
    wide = stage(wide.join(said, alone, "left_anti"), "licence-wide")
    spans = wide.select("row", "place", "last").alias("w")
    inside = (F.col("s.row") == F.col("w.row")) & F.col("s.place").between(F.col("w.place"), F.col("w.last")) & (F.col("s.family") == UNKNOWN)
    single = single.alias("s").join(spans, inside, "left_anti")
    return single.unionByName(wide).drop("row", "last", "par")
