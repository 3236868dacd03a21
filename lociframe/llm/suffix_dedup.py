"""Repeated passages by sparse suffix arrays.

A passage of LEAST words always holds a run of ANCHOR words whose hash is smallest among its
neighbours, at the same place in every copy. Only the suffixes at such places are kept. They are
sorted, and neighbours that start alike survive. Around the survivors every window of LEAST words,
as far left and right as the anchor is part of it, is sorted and compared once more, which extends
each match to its full length: windows that occur twice, put together, are the repeated passages.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lociframe.llm.common import WordHashes, batches, binary, maybe_member, rolled
from lociframe.session import stage

LEAST = 50  # words of a passage, at least
ANCHOR = 32  # words at the start of a suffix that neighbours must share

_ROWS = pa.schema([("token", pa.int64()), ("id", pa.int64()), ("at", pa.int32())])
_SHAPE = "token long, id long, at int"


def _anchors(least: int, anchor: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in stream:
            tokens, ids, places = [np.empty(0, np.uint64)], [np.empty(0, np.int64)], [np.empty(0, np.int32)]
            for doc, text in zip(batch.column(0).to_pylist(), binary(batch, "text")):
                words = (text or b"").split()
                if doc is None or len(words) < least:
                    continue
                runs = rolled(hashes.of(words), anchor)
                near = np.lib.stride_tricks.sliding_window_view(runs, least - anchor + 1)
                at = np.unique(near.argmin(1) + np.arange(len(near)))
                tokens.append(runs[at])
                ids.append(np.full(len(at), doc, np.int64))
                places.append(at.astype(np.int32))
            yield batches({"token": np.concatenate(tokens).view(np.int64), "id": np.concatenate(ids), "at": np.concatenate(places)}, _ROWS)

    return run


def _windows(least: int, anchor: int):
    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in stream:
            for doc, text, at in zip(batch.column(0).to_pylist(), binary(batch, "text"), batch.column(2).to_pylist()):
                words = (text or b"").split()
                count = len(words) - least + 1
                if count < 1:
                    continue
                runs = rolled(hashes.of(words), least)
                place = np.array(at, np.int64)
                edges = np.zeros(count + 1, np.int64)  # +1 where the windows of an anchor begin, -1 where they end
                np.add.at(edges, np.clip(place + anchor - least, 0, count), 1)
                np.add.at(edges, np.clip(place + 1, 0, count), -1)
                start = np.flatnonzero(np.cumsum(edges[:-1]) > 0)
                yield batches({"token": runs[start].view(np.int64), "id": np.full(len(start), doc, np.int64), "at": start.astype(np.int32)}, _ROWS)

    return run


def _neighbours(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of sorted rows, those equal to the one before or after, and the first and last of the partition."""
    schema = pa.schema([*_ROWS, ("twice", pa.bool_()), ("edge", pa.bool_())])

    before, waiting, first = None, None, True  # the row before the one that waits for its neighbour

    def judged(columns, after, last):
        """All ``columns`` given the token before and after them."""
        token = columns[0]
        left = np.concatenate([[before is not None and before == token[0]], token[1:] == token[:-1]])
        right = np.concatenate([token[1:] == token[:-1], [after is not None and after == token[-1]]])
        twice, edge = left | right, np.zeros(len(token), bool)
        edge[0] |= first
        edge[-1] |= last
        keep = twice | edge
        return batches({"token": token[keep], "id": columns[1][keep], "at": columns[2][keep], "twice": twice[keep], "edge": edge[keep]}, schema)

    for batch in stream:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if waiting is not None:
            yield judged(waiting, columns[0][0], False)
            before, first = waiting[0][-1], False
        waiting = columns
    if waiting is not None:
        yield judged(waiting, None, True)


def sorted_repeats(rows: DataFrame) -> DataFrame:
    """Rows (token, id, at, twice, edge) that equal a neighbour in the order of (token, id, at), and edges of ranges; staged.

    Ranges are cut by all three columns, so a token of any frequency is spread over as many tasks as it needs.
    """
    ranged = rows.repartitionByRange("token", "id", "at").sortWithinPartitions("token", "id", "at")
    return stage(ranged.mapInArrow(_neighbours, _SHAPE + ", twice boolean, edge boolean"), "sorted-repeats")


def repeated_spans(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", least: int = LEAST, anchor: int = ANCHOR) -> DataFrame:
    """(id, start_word, n_words) of every passage whose windows of ``least`` words all occur elsewhere too.

    Words are runs of other characters than ASCII white space, compared as they are. Elsewhere is
    another document or another place of the same one. Overlapping and touching passages of a document are
    one. Texts of fewer words, null texts, and rows without id give nothing; a row that repeats an
    id and a text repeats all its passages. An empty table gives no rows.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    suffixes = stage(texts.mapInArrow(_anchors(least, anchor), _SHAPE), "suffixes")
    survivors = sorted_repeats(suffixes)
    places = stage(survivors.groupBy("id").agg(F.collect_set("at").alias("at")), "suffix-places")
    wanted = maybe_member(texts, F.col("id"), places, F.col("id")).where("_maybe").drop("_maybe")
    around = wanted.join(places, "id").select("id", "text", "at")
    windows = stage(around.mapInArrow(_windows(least, anchor), _SHAPE), "suffix-windows")
    found = sorted_repeats(windows)
    edges = found.where("edge")
    across = edges.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("token")
    repeats = found.where("twice").select("id", "at").union(edges.where("NOT twice").join(across, "token", "left_semi").select("id", "at")).distinct()
    doc = Window.partitionBy("id").orderBy("at")
    opens = F.coalesce((F.col("at") - F.lag("at").over(doc) > least).cast("int"), F.lit(1))
    runs = repeats.withColumn("opens", opens).withColumn("run", F.sum("opens").over(doc))
    spans = runs.groupBy("id", "run").agg(F.min("at").cast("long").alias("start_word"), (F.max("at") - F.min("at") + least).cast("long").alias("n_words"))
    return spans.drop("run")
