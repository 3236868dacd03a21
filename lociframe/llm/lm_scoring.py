"""Language-model scores by stupid backoff: n-gram counts by hash part, joined to each block's n-grams.

Documents are taken in blocks. Each block sends every distinct n-gram once, with its count in the block,
to the part of the count table its hash belongs to; the parts add up and answer each block with the
counts of its n-grams; blocks sum the scores of their documents. A frequent n-gram is one entry per
block, so no part is hot, and sorted hashes of 64 bits travel packed, as the steps between them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import WordHashes, batches, binary, mixed, rows_per_batch, stage_in_buckets

ORDER, LEAST, ALPHA = 3, 2, 0.4  # longest n-gram; least count of n-grams of two words and more; factor per backoff
BLOCK = 1_800_000  # words of a block, about
PART = 8 << 20  # bytes of text per part of the count table, about


def _planes(x: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of unsigned numbers, byte by byte, compressed."""
    return zstandard.compress(np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T).tobytes(), 1)


def _unplanes(data: bytes, n: int, width: int) -> np.ndarray:
    out = np.zeros((n, 8), np.uint8)
    out[:, :width] = np.frombuffer(zstandard.decompress(data, n * width), np.uint8).reshape(width, n).T if n else 0
    return out.reshape(-1).view("<u8").astype(np.uint64)


def _pack(keys: np.ndarray) -> bytes:
    """Sorted keys as the steps between them."""
    steps = np.diff(keys, prepend=keys[:1])
    width = (int(steps.max()).bit_length() + 7) // 8 or 1
    return bytes([width]) + int(keys[0]).to_bytes(8, "little") + len(keys).to_bytes(8, "little") + _planes(steps, width)


def _unpack(data: bytes) -> np.ndarray:
    first, n = int.from_bytes(data[1:9], "little"), int.from_bytes(data[9:17], "little")
    return np.cumsum(_unplanes(data[17:], n, data[0]), dtype=np.uint64) + np.uint64(first)


def _ngrams(words: np.ndarray, places: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(n, position of the last word, distinct keys in order, key index of each position) of a block's n-grams.

    ``words``: hash of each word; ``places``: its place in its document.
    """
    run = np.zeros(len(words), np.uint64)
    for n in range(1, order + 1):
        run = mixed((np.concatenate([np.zeros(1, np.uint64), run[:-1]]) if n > 1 else run) * np.uint64(0x9E3779B97F4A7C15) + words + np.uint64(n))
        at = np.flatnonzero(places >= n - 1)
        keys, index = np.unique(run[at], return_inverse=True)
        yield n, at, keys, index


_BLOCK = pa.schema([("block", pa.string()), ("data", pa.binary()), ("ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int32())), ("words", pa.int64())])


def _blocks(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents by about BLOCK words: their distinct words' hashes, frequent ones first, and the words as numbers of these."""
    hashes, ids, texts, held, number = WordHashes(), [], [], 0, 0

    def block() -> pa.RecordBatch:
        words = np.concatenate(texts)
        kinds, spelled, counts = np.unique(words, return_inverse=True, return_counts=True)
        order = np.argsort(-counts, kind="stable")
        rank = np.empty(len(kinds), np.int64)
        rank[order] = np.arange(len(kinds))
        spelling = _planes(np.diff(kinds[order], prepend=np.uint64(0)), 8)  # words of one count are in the order of their hashes
        data = len(kinds).to_bytes(8, "little") + len(spelling).to_bytes(8, "little") + spelling + _planes(rank[spelled], 4)
        return batches({"block": [f"{TaskContext.get().partitionId()}-{number}"], "data": [data], "ids": [ids], "lengths": [[len(t) for t in texts]], "words": [len(words)]}, _BLOCK)

    for batch in stream:
        for doc, text in zip(batch.column(0).to_pylist(), binary(batch, "text")):
            words = hashes.of((text or b"").lower().split())
            ids.append(doc)
            texts.append(words)
            held += len(words)
            if held >= BLOCK:
                yield block()
                ids, texts, held, number = [], [], 0, number + 1
    if ids:
        yield block()


def _words(data: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of a block, and its place in its document."""
    kinds, end, n = int.from_bytes(data[:8], "little"), 16 + int.from_bytes(data[8:16], "little"), int(lengths.sum())
    hashes = np.cumsum(_unplanes(data[16:end], kinds, 8), dtype=np.uint64)
    words = hashes[_unplanes(data[end:], n, 4).astype(np.int64)]
    return words, np.arange(n) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def _sent(parts: int, order: int):
    """Distinct n-grams of each block by the part of the count table they belong to, with their counts."""
    schema = pa.schema([("block", pa.string()), ("n", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("counts", pa.binary())])
    shift = np.uint64(64 - (parts.bit_length() - 1))

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for name, data, lengths in zip(batch.column(0).to_pylist(), binary(batch, "data"), batch.column(2)):
                for n, _, keys, index in _ngrams(*_words(data, lengths.values.to_numpy().astype(np.int64)), order):
                    if not len(keys):
                        continue
                    counts = np.bincount(index, minlength=len(keys)).astype(np.uint64)
                    part, start = np.unique((keys >> shift).astype(np.int64), return_index=True)
                    for p, i, j in zip(part, start, [*start[1:], len(keys)]):
                        yield batches({"block": [name], "n": [n], "part": [p], "keys": [_pack(keys[i:j])], "counts": [_planes(counts[i:j], 4)]}, schema)

    return run


def _added(least: int):
    def add(frame: pd.DataFrame) -> pd.DataFrame:
        keys = [_unpack(k) for k in frame["keys"]]
        counts = [_unplanes(c, len(k), 4) for c, k in zip(frame["counts"], keys)]
        kinds, index = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(index, np.concatenate(counts).astype(float), len(kinds)).astype(np.int64)
        total[total < (1 if frame["n"].iloc[0] == 1 else least)] = 0
        own = np.split(total[index], np.cumsum([len(k) for k in keys])[:-1])
        return pd.DataFrame({"block": frame["block"], "n": frame["n"], "part": frame["part"], "size": [len(x) for x in own], "counts": [_planes(x.astype(np.uint64), 8) for x in own]})

    return add


def _scored(total: int, order: int, alpha: float):
    def score(blocks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        row = blocks.iloc[0]
        lengths = np.array(row["lengths"], np.int64)
        words, places = _words(row["data"], lengths)
        answers = answers.sort_values(["n", "part"])
        logs, shorter = np.zeros(len(words)), None
        for n, at, keys, index in _ngrams(words, places, order):
            if not len(keys):
                break
            found = answers[answers["n"] == n]
            counts = np.concatenate([_unplanes(c, s, 8) for c, s in zip(found["counts"], found["size"])]).astype(float)
            if len(counts) != len(keys):
                raise RuntimeError(f"block {row['block']}: counts of {len(counts)} of {len(keys)} n-grams")
            here = np.zeros(len(words))
            here[at] = counts[index]
            if n == 1:
                logs = np.log(here) - np.log(total)
            else:
                seen = at[here[at] > 0]
                logs[at] += np.log(alpha)
                logs[seen] = np.log(here[seen]) - np.log(shorter[seen - 1])
            shorter = here
        sums = np.zeros(len(lengths))
        some = lengths > 0
        if some.any():
            sums[some] = np.add.reduceat(logs, (np.cumsum(lengths) - lengths)[some])
        ids = pd.array([None if i is None or i != i else int(i) for i in row["ids"]], "Int64")
        return pd.DataFrame({"id": ids, "n_words": lengths, "log_score": sums})

    return score


def stupid_backoff(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", order: int = ORDER, least: int = LEAST, alpha: float = ALPHA) -> DataFrame:
    """(id, n_words, log_score) per row: the sum of the words' log scores under the counts of all rows.

    The score of a word is c(n-gram) / c(n-gram without it) for the longest n-gram that ends in it and occurs
    ``least`` times at least, times ``alpha`` for every longer one that its place allows; of a single word
    c(word) / all words. Words are lower-cased in A-Z. Texts that are null or without words have log
    score 0. Repeated rows and null ids are rows like others; an empty table gives no rows.
    """
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = 1 << max(3, (size // PART).bit_length())
    buckets = min(8192, max(8, int(size) // (6 * BLOCK)))  # about a block each, until there are very many
    with rows_per_batch(docs.sparkSession, 2000):
        made = texts.mapInArrow(_blocks, "block string, data binary, ids array<long>, lengths array<int>, words long")
        blocks = stage_in_buckets(made, "block", buckets, "lm-blocks")
    total = blocks.agg(F.sum("words")).first()[0] or 0
    sent = blocks.select("block", "data", "lengths").mapInArrow(_sent(parts, order), "block string, n int, part int, keys binary, counts binary")
    answers = sent.groupBy("n", "part").applyInPandas(_added(least), "block string, n int, part int, size int, counts binary")
    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInPandas(_scored(total, order, alpha), "id long, n_words long, log_score double")
