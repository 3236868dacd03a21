"""Quality classifier: a factorisation machine over hashed words, structure and metadata."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import batches, binary, give_back
from lociframe.session import stage

WORDS = 1 << 15  # hashed word features
BINS = 12  # per structure statistic
FACTORS = 8
TRAIN_ROWS = 24_000  # labelled rows the model is fitted on, at most about; chosen by a hash of the id
SHARDS = 8  # parts of them that are fitted side by side and averaged after each round
ROUNDS, EPOCHS, STEPS, BATCH = 4, 2, 64, 128
RATE, DECAY = 0.1, 1e-4
THRESHOLD = 0.3
FOLDS = 5

_LETTERS = bytes(range(65, 91)) + bytes(range(97, 123)) + bytes(range(128, 256))
_UPPER, _DIGITS, _SPACES = bytes(range(65, 91)), b"0123456789", b" \t\n\r\x0b\x0c"
STATISTICS = 14
FEATURES = WORDS + STATISTICS * (BINS + 1)


class _WordSlots(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) > 1_000_000:
            self.clear()
        slot = self[word] = zlib.crc32(word) % WORDS
        return slot


def _share(part: float, whole: float) -> float:
    return part / whole if whole else 0.0


def _statistics(raw: bytes, words: list[bytes], slots: np.ndarray, n_chars) -> list[float]:
    """Statistics of form from 0 to 1; the last one is metadata, the stated number of characters."""
    size, n = len(raw), len(words)
    letters = size - len(raw.translate(None, _LETTERS))
    upper = size - len(raw.translate(None, _UPPER))
    digits = size - len(raw.translate(None, _DIGITS))
    spaces = size - len(raw.translate(None, _SPACES))
    lines = [x for x in raw.split(b"\n") if x.strip()]
    kinds, times = np.unique(slots, return_counts=True)
    same = int((slots[1:] == slots[:-1]).sum()) if n > 1 else 0
    marked = sum(not w[-1:].isalnum() and w[-1] < 128 for w in words)
    return [
        min(1.0, np.log1p(n) / 12),
        min(1.0, _share(size - spaces, n) / 20),
        _share(size - letters - digits - spaces, size - spaces),
        _share(upper, letters),
        _share(digits, size - spaces),
        _share(len(kinds), n),
        _share(int(times.max()) if n else 0, n),
        _share(same, max(1, n - 1)),
        _share(marked, n),
        _share(len(set(lines)), len(lines)),
        min(1.0, _share(n, len(lines)) / 100),
        min(1.0, _share(raw.count(b"http") + raw.count(b"@") + raw.count(b"|"), n) * 4),
        min(1.0, _share(raw.count(b"!") + raw.count(b"#") + raw.count(b"%") + raw.count(b"&") + raw.count(b"*") + raw.count(b"$"), n)),
        min(1.0, np.log1p(max(0, n_chars or 0)) / 16),
    ]


def _features(stream: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray], list[np.ndarray]]]:
    """Batches (id, text, n_chars, ...) with the slots and values of every row."""
    known = _WordSlots()
    edges = np.linspace(0, 1, BINS + 1)[1:-1] ** 2  # finer near 0, where most shares lie
    base = WORDS + np.arange(STATISTICS) * (BINS + 1)
    for batch in stream:
        all_slots, all_values = [], []
        for raw, n_chars in zip(binary(batch, "text"), batch.column(2).to_pylist()):
            raw = raw or b""
            words = raw.lower().split()
            slots = np.fromiter(map(known.__getitem__, words), np.int64, len(words))
            kinds = np.unique(slots)
            stats = np.array(_statistics(raw, words, slots, n_chars))
            all_slots.append(np.concatenate([kinds, base, base + 1 + np.searchsorted(edges, stats, side="right")]))
            all_values.append(np.concatenate([np.full(len(kinds), 1 / np.sqrt(max(1, len(kinds)))), stats, np.full(STATISTICS, 0.5)]))
        yield batch, all_slots, all_values
    known.clear()
    give_back()


@dataclass
class Model:
    """bias, linear weights and low-rank factors of all features."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def pack(self) -> bytes:
        return np.concatenate([[self.bias], self.linear, self.factors.ravel()]).astype(np.float32).tobytes()

    @staticmethod
    def unpack(data: bytes) -> Model:
        x = np.frombuffer(data, np.float32).astype(float)
        return Model(x[0], x[1 : FEATURES + 1].copy(), x[FEATURES + 1 :].reshape(FEATURES, FACTORS).copy())

    @staticmethod
    def fresh() -> Model:
        return Model(0.0, np.zeros(FEATURES), np.random.default_rng(10).normal(0, 0.02, (FEATURES, FACTORS)))

    def margins(self, slots: np.ndarray, values: np.ndarray, starts: np.ndarray):
        """Margin of each row, and its factor sums. The pairs' sum is half of (square of sum - sum of squares)."""
        weighted = self.factors[slots] * values[:, None]
        sums = np.add.reduceat(weighted, starts)
        squares = np.add.reduceat((weighted * weighted).sum(1), starts)
        return self.bias + np.add.reduceat(self.linear[slots] * values, starts) + 0.5 * ((sums * sums).sum(1) - squares), sums


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(margin, -30, 30)))


def _starts(rows: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum([len(r) for r in rows])[:-1]]).astype(np.int64)


def _fit(model: Model, slots: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, seed: int) -> Model:
    """Stochastic gradients with per-weight step sizes: EPOCHS, or as many as make STEPS steps."""
    rng = np.random.default_rng(seed)
    size = max(4, min(BATCH, len(labels) // 16))
    epochs = max(EPOCHS, -(-STEPS * size // len(labels)))
    seen_w, seen_v = np.full(FEATURES, 1e-3), np.full((FEATURES, FACTORS), 1e-3)
    for _ in range(epochs):
        order = rng.permutation(len(labels))
        for at in range(0, len(order), size):
            rows = order[at : at + size]
            s, x = np.concatenate([slots[i] for i in rows]), np.concatenate([values[i] for i in rows])
            lengths = [len(slots[i]) for i in rows]
            margin, sums = model.margins(s, x, _starts([slots[i] for i in rows]))
            error = (_probability(margin) - labels[rows]) / len(rows)
            e = np.repeat(error, lengths) * x
            kinds, place = np.unique(s, return_inverse=True)
            slope_v = e[:, None] * (np.repeat(sums, lengths, axis=0) - model.factors[s] * x[:, None])
            w = np.bincount(place, e, len(kinds)) + DECAY * model.linear[kinds]
            v = np.stack([np.bincount(place, slope_v[:, f], len(kinds)) for f in range(FACTORS)], 1) + DECAY * model.factors[kinds]
            seen_w[kinds] += w * w
            seen_v[kinds] += v * v
            model.linear[kinds] -= RATE * w / np.sqrt(seen_w[kinds])
            model.factors[kinds] -= RATE / 4 * v / np.sqrt(seen_v[kinds])
            model.bias -= RATE * error.sum()
    return model


def in_fold(id_column: Column) -> Column:
    """Whether a row is held out: the CRC-32 of its id as text is a multiple of FOLDS."""
    return F.crc32(id_column.cast("string").cast("binary")) % FOLDS == 0


def _example_rows(stream):
    schema = pa.schema([("shard", pa.int32()), ("id", pa.int64()), ("label", pa.float64()), ("slots", pa.binary()), ("values", pa.binary())])
    for batch, slots, values in _features(stream):
        yield batches({"shard": batch.column(4).to_pylist(), "id": batch.column(0).to_pylist(), "label": batch.column(3).to_pylist(), "slots": [s.astype(np.int32).tobytes() for s in slots], "values": [v.astype(np.float32).tobytes() for v in values]}, schema)


def _part(sent, round_: int):
    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["id", "label", "slots"])
        slots = [np.frombuffer(s, np.int32).astype(np.int64) for s in frame["slots"]]
        values = [np.frombuffer(v, np.float32).astype(float) for v in frame["values"]]
        shard = int(frame["shard"].iloc[0])
        fitted = _fit(Model.unpack(sent.value), slots, values, frame["label"].to_numpy(), 1000 * round_ + shard)
        return pd.DataFrame({"shard": [shard], "n": [len(frame)], "model": [fitted.pack()]})

    return fit


def train(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", chars_column: str = "n_chars", label_column: str = "quality", train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on the labelled rows that are not held out, or on about ``train_rows`` of them if there are more.

    Each round fits SHARDS parts from the common model, each in a task of its own, and averages them.
    Null labels and labels without a document are left out. Without any label the model says 0.5.
    """
    marked = labels.select(F.col(id_column).cast("long").alias("_id"), F.col(label_column).cast("double").alias("label")).where("_id IS NOT NULL AND label IS NOT NULL").where(~in_fold(F.col("_id")))
    total = marked.count()
    if not total:
        return Model(0.0, np.zeros(FEATURES), np.zeros((FEATURES, FACTORS)))
    draw = lambda c: F.pmod(F.xxhash64(c, F.lit(10)), F.lit(1 << 30)) < int(min(1.0, train_rows / total) * (1 << 30))
    texts = docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"), F.col(chars_column).alias("n_chars")).where(draw(F.col("id")) & ~in_fold(F.col("id")))
    shard = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(SHARDS)).cast("int")
    chosen = texts.join(marked.where(draw(F.col("_id"))), F.col("id") == F.col("_id")).select("id", "text", "n_chars", "label", shard.alias("shard"))
    rows = stage(chosen.mapInArrow(_example_rows, "shard int, id long, label double, slots binary, values binary"), "quality-rows")
    model = Model.fresh()
    share = rows.agg(F.avg("label")).first()[0]
    if share is None:
        return Model(0.0, np.zeros(FEATURES), np.zeros((FEATURES, FACTORS)))
    share = min(max(share, 1e-3), 1 - 1e-3)
    model.bias = float(np.log(share / (1 - share)))
    for round_ in range(ROUNDS):
        sent = docs.sparkSession.sparkContext.broadcast(model.pack())
        parts = rows.groupBy("shard").applyInPandas(_part(sent, round_), "shard int, n long, model binary").toPandas().sort_values("shard")  # SHARDS rows
        weights = parts["n"].to_numpy() / parts["n"].sum()
        model = Model.unpack(sum(w * np.frombuffer(m, np.float32).astype(float) for w, m in zip(weights, parts["model"])).astype(np.float32).tobytes())
        sent.unpersist()
    return model


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text", chars_column: str = "n_chars") -> DataFrame:
    """(id, score) per row; the text is read whole, null text counts as empty, an empty one has a score as well."""
    sent = docs.sparkSession.sparkContext.broadcast(model.pack())
    schema = pa.schema([("id", pa.int64()), ("score", pa.float64())])

    def run(stream):
        fitted = Model.unpack(sent.value)
        for batch, slots, values in _features(stream):
            scores = [float(_probability(fitted.margins(s, v, np.zeros(1, np.int64))[0])[0]) for s, v in zip(slots, values)]
            yield batches({"id": batch.column(0).to_pylist(), "score": scores}, schema)

    columns = [F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"), F.col(chars_column).cast("long").alias("n_chars")]
    return docs.select(*columns).mapInArrow(run, "id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **columns) -> DataFrame:
    """(id, held_out, score, predicted) per row of ``docs``; a null id is not held out."""
    names = {k: v for k, v in columns.items() if k != "label_column"}
    scored = score(docs, train(docs, labels, **columns), **names)
    return scored.select("id", F.coalesce(in_fold(F.col("id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
