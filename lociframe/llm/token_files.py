"""Token ids of documents in flat binary files with 64-bit document offsets, memory-mapped when read.

A folder of token files has, for each part, three files of little-endian numbers without any header:
``.tokens`` (unsigned 16 bits, or 32 for a larger vocabulary), ``.offsets`` (unsigned 64 bits, one more than
documents: where each document starts in its part) and ``.ids`` (signed 64 bits). The table ``manifest`` names the files
of each part and its ``base``, the prefix sum of the tokens of all parts before, so that a document's place
in the whole corpus is base + offset. Parts and the documents in them are in ascending order of id.

Rows without id come first (``n_null`` of the manifest counts them, their number in ``.ids`` is 0), rows with equal ids
are ordered by a hash of their text, and equal rows are each written. A null text is an empty one; an
empty text has only the end id. Other columns do not matter, whatever their names. Ids that are no integers
are an error. An empty table gives an empty manifest.
"""

from __future__ import annotations

import os
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import xxhash
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lociframe.llm.common import binary, rows_per_batch

ROWS_PER_PART = 16_384
REMEMBERED = 400_000  # chunks whose ids a worker keeps, and as many older ones
LONGEST = 64  # bytes of such a chunk; longer ones are encoded each time
TOGETHER = 2 << 20  # bytes of texts looked up together
ENCODED = 1024  # chunks encoded in one call
READ_DOCS = 4096  # documents in a batch read back
_MANIFEST = "part long, n_docs long, n_null long, n_tokens long, width int, file string"


@lru_cache(maxsize=2)
def _tokenizer(path: str) -> Tokenizer:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the cores
    return Tokenizer.from_file(path)


def id_width(tokenizer_path: str, end_id: int | None) -> int:
    """Bytes of a stored id: 2 where every id of the vocabulary fits, else 4."""
    return 2 if max(_tokenizer(tokenizer_path).get_vocab_size() - 1, end_id or 0) < 1 << 16 else 4


class Encoder:
    """Texts to ids. Works for tokenizers that never join text across ASCII white space, and drop it.

    A text is cut at ASCII white space, and a chunk seen before is looked up; so the tokenizer sees a
    frequent chunk once per worker and the ids are those of the whole text.
    """

    def __init__(self, tokenizer_path: str, width: int, end_id: int | None):
        self.tokenizer, self.kind = _tokenizer(tokenizer_path), f"<u{width}"
        self.known: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}  # those of the time before, from which chunks in use come back
        probe = "".join(map(chr, range(32, 127)))
        self.lower = self.tokenizer.normalizer is not None and self.tokenizer.normalizer.normalize_str(probe) == probe.lower()
        self.end = b"" if end_id is None else np.array([end_id], self.kind).tobytes()

    def _encoded(self, chunks: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Chunks with their ids. They are encoded as one text, and an id belongs to the chunk its offset lies in."""
        words = [c.decode() for c in chunks]
        found = self.tokenizer.encode(" ".join(words), add_special_tokens=False)
        ids = np.array(found.ids, self.kind).tobytes()
        starts = np.fromiter((a for a, _ in found.offsets), np.int64, len(found))
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        cuts = np.searchsorted(starts, ends) * int(self.kind[-1])
        return ((c, ids[a:b]) for c, a, b in zip(chunks, np.append(0, cuts).tolist(), cuts.tolist()))

    def __call__(self, texts: list[bytes | None]) -> Iterator[bytes]:
        """The ids of each text, in order; texts of some ``TOGETHER`` bytes share one look at what is unknown."""
        group, held = [], 0
        for text in texts:
            group.append(self._chunks(text or b""))
            held += len(text or b"")
            if held > TOGETHER:
                yield from self._group(group)
                group, held = [], 0
        yield from self._group(group)

    def _chunks(self, text: bytes) -> list[bytes]:
        # Small letters first where the tokenizer makes them anyway, so that fewer chunks differ. Not before a special token's
        # sign, which is looked for as it stands, nor where marks (U+0300 to U+037F) may join the letter before them.
        if self.lower and not (b"<|" in text or b"\xcc" in text or b"\xcd" in text):
            text = text.lower()
        return text.split()

    def _group(self, group: list[list[bytes]]) -> Iterator[bytes]:
        if len(self.known) > REMEMBERED:
            self.before, self.known = self.known, {}
        missing = set().union(*group) - self.known.keys()
        again = missing & self.before.keys()
        self.known.update((c, self.before[c]) for c in again)
        unknown = list(missing - again)
        for at in range(0, len(unknown), ENCODED):
            self.known.update(self._encoded(unknown[at : at + ENCODED]))
        get = self.known.__getitem__
        yield from [b"".join(map(get, chunks)) + self.end for chunks in group]
        for c in unknown:
            if len(c) > LONGEST:
                del self.known[c]


@lru_cache(maxsize=1)
def _encoder(tokenizer_path: str, width: int, end_id: int | None) -> Encoder:
    """A worker's encoder; the next tasks find its chunks."""
    return Encoder(tokenizer_path, width, end_id)


def _place(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


def _bounds(rows: DataFrame, n_parts: int) -> np.ndarray:
    """Ids that cut the rows into about equal parts, from a summary of the id column alone."""
    if n_parts < 2:
        return np.empty(0, np.int64)
    shares = [i / n_parts for i in range(1, n_parts)]
    found = rows.agg(F.percentile_approx("id", F.lit(shares), max(10_000, 20 * n_parts)).alias("b")).first().b
    return np.sort(np.array(found or [], np.int64))


def _parts(ids: np.ndarray, null: np.ndarray, tie: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Part of each row. An id that fills several parts is spread over them by the hash its rows are ordered by."""
    low, high = np.searchsorted(bounds, ids, "left"), np.searchsorted(bounds, ids, "right")
    # the hash as a share of 1, of 32 bits so that the product below stays exact
    share = (tie.view(np.uint64) ^ np.uint64(1 << 63)) >> np.uint64(32)
    part = low + ((share * (high - low + 1).astype(np.uint64)) >> np.uint64(32)).astype(np.int64)
    return np.where(null, 0, part)


def write(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """Encode every text and write token files below ``path``, a folder all executors share; the manifest.

    Texts are encoded where they are read, and only their ids are shuffled, once, to the part that their
    document's id falls into; a part is sorted by Spark and written as a stream. A task that runs twice writes
    two sets of files, of which the manifest names one. Large corpora take larger parts: ``rows_per_part`` is about the
    number of documents in one, and the cuts (8 bytes a part) go to every task.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_column].dataType.simpleString()
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError(f"document ids must be integers, {id_column} is {kind}")
    rows = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text_column}`").cast("string").alias("text"))
    n_parts = max(1, -(-rows.count() // rows_per_part))
    bounds, width = _bounds(rows, n_parts), id_width(tokenizer_path, end_id)
    encoded_schema = pa.schema([("part", pa.int64()), ("id", pa.int64()), ("tie", pa.int64()), ("tokens", pa.binary())])
    manifest_schema = pa.schema(
        [("part", pa.int64()), ("n_docs", pa.int64()), ("n_null", pa.int64()), ("n_tokens", pa.int64()), ("width", pa.int32()), ("file", pa.string())]
    )

    def encode(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer_path, width, end_id)
        for batch in stream:
            texts = binary(batch, "text")
            tie = np.array([xxhash.xxh3_64_intdigest(t or b"") for t in texts], np.uint64).view(np.int64)
            null = np.asarray(batch["id"].is_null())
            ids = batch["id"].fill_null(0).to_numpy()
            tokens = pa.array(encoder(texts), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(_parts(ids, null, tie, bounds)), batch["id"], pa.array(tie), tokens], schema=encoded_schema)

    def store(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _place(path)
        open_part, files, counts = None, None, None

        def close() -> pa.RecordBatch:
            files["offsets"].write(np.array([counts[2]], "<u8").tobytes())
            for file in files.values():
                file.close()
            row = [open_part, *counts, width, name]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, manifest_schema)], schema=manifest_schema)

        for batch in stream:
            parts = batch["part"].to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(parts)) + 1), len(parts)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if parts[a] != open_part:
                    if files:
                        yield close()
                    open_part, counts = int(parts[a]), [0, 0, 0]
                    name = f"{open_part:08d}-{uuid.uuid4().hex}"
                    files = {end: system.open_output_stream(f"{folder}/{name}.{end}") for end in ("tokens", "offsets", "ids")}
                rows = batch.slice(a, b - a)
                tokens = rows["tokens"].to_pylist()
                sizes = np.array([len(t) for t in tokens], np.uint64) // np.uint64(width)
                ends = np.cumsum(sizes, dtype=np.uint64) + np.uint64(counts[2])
                files["offsets"].write((ends - sizes).astype("<u8").tobytes())
                files["ids"].write(rows["id"].fill_null(0).to_numpy().astype("<i8").tobytes())
                for t in tokens:
                    files["tokens"].write(t)
                counts = [counts[0] + b - a, counts[1] + rows["id"].null_count, int(ends[-1])]
        if files:
            yield close()

    system, folder = _place(path)
    system.create_dir(folder, recursive=True)
    encoded = rows.mapInArrow(encode, "part long, id long, tie long, tokens binary")
    ordered = encoded.repartitionById(n_parts, F.col("part").cast("int")).sortWithinPartitions("part", F.asc_nulls_first("id"), "tie")
    with rows_per_batch(spark, 1024):
        ordered.mapInArrow(store, _MANIFEST).write.parquet(f"{path}/written")
    # One row a part, so a window over all of them is small.
    before = F.sum("n_tokens").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    based = spark.read.parquet(f"{path}/written").withColumn("base", F.coalesce(before, F.lit(0)).cast("long"))
    based.write.parquet(f"{path}/manifest")
    return spark.read.parquet(f"{path}/manifest")


class TokenFiles:
    """Token files of a folder on this machine, mapped into memory: any document, or any stretch of the corpus."""

    def __init__(self, path: str):
        _, self.folder = _place(path)
        self.parts = sorted(pq.read_table(f"{self.folder}/manifest").to_pylist(), key=lambda p: p["part"])
        self.bases = np.array([p["base"] for p in self.parts], np.int64)
        self.first = np.cumsum([0] + [p["n_docs"] for p in self.parts])
        self.n_docs, self.n_tokens = int(self.first[-1]), sum(p["n_tokens"] for p in self.parts)

    def _map(self, part: dict, end: str, kind: str) -> np.ndarray:
        place = f"{self.folder}/{part['file']}.{end}"
        return np.memmap(place, kind, "r") if os.path.getsize(place) else np.empty(0, kind)

    def tokens(self, start: int, length: int) -> np.ndarray:
        """Ids from place ``start`` of the corpus on, over the borders of documents and parts."""
        out = []
        for p in range(max(0, int(np.searchsorted(self.bases, start, "right")) - 1), len(self.parts)):
            part = self.parts[p]
            a, b = max(start - part["base"], 0), min(start + length - part["base"], part["n_tokens"])
            if b <= 0:
                break
            out.append(self._map(part, "tokens", f"<u{part['width']}")[a:b])
        return np.concatenate(out) if out else np.empty(0, np.uint32)

    def document(self, n: int) -> np.ndarray:
        """Ids of the ``n``-th document in order of id."""
        p = int(np.searchsorted(self.first, n, "right")) - 1
        part, at = self.parts[p], n - int(self.first[p])
        a, b = self._map(part, "offsets", "<u8")[at : at + 2]
        return self._map(part, "tokens", f"<u{part['width']}")[int(a) : int(b)]


def _stored(part: dict, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, offsets and tokens of a part: mapped into memory where the folder is local, else read whole."""
    system, folder = _place(path)

    def numbers(end: str, kind: str) -> np.ndarray:
        place = f"{folder}/{part['file']}.{end}"
        if isinstance(system, fs.LocalFileSystem):
            return np.memmap(place, kind, "r") if os.path.getsize(place) else np.empty(0, kind)
        with system.open_input_file(place) as file:
            return np.frombuffer(file.read(), kind)

    return numbers("ids", "<i8"), numbers("offsets", "<u8"), numbers("tokens", f"<u{part['width']}")


def read(spark: SparkSession, path: str, tokens: bool = True) -> DataFrame:
    """Documents read back from token files: id, start in the corpus, n_tokens, ids_crc32, and the tokens if wanted.

    ``ids_crc32`` is the unsigned CRC-32 of the ids as little-endian unsigned 32-bit numbers. A task reads one part.
    """
    schema = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])
    if tokens:
        schema = schema.append(pa.field("tokens", pa.list_(pa.int64())))

    def documents(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in stream:
            for part in batch.to_pylist():
                ids, offsets, stored = _stored(part, path)
                for a in range(0, part["n_docs"], READ_DOCS):
                    b = min(a + READ_DOCS, part["n_docs"])
                    at = offsets[a : b + 1].astype(np.int64)
                    pieces = [stored[x:y].astype("<u4") for x, y in zip(at, at[1:])]
                    columns = [
                        pa.array(ids[a:b].astype(np.int64), mask=np.arange(a, b) < part["n_null"]),
                        pa.array(at[:-1] + part["base"]),
                        pa.array(np.diff(at)),
                        pa.array([zlib.crc32(p.tobytes()) for p in pieces], pa.int64()),
                    ]
                    if tokens:
                        columns.append(pa.array([p.astype(np.int64) for p in pieces], schema.field("tokens").type))
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

    manifest = spark.read.parquet(f"{path}/manifest")
    manifest = manifest.repartition(max(1, manifest.count()), "part")
    ddl = "id long, start long, n_tokens long, ids_crc32 long" + (", tokens array<long>" if tokens else "")
    return manifest.mapInArrow(documents, ddl)
