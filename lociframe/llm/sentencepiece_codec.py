"""SentencePiece BPE encoding with seeded merge-dropout, and lossless decoding."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import MASK, batches, give_back, mixed

MODEL = "/opt/tokenizers/piece_bpe_32k.model"  # a public vocabulary; any BPE model with byte fallback will do
DROPOUT, SEED = 0.1, 42
REMEMBERED = 300_000  # chunks that a task keeps the undropped segmentations of
LONGEST = 32  # characters of such a chunk
SPACE = "▁"
GROUP = 200_000  # chunks looked up at a time, about
TOGETHER = 4096  # chunks segmented at a time
PLACES = 128  # more than a chunk of LONGEST characters has candidate merges, which is 3 for each two neighbours at most
GONE, OTHER = 0, 1  # symbols: merged into the one before; a letter of no piece
_CHUNK = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


def _found(sorted_keys: np.ndarray, values: np.ndarray, keys: np.ndarray, default: int) -> np.ndarray:
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return np.where(sorted_keys[at] == keys, values[at], default)


class _Lookup:
    """Values of whole numbers, many at a time: a table with few entries to a slot, of which most are found at the first look."""

    def __init__(self, keys: np.ndarray, values: np.ndarray, default: int):
        self.shift = np.uint64(64 - max(4, (8 * len(keys)).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.mask, self.keys, self.values, self.default = size - 1, np.full(size, -1), np.full(size, default), default
        waiting, step = np.arange(len(keys)), 0
        while len(waiting):
            slots = (self._slots(keys[waiting]) + step) & self.mask
            _, first = np.unique(slots, return_index=True)
            first = first[self.keys[slots[first]] < 0]
            self.keys[slots[first]], self.values[slots[first]] = keys[waiting[first]], values[waiting[first]]
            waiting, step = np.delete(waiting, first), step + 1

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        held = self.keys[slots]
        out = np.where(held == keys, self.values[slots], self.default)
        rest = np.flatnonzero((held != keys) & (held >= 0))
        flat, all_keys, all_slots = out.ravel(), keys.ravel(), slots.ravel()
        while len(rest):
            all_slots[rest] = (all_slots[rest] + 1) & self.mask
            held = self.keys[all_slots[rest]]
            hit = held == all_keys[rest]
            flat[rest[hit]] = self.values[all_slots[rest[hit]]]
            rest = rest[~hit & (held >= 0)]
        return out


class _Numbers(dict):
    """Number of each chunk; a new one gets the next, and is added to the list."""

    chunks: list[str]

    def __missing__(self, chunk: str) -> int:
        n = self[chunk] = len(self.chunks)
        self.chunks.append(chunk)
        return n


class Codec:
    """Pieces of a SentencePiece BPE model, its merges, and both directions.

    The text gets a leading space, spaces become the piece mark, and pieces are merged by score, best first,
    leftmost among equals. Every candidate merge is drawn for when it is taken from the agenda, anew for each
    occurrence of a chunk, by a hash of the document's key and the place; one that is dropped never comes back. A draw says how many
    candidates pass before the next one is dropped. Undropped segmentations are kept by chunk, and the occurrences that
    drop something are segmented together, each by its own draws. A mark that the text itself contains is spelled in bytes,
    as is any character without a piece, so decoding gives back every text.
    """

    def __init__(self, model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED):
        import sentencepiece

        proto = sentencepiece.SentencePieceProcessor(model_file=model)
        plain = [i for i in range(proto.get_piece_size()) if not (proto.is_control(i) or proto.is_unknown(i) or proto.is_byte(i) or proto.is_unused(i))]
        self.ids = {proto.id_to_piece(i): i for i in plain}
        self.ranks = {proto.id_to_piece(i): -proto.get_score(i) for i in plain}
        self.byte_ids = {int(proto.id_to_piece(i)[1:-1], 16): i for i in range(proto.get_piece_size()) if proto.is_byte(i)}
        if len(self.byte_ids) != 256:
            raise ValueError("the model has no byte fallback")
        if any(SPACE in piece.lstrip(SPACE) for piece in self.ids):
            raise ValueError("the model has pieces over word borders")
        self.bytes = {i: piece.replace(SPACE, " ").encode() for piece, i in self.ids.items()} | {i: bytes([b]) for b, i in self.byte_ids.items()}
        spellings = [self.bytes.get(i, b"") for i in range(proto.get_piece_size())]
        self.byte_lengths = np.array([len(x) for x in spellings], np.int64)
        self.byte_starts = np.cumsum(self.byte_lengths) - self.byte_lengths
        self.byte_data = np.frombuffer(b"".join(spellings), np.uint8)
        self.limit, self.seed = int(dropout * (1 << 32)), seed
        # a draw, uniform on 64 bits, passes the first n candidates if it is below item n - 1
        self.passing = np.array([min(int((1 - dropout) ** n * 2.0**64), MASK) for n in range(1, PLACES + 1)], np.uint64)
        self._number()
        self._forget()

    def _number(self) -> None:
        """Pieces and letters as numbers, and which pairs of them merge into which, for many chunks at a time."""
        names = list(self.ids)
        names += sorted({letter for piece in names for letter in piece} - self.ids.keys())
        number = {name: i + 2 for i, name in enumerate(names)}
        self.n_symbols = len(names) + 2
        self.piece_ids = np.array([-1, -1] + [self.ids.get(name, -1) for name in names])
        self.symbol_ranks = np.array([np.inf, np.inf] + [self.ranks.get(name, np.inf) for name in names])
        letters = sorted(name for name in names if len(name) == 1)
        self.letters = np.array([ord(x) for x in letters], np.uint32)
        self.letter_symbols = np.array([number[x] for x in letters])
        cuts = ((piece[:i], piece[i:], piece) for piece in self.ids for i in range(1, len(piece)))
        pairs = sorted((number[a] * self.n_symbols + number[b], number[c]) for a, b, c in cuts if a in number and b in number)
        self.pair_symbols = _Lookup(np.array([p for p, _ in pairs], np.int64), np.array([c for _, c in pairs], np.int64), OTHER)

    def _spelled(self, symbol: str) -> list[int]:
        return [self.ids[symbol]] if symbol in self.ids else [self.byte_ids[b] for b in symbol.encode()]

    def segment(self, chunk: str, pattern: int = 0) -> list[str]:
        """Pieces of a chunk of any length after all merges but the pattern's; the agenda is a heap."""
        dropped, taken = bin(pattern)[:1:-1], 0
        symbols: list[str | None] = list(chunk)
        after, before = list(range(1, len(chunk) + 1)), list(range(-1, len(chunk) - 1))
        agenda: list[tuple[float, int, int, int]] = []

        def propose(i: int, j: int) -> None:
            rank = self.ranks.get(symbols[i] + symbols[j])
            if rank is not None:
                heapq.heappush(agenda, (rank, i, j, len(symbols[i]) + len(symbols[j])))

        for i in range(len(chunk) - 1):
            propose(i, i + 1)
        while agenda:
            _, i, j, size = heapq.heappop(agenda)
            if symbols[i] is None or symbols[j] is None or after[i] != j or len(symbols[i]) + len(symbols[j]) != size:
                continue
            taken += 1
            if dropped[taken - 1 : taken] == "1":
                continue
            symbols[i], symbols[j] = symbols[i] + symbols[j], None
            after[i] = after[j]
            if after[i] < len(chunk):
                before[after[i]] = i
                propose(i, after[i])
            if before[i] >= 0:
                propose(before[i], i)
        return [s for s in symbols if s is not None]

    def _spelled_all(self, pieces: list[str]) -> list[int]:
        return [i for piece in pieces for i in self._spelled(piece)]

    def _forget(self) -> None:
        """Only the empty chunk, which stands for a mark of the text's own, is known: its number is 0."""
        mark = [self.byte_ids[b] for b in SPACE.encode()]
        self.numbers = _Numbers({"": 0})
        self.chunks = self.numbers.chunks = [""]
        self.taken = np.zeros(1, np.int64)
        self.starts, self.lengths = np.zeros(1, np.int64), np.full(1, len(mark), np.int64)
        self.pieces = np.array(mark, np.int32)

    def _segmented(self, chunks: list[str], drops: tuple[np.ndarray, np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of chunks of at most LONGEST characters one after the other, how many each has, and its candidates."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        order = np.argsort(sizes, kind="stable")
        lengths, taken, found = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64), []
        for at in range(0, len(chunks), TOGETHER):
            part = order[at : at + TOGETHER]
            here_chunks = [chunks[n] for n in part.tolist()]
            symbols, taken[part] = self._merged(here_chunks, sizes[part], None if drops is None else tuple(d[part] for d in drops))
            ids, here = self.piece_ids[symbols], symbols != GONE
            spelled = np.flatnonzero((here & (ids < 0)).any(1))
            counts = here.sum(1)
            places = [[*np.flatnonzero(here[row]).tolist(), None] for row in spelled]
            lists = [self._spelled_all([here_chunks[row][i:j] for i, j in zip(p, p[1:])]) for row, p in zip(spelled, places)]
            counts[spelled] = 0
            here[spelled] = False
            flat, ends = ids[here], np.cumsum(counts)
            if len(spelled):  # in their places between the others
                flat = np.insert(flat, np.repeat(ends[spelled], [len(x) for x in lists]), [i for x in lists for i in x])
                counts[spelled] = [len(x) for x in lists]
            found.append(flat.astype(np.int32))
            lengths[part] = counts
        flat = np.concatenate([*found, np.empty(0, np.int32)])
        ends = np.cumsum(lengths[order])
        starts = np.empty(len(chunks), np.int64)
        starts[order] = ends - lengths[order]
        return flat, starts, lengths, taken

    def _remember(self) -> None:
        """Segment the chunks numbered since the last time without drops, and keep their ids in one array."""
        new = self.chunks[len(self.starts) :]
        flat, starts, lengths, taken = self._segmented(new)
        self.starts, self.lengths = np.append(self.starts, starts + len(self.pieces)), np.append(self.lengths, lengths)
        self.taken, self.pieces = np.append(self.taken, taken), np.append(self.pieces, flat)

    def _merged(self, chunks: list[str], sizes: np.ndarray, drops: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of each chunk at the places where they start, GONE elsewhere; and how many candidates it had.

        Each step takes the best merge of every chunk. ``drops`` has the first step that each chunk drops and the stream of
        its further draws.
        """
        n, width = len(chunks), int(sizes.max()) + 1
        letters = np.frombuffer("".join(chunks).encode("utf-32-le"), np.uint32)
        symbols = np.full((n, width), GONE, np.int32)
        symbols[np.arange(width) < sizes[:, None]] = _found(self.letters, self.letter_symbols, letters, OTHER)
        after = np.tile(np.arange(1, width + 1), (n, 1))
        before = after - 2
        ranks = np.full((n, width), np.inf)
        ranks[:, :-1] = self._pair_ranks(symbols[:, :-1], symbols[:, 1:])
        rows, step, taken = np.arange(n), -1, np.zeros(n, np.int64)
        drop_at, streams = (drops[0].copy(), drops[1]) if drops else (None, None)
        count = np.zeros(n, np.uint64)
        while len(rows):
            best = ranks[rows].argmin(1)
            some = ranks[rows, best] < np.inf
            rows, best = rows[some], best[some]
            step += 1
            taken[rows] += 1
            second = after[rows, best]
            third = after[rows, second]
            if drop_at is not None and len(rows):
                gone = drop_at[rows] == step
                lost = rows[gone]
                ranks[lost, best[gone]] = np.inf
                count[lost] += np.uint64(1)
                drop_at[lost] = step + 1 + self._passed(self._draws(streams[lost], count[lost]))
                took, best, second, third = rows[~gone], best[~gone], second[~gone], third[~gone]
            else:
                took = rows
            merged = self.pair_symbols(symbols[took, best].astype(np.int64) * self.n_symbols + symbols[took, second])
            symbols[took, best], symbols[took, second] = merged, GONE
            after[took, best], ranks[took, second] = third, np.inf
            inner = third < width
            before[took[inner], third[inner]] = best[inner]
            right = np.where(inner, symbols[took, np.minimum(third, width - 1)], GONE)
            ranks[took, best] = self._pair_ranks(merged, right)
            left = before[took, best]
            has = left >= 0
            ranks[took[has], left[has]] = self._pair_ranks(symbols[took[has], left[has]], merged[has])
        return symbols, taken

    def _pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return self.symbol_ranks[self.pair_symbols(left.astype(np.int64) * self.n_symbols + right)]

    def _split(self, text: str) -> list[str]:
        chunks: list[str] = []
        for n, part in enumerate(text.split(SPACE) if text else []):
            chunks += [""] * (n > 0) + _CHUNK.findall((part if n else " " + part).replace(" ", SPACE))
        return chunks

    def _draws(self, streams: np.ndarray, count: int | np.ndarray) -> np.ndarray:
        """The draw number ``count`` of each occurrence."""
        if isinstance(count, np.ndarray):
            return mixed(streams + (count + np.uint64(1)) * np.uint64(0xC2B2AE3D27D4EB4F))
        return mixed(streams + np.uint64((count + 1) * 0xC2B2AE3D27D4EB4F & MASK))

    def _passed(self, draws: np.ndarray) -> np.ndarray:
        """Candidates that each draw passes before it drops one; PLACES if it drops none of so many."""
        return PLACES - np.searchsorted(self.passing[::-1], draws, "right")

    def _streams(self, key: int, count: int) -> np.ndarray:
        """A number for the draws of each chunk of a text, from the text's key and the place."""
        start = mixed(mixed(np.array([key & MASK], np.uint64)) ^ np.uint64((self.seed * 0x9E3779B97F4A7C15 + 0x165667B19E3779F9) & MASK))
        return mixed(start + np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))

    def _long_pattern(self, chunk: str, stream: np.ndarray) -> int:
        """Dropped candidates of a chunk of any length."""
        most = 3 * len(chunk)
        bits, at, count = bytearray(b"0") * most, 0, 0
        while at < most:
            draws = np.concatenate([self._draws(stream, i) for i in range(count, count + 64)])
            count += 64
            for gap in self._passed(draws).tolist():
                at += gap
                if gap < PLACES:  # else that many pass, and the next draw goes on
                    if at >= most:
                        break
                    bits[at] = 49
                    at += 1
        return int(bits[::-1], 2)

    def _varied(self, chunks: list[str], streams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of occurrences one after the other, with the candidates dropped that each one's own draws drop; and their ends."""
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        long = np.flatnonzero(sizes > LONGEST).tolist()  # segmented alone, and not kept
        short = chunks if not long else ["" if n > LONGEST else chunk for n, chunk in zip(sizes.tolist(), chunks)]
        codes = np.fromiter(map(self.numbers.__getitem__, short), np.int64, len(chunks))
        self._remember()
        starts, lengths, pool, size = self.starts[codes], self.lengths[codes], [self.pieces], len(self.pieces)
        for n in long:
            pattern = self._long_pattern(chunks[n], streams[n : n + 1]) if self.limit else 0
            ids = np.array(self._spelled_all(self.segment(chunks[n], pattern)), np.int32)
            starts[n], lengths[n] = size, len(ids)
            pool.append(ids)
            size += len(ids)
        if self.limit:
            active = np.flatnonzero(self.taken[codes] > 0)
            draws = self._draws(streams[active], 0)
            some = draws >= self.passing[self.taken[codes[active]] - 1]
            active, first = active[some], self._passed(draws[some])
            flat, at, n_ids, _ = self._segmented([chunks[n] for n in active.tolist()], (first, streams[active]))
            starts[active], lengths[active] = at + size, n_ids
            pool.append(flat)
        ends = np.cumsum(lengths)
        return np.concatenate(pool)[np.repeat(starts - (ends - lengths), lengths) + np.arange(lengths.sum())], ends

    def groups(self, texts: list[str | None], keys: list[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids of the next few texts one after the other, and where each text ends; chunks of a group are segmented together."""
        at = 0
        while at < len(texts):
            if len(self.chunks) >= REMEMBERED:
                self._forget()
            chunks: list[str] = []
            sizes: list[int] = []
            streams: list[np.ndarray] = []
            while at + len(sizes) < len(texts) and len(chunks) < GROUP:
                part = self._split(texts[at + len(sizes)] or "")
                streams.append(self._streams(keys[at + len(sizes)], len(part)) if self.limit else np.empty(0, np.uint64))
                sizes.append(len(part))
                chunks += part
            ids, ends = self._varied(chunks, np.concatenate(streams))
            yield ids, np.append(0, ends)[np.cumsum(sizes)]
            at += len(sizes)

    def encode_all(self, texts: list[str | None], keys: list[int]) -> Iterator[list[int] | None]:
        """Ids of each text."""
        given = iter(texts)
        for ids, stops in self.groups(texts, keys):
            for start, stop in zip([0, *stops[:-1].tolist()], stops.tolist()):
                yield None if next(given) is None else ids[start:stop].tolist()

    def spelled(self, ids: np.ndarray) -> tuple[bytes, np.ndarray]:
        """The bytes of ids one after the other, and where each id's end."""
        lengths = self.byte_lengths[ids]
        ends = np.cumsum(lengths)
        return self.byte_data[np.repeat(self.byte_starts[ids] - (ends - lengths), lengths) + np.arange(lengths.sum())].tobytes(), ends

    def encode(self, text: str, key: int = 0) -> list[int]:
        """Ids of a text; ``key`` (a document's number) and the place of a chunk choose what it drops."""
        return next(self.encode_all([text], [key]))

    def decode(self, ids: list[int]) -> str:
        """The text of encoded ids."""
        text = b"".join(map(self.bytes.__getitem__, ids)).decode()
        return text[1:]


@lru_cache(maxsize=2)
def codec(model: str, dropout: float, seed: int) -> Codec:
    """One codec per Python worker: its tables of pieces and pairs outlive a task, its memory of segmentations does not."""
    return Codec(model, dropout, seed)


def encode(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", model: str = MODEL, dropout: float = DROPOUT, seed: int = SEED, key_column: str | None = None) -> DataFrame:
    """(id, ids, n_ids, lossless) per row: piece ids, and whether they decode to the very text.

    Whole texts are encoded in one pass without a shuffle. A null text has null ids, an empty one none. A null id
    varies segmentations as id 0 does; rows that repeat an id and text get equal ids, unless ``key_column`` names
    other numbers than the ids to draw by. The same seed gives
    the same ids, dropout 0 the model's own.
    """
    schema = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32())), ("n_ids", pa.int64()), ("lossless", pa.bool_())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, dropout, seed)
        for batch in stream:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                texts, drawn = part.column(1).to_pylist(), part.column(2).fill_null(0).to_pylist()
                first = 0
                for ids, stops in own.groups(texts, drawn):
                    rows = slice(first, first + len(stops))
                    first = rows.stop
                    absent = np.array([t is None for t in texts[rows]])
                    offsets = np.append(0, stops).astype(np.int32)
                    data, ends = own.spelled(ids)
                    cuts = np.append(0, ends)[offsets].tolist()
                    fine = [t is not None and data[a:b] == (b" " + t.encode() if t else b"") for t, a, b in zip(texts[rows], cuts, cuts[1:])]
                    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids), mask=pa.array(absent))
                    columns = [part.column(0).slice(rows.start, len(stops)), lists, pa.array(np.diff(offsets).astype(np.int64), mask=absent), pa.array(fine, mask=absent)]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)
        own._forget()  # a worker that waits for other work should not hold what this one needed
        give_back()

    return docs.select(F.col(id_column).cast("long").alias("id"), F.col(text_column).alias("text"), F.col(key_column or id_column).cast("long").alias("key")).mapInArrow(run, "id long, ids array<int>, n_ids long, lossless boolean")


def decode(encoded: DataFrame, id_column: str = "id", ids_column: str = "ids", model: str = MODEL) -> DataFrame:
    """(id, text) of encoded rows; null ids give null text."""
    schema = pa.schema([("id", pa.int64()), ("text", pa.string())])

    def run(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model, 0.0, 0)
        for batch in stream:
            yield batches({"id": batch.column(0).to_pylist(), "text": [None if i is None else own.decode(i) for i in batch.column(1).to_pylist()]}, schema)

    return encoded.select(F.col(id_column).cast("long").alias("id"), F.col(ids_column).alias("ids")).mapInArrow(run, "id long, text string")
