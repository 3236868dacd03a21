"""Chat formatting with minimum-cost role repair.

A conversation is legal if it is an optional system turn and then user and assistant turns in
alternation that end with the assistant. Dynamic programming over this automaton finds the cheapest
way to make a conversation legal by merging a turn into the one before, giving it another role, or
putting empty turns before it; the repaired turns are then rendered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociframe.llm.common import batches
from lociframe.operators.reshape import number_rows
from lociframe.session import stage

ROLES = ("system", "user", "assistant")
# Other names of the roles.
ALIASES = {"human": "user", "prompter": "user", "question": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "ai": "assistant", "answer": "assistant", "developer": "system"}
START = 3  # state before the first turn; the other states are the role of the last turn
STEPS = {START: (0, 1), 0: (1,), 1: (2,), 2: (1,)}
MERGE, RELABEL, UNKNOWN, INSERT = 1, 2, 1, 3  # costs; UNKNOWN gives a role to a turn that has none
SEGMENT = 4096  # turns solved at a time
BEGIN, END = "<|im_start|>", "<|im_end|>\n"
MERGED = "\n\n"


def role_code(role: str | None) -> int:
    """Place of a role in ROLES, or 9."""
    name = (role or "").strip().lower()
    name = ALIASES.get(name, name)
    return ROLES.index(name) if name in ROLES else 9


def _inserted() -> dict[tuple[int, int], tuple[int, ...]]:
    """Turns to put between two states, the fewest that are legal."""
    paths = {}
    for a in STEPS:
        layer = {a: ()}
        for _ in range(3):
            reached = {}
            for state, path in layer.items():
                for b in STEPS[state]:
                    paths.setdefault((a, b), path)
                    reached.setdefault(b, (*path, b))
            layer = reached
    return paths


_PATHS = _inserted()


@lru_cache(maxsize=50_000)
def _plans(roles: tuple[int, ...], entry: int) -> dict[int, tuple[int, tuple]]:
    """Cheapest (cost, actions) by the state after the last turn; an action is (role, merged, turns put before)."""
    best: dict[int, tuple[int, tuple | None]] = {entry: (0, None)}
    for role in roles:
        after: dict[int, tuple[int, tuple | None]] = {}
        for state in sorted(best):
            cost, chain = best[state]
            for q in range(3):
                relabel = 0 if q == role else UNKNOWN if role == 9 else RELABEL
                options = []
                if (state, q) in _PATHS:
                    put = _PATHS[state, q]
                    options.append((cost + relabel + INSERT * len(put), (q, False, put)))
                if q == state:
                    options.append((cost + relabel + MERGE, (q, True, ())))
                for total, action in options:
                    if q not in after or total < after[q][0]:
                        after[q] = (total, (chain, action))
        best = after
    out = {}
    for state, (cost, chain) in best.items():
        actions = []
        while chain is not None:
            chain, action = chain
            actions.append(action)
        out[state] = (cost, tuple(reversed(actions)))
    return out


def closing(state: int) -> tuple[int, ...]:
    """Empty turns that end a conversation after this state."""
    return () if state in (2, START) else (*_PATHS[state, 2], 2)


_CONTROL = re.compile(r"<\|(\\*)(im_start|im_end)\|>")
_ESCAPED = re.compile(r"<\|\\(\\*)(im_start|im_end)\|>")


def escape(text: str | None) -> str:
    """Text without a control token: those in it get a backslash after the bar; all other text stays as it is."""
    return _CONTROL.sub(r"<|\\\1\2|>", text or "")


def unescape(text: str) -> str:
    """The text that ``escape`` was given."""
    return _ESCAPED.sub(r"<|\1\2|>", text)


def _turn(role: int) -> str:
    return f"{BEGIN}{ROLES[role]}\n"


def pieces(actions, texts: list, entry: int, last: bool, state: int) -> list[str]:
    """Rendered piece of every turn: what closes the turn before, empty turns, header and text."""
    out, opened = [], entry != START
    for (role, merged, put), text in zip(actions, texts):
        close = END if opened else ""
        if merged:
            out.append(MERGED + escape(text))
        else:
            out.append(close + "".join(_turn(r) + END for r in put) + _turn(role) + escape(text))
        opened = True
    if last and out:
        out[-1] += END + "".join(_turn(r) + END for r in closing(state))
    return out


_OUT = pa.schema([("conv", pa.int64()), ("turn", pa.int64()), ("place", pa.int64()), ("role", pa.string()), ("merged", pa.bool_()), ("inserted", pa.int32()), ("cost", pa.int64()), ("escaped", pa.bool_()), ("piece", pa.string())])
_OUT_SHAPE = "conv long, turn long, place long, role string, merged boolean, inserted int, cost long, escaped boolean, piece string"


def _groups(stream: Iterator[pa.RecordBatch], width: int) -> Iterator[list[tuple]]:
    """Rows of equal first ``width`` columns, which follow each other."""
    held: list[tuple] = []
    for batch in stream:
        for row in zip(*(batch.column(i).to_pylist() for i in range(batch.num_columns))):
            if held and held[-1][:width] != row[:width]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _rendered(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Input: conv, segment, entry and exit state (exit -1: cheapest end), place, turn, role, text; sorted."""
    rows: list[tuple] = []
    for group in _groups(stream, 2):
        entry, leave = group[0][2], group[0][3]
        plans = _plans(tuple(role_code(r[6]) for r in group), entry)
        last = leave < 0
        state = min(plans, key=lambda s: (plans[s][0] + INSERT * len(closing(s)), s)) if last else leave
        cost, actions = plans[state]
        if last:
            cost += INSERT * len(closing(state))
        made = pieces(actions, [r[7] for r in group], entry, last, state)
        for i, (row, (role, merged, put), piece) in enumerate(zip(group, actions, made)):
            extra = len(closing(state)) if last and i == len(group) - 1 else 0
            rows.append((row[0], row[5], row[4], ROLES[role], merged, len(put) + extra, cost if i == 0 else 0, _CONTROL.search(row[7] or "") is not None, piece))
        if len(rows) > 5000:
            yield batches(dict(zip(_OUT.names, zip(*rows))), _OUT)
            rows = []
    if rows:
        yield batches(dict(zip(_OUT.names, zip(*rows))), _OUT)


def _transfers(stream: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Costs from every state before a segment to every state after it."""
    schema = pa.schema([("conv", pa.int64()), ("segment", pa.int64()), ("costs", pa.list_(pa.int64()))])
    for group in _groups(stream, 2):
        roles = tuple(role_code(r[2]) for r in group)
        costs = []
        for entry in range(4):
            plans = _plans(roles, entry)
            costs += [plans[s][0] if s in plans else -1 for s in range(3)]
        yield batches({"conv": [group[0][0]], "segment": [group[0][1]], "costs": [costs]}, schema)


def _joined(frame: pd.DataFrame) -> pd.DataFrame:
    """States at the borders of the segments of one conversation, cheapest altogether."""
    frame = frame.sort_values("segment")
    best, chains = {START: 0}, []
    for costs in frame["costs"]:
        after: dict[int, int] = {}
        origin = {}
        for a in sorted(best):
            for b in range(3):
                step = int(costs[3 * a + b])
                if step >= 0 and (b not in after or best[a] + step < after[b]):
                    after[b], origin[b] = best[a] + step, a
        best = after
        chains.append(origin)
    state = min(best, key=lambda s: (best[s] + INSERT * len(closing(s)), s))
    leave = []
    for origin in reversed(chains):
        leave.append(state)
        state = origin[state]
    leave.reverse()
    entry = [START, *leave[:-1]]
    return pd.DataFrame({"conv": frame["conv"].to_numpy(), "segment": frame["segment"].to_numpy(), "entry": entry, "leave": [*leave[:-1], -1]})


def repair(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", segment: int = SEGMENT) -> DataFrame:
    """(conv, turn, place, role, merged, inserted, cost, escaped, piece) per turn; a conversation's cost is the sum of its turns'.

    A piece holds the turn's text as it is, but for control tokens in it, which are escaped (see ``escape``) and marked.

    Turns are taken by number, null first, then role and text. Conversations of up to ``segment`` turns are
    solved in one go. Longer ones are cut: the costs between all states of each segment are found side by
    side, combined, and each segment is solved again between the states chosen for it, which gives the same
    least cost. Null or unknown roles cost UNKNOWN to name; null texts are empty; the null conversation is
    one as well. Empty tables give no rows.
    """
    rows = stage(turns.select(F.col(conversation).cast("long").alias("conv"), F.col(turn).cast("long").alias("turn"), F.col(role).cast("string").alias("role"), F.col(text).alias("text")), "chat-turns")
    sizes = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > segment)
    long_ones = stage(sizes.select(F.col("conv").alias("_conv")), "chat-long")
    same = F.col("conv").eqNullSafe(F.col("_conv"))
    order = ["turn", "role", "text"]
    columns = ["conv", "segment", "entry", "leave", "place", "turn", "role", "text"]
    short = rows.join(long_ones, same, "left_anti").withColumns({"segment": F.lit(0).cast("long"), "entry": F.lit(START), "leave": F.lit(-1), "place": F.lit(0).cast("long")})
    out = short.select(columns).repartition("conv").sortWithinPartitions("conv", *order).mapInArrow(_rendered, _OUT_SHAPE)
    if not long_ones.limit(1).count():
        return out
    placed = number_rows(rows.join(long_ones, same, "left_semi"), "place", order, ["conv"])
    placed = stage(placed.withColumn("segment", F.floor(F.col("place") / segment)), "chat-placed")
    slim = placed.select("conv", "segment", "role", "place").repartition("conv", "segment").sortWithinPartitions("conv", "segment", "place")
    costs = slim.mapInArrow(_transfers, "conv long, segment long, costs array<long>")
    states = stage(costs.groupBy("conv").applyInPandas(_joined, "conv long, segment long, entry int, leave int"), "chat-states")
    states = states.withColumnsRenamed({"conv": "_conv", "segment": "_segment"})
    known = placed.join(states, same & (F.col("segment") == F.col("_segment"))).select(columns)
    parts = known.repartition("conv", "segment").sortWithinPartitions("conv", "segment", "place").mapInArrow(_rendered, _OUT_SHAPE)
    return out.union(parts)


def render(repaired: DataFrame) -> DataFrame:
    """(conv, n_turns, n_merged, n_inserted, n_escaped, cost, rendered) per conversation, which is one value of text."""
    parts = F.sort_array(F.collect_list(F.struct("place", "turn", "at", "piece")))
    numbered = repaired.withColumn("at", F.monotonically_increasing_id())  # turns of one number come in their order
    grouped = numbered.groupBy("conv").agg(
        F.sum(F.when(F.col("merged"), 0).otherwise(1) + F.col("inserted")).alias("n_turns"),
        F.sum(F.col("merged").cast("long")).alias("n_merged"), F.sum("inserted").alias("n_inserted"),
        F.sum(F.col("escaped").cast("long")).alias("n_escaped"), F.sum("cost").alias("cost"), parts.alias("parts"),
    )
    return grouped.select("conv", "n_turns", "n_merged", "n_inserted", "n_escaped", "cost", F.array_join(F.transform("parts", lambda p: p["piece"]), "").alias("rendered"))
