"""Role repair of conversations at the least cost, and their rendering as text.

A legal conversation is an optional system turn, then user and assistant turns in alternation, the
last by the assistant. Each given turn is kept, relabelled, or merged into the turn before it, and
empty turns may be inserted before it; the cheapest choice for the whole conversation is made.

A turn is a small table of costs from state to state, and such tables multiply (least sum). So a
long conversation is cut into segments; each gives one table, the tables of a conversation settle
the states at the cuts, and every segment is then repaired on its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oreworks.sinks.files import materialize

ROLES = ("system", "user", "assistant")
#: States: nothing yet, or the role of the last turn.
START, SYSTEM, USER, ASSISTANT = range(4)
#: Which role may follow each state.
FOLLOWS = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
#: Costs of a merge, a relabelled turn and an inserted empty turn.
MERGE, RELABEL, INSERT = 1, 3, 2
#: Turns of a conversation that one task repairs at a time.
SEGMENT_TURNS = 4096
_FAR = 1 << 40


@cache
def moves(role: int) -> tuple[tuple[tuple[int, int, int, str, tuple[int, ...]], ...], ...]:
    """For each state and next state the cheapest ways to take a turn of a role (0: unknown role).

    An entry is (next state, cost, order among equals, action, roles inserted before the turn).
    A turn is merged only into one of its own role. Ties go to fewer insertions, then to keeping,
    merging, relabelling, then to the earlier role.
    """
    table = []
    for state in range(4):
        best: dict[int, tuple] = {}

        def offer(to: int, cost: int, rank: int, action: str, inserted: tuple[int, ...]) -> None:
            entry = (to, cost, rank, action, inserted)
            if to not in best or entry[1:3] < best[to][1:3]:  # noqa: B023
                best[to] = entry  # noqa: B023

        if role and role == state:
            offer(state, MERGE, 1, "merge", ())
        paths = [((), state)]
        for r in FOLLOWS[state]:
            paths.append(((r,), r))
            paths += [((r, q), q) for q in FOLLOWS[r]]
        for inserted, at in paths:
            for to in FOLLOWS[at]:
                kept = to == role
                cost = INSERT * len(inserted) + (0 if kept else RELABEL)
                offer(to, cost, 10 * len(inserted) + (0 if kept else 2) + to, "keep" if kept else "relabel", inserted)
        table.append(tuple(best[k] for k in sorted(best)))
    return tuple(table)


def _closing(state: int) -> tuple[int, tuple[int, ...]]:
    """Cost and roles of the turns inserted at the end, so that the assistant has the last word."""
    inserted = {START: (), SYSTEM: (USER, ASSISTANT), USER: (ASSISTANT,), ASSISTANT: ()}[state]
    return INSERT * len(inserted), inserted


@cache
def _matrix(role: int) -> np.ndarray:
    costs = np.full((4, 4), _FAR, dtype=np.int64)
    for state, ways in enumerate(moves(role)):
        for to, cost, *_ in ways:
            costs[state, to] = cost
    return costs


def costs_of(roles: list[int]) -> np.ndarray:
    """Least cost from each state before the turns to each state after them."""
    total = np.full((4, 4), _FAR, dtype=np.int64)
    np.fill_diagonal(total, 0)
    for role in roles:
        total = np.minimum((total[:, :, None] + _matrix(role)[None, :, :]).min(axis=1), _FAR)
    return total


def best_states(matrices: list[np.ndarray]) -> list[int]:
    """States at the cuts of a conversation, from the start to the end, for the least total cost."""
    ahead = [np.array([_closing(s)[0] for s in range(4)], dtype=np.int64)]
    for m in reversed(matrices):
        ahead.append((m + ahead[-1][None, :]).min(axis=1))
    ahead.reverse()
    states = [START]
    for m, rest in zip(matrices, ahead[1:], strict=True):
        states.append(int(np.argmin(m[states[-1]] + rest)))
    return states


def repair(roles: list[int], start: int = START, end: int | None = None) -> list[tuple[str, int, tuple[int, ...]]]:
    """The cheapest path through the turns: action, role and roles inserted before each.

    It leads to the state ``end``; without one, to the end of the conversation.
    """
    ahead = [[_closing(s)[0] if end is None else 0 if s == end else _FAR for s in range(4)]]
    for role in reversed(roles):
        after = ahead[-1]
        ahead.append([min((cost + after[to] for to, cost, *_ in ways), default=_FAR) for ways in moves(role)])
    ahead.reverse()
    out, state = [], start
    for i, role in enumerate(roles):
        way = min(moves(role)[state], key=lambda w: (w[1] + ahead[i + 1][w[0]], w[2]))
        state = way[0]
        out.append((way[3], state, way[4]))
    return out


def role_numbers(roles) -> list[int]:
    """Numbers of role names in any case; 0 for null and unknown ones, which must be relabelled."""
    number = {name: i + 1 for i, name in enumerate(ROLES)}
    return [number.get(r.strip().lower(), 0) if isinstance(r, str) else 0 for r in roles]


#: The marks of a rendered turn, and such marks behind escapes of their own.
_MARK = re.compile(r"<(\\*)\|im_(start|end)\|>")
_ESCAPED = re.compile(r"<\\(\\*)\|im_(start|end)\|>")


def escaped(text: str) -> str:
    """A text whose marks can't open or close a turn: one backslash more behind their first sign."""
    return _MARK.sub(r"<\\\1|im_\2|>", text)


def unescaped(text: str) -> str:
    """What :func:`escaped` was given."""
    return _ESCAPED.sub(r"<\1|im_\2|>", text)


def rendered_turn(action: str, role: int, inserted: tuple[int, ...], text: str, first: bool) -> str:
    """What a turn adds to the conversation's text. A turn stays open until the next one starts."""
    begin = lambda r: f"<|im_start|>{ROLES[r - 1]}\n"
    if action == "merge":
        return "\n\n" + text
    opened = "" if first else "<|im_end|>\n"
    return opened + "".join(begin(r) + "<|im_end|>\n" for r in inserted) + begin(role) + text


def _segment_costs(turns: pd.DataFrame) -> pd.DataFrame:
    table = costs_of(role_numbers(turns.sort_values("nth")["role"]))
    return turns[["conv", "segment"]].head(1).assign(costs=[table.ravel().tolist()])


def _segment_states(segments: pd.DataFrame) -> pd.DataFrame:
    segments = segments.sort_values("segment")
    states = best_states([np.array(c, dtype=np.int64).reshape(4, 4) for c in segments["costs"]])
    return pd.DataFrame(
        {"conv": segments["conv"], "segment": segments["segment"], "before": states[:-1], "after": states[1:], "last": [False] * (len(segments) - 1) + [True]}
    )


_OUT = (
    "conv bigint, nth bigint, turn bigint, action string, new_role string, inserted_before array<string>, "
    "inserted_after array<string>, cost bigint, piece string"
)
_NAMES = lambda roles: [ROLES[r - 1] for r in roles]


def repaired_turns(turns: list[dict]) -> list[tuple]:
    """Rows of the result for the turns of one segment, in their order."""
    head = turns[0]
    # Without states of its own a segment is a whole conversation.
    whole = head["before"] is None
    last = whole or head["last"]
    roles = role_numbers(t["role"] for t in turns)
    steps = repair(roles) if whole else repair(roles, head["before"], head["after"])
    rows = []
    for i, (turn, (action, role, inserted)) in enumerate(zip(turns, steps, strict=True)):
        piece = rendered_turn(action, role, inserted, escaped(turn["text"] or ""), turn["nth"] == 0)
        own = {"keep": 0, "merge": MERGE, "relabel": RELABEL}[action] + INSERT * len(inserted)
        closing: tuple[int, ...] = ()
        if last and i == len(steps) - 1:
            cost, closing = _closing(role)
            own += cost
            piece += "".join(f"<|im_end|>\n<|im_start|>{r}\n" for r in _NAMES(closing)) + "<|im_end|>\n"
        rows.append((turn["conv"], turn["nth"], turn["turn"], action, ROLES[role - 1], _NAMES(inserted), _NAMES(closing), own, piece))
    return rows


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments in rows sorted by conversation, segment and turn."""
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.string()), pa.list_(pa.string()), pa.int64(), pa.string()]
    names = [c.split()[0] for c in _OUT.split(", ")]
    held: list[dict] = []

    def out(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    for batch in batches:
        rows: list[tuple] = []
        for turn in batch.to_pylist():
            if held and (turn["conv"], turn["segment"]) != (held[0]["conv"], held[0]["segment"]):
                rows += repaired_turns(held)
                held = []
            held.append(turn)
        yield out(rows)
    if held:
        yield out(repaired_turns(held))


def repair_roles(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    segment_turns: int = SEGMENT_TURNS,
) -> DataFrame:
    """One row per given turn: what becomes of it and what it adds to the rendered conversation.

    Returns ``conv, nth, turn, action, new_role, inserted_before, inserted_after, cost, piece``;
    a conversation's text is its pieces joined in the order of ``nth``, its cost their sum.

    Turns are ordered by number, then role and text; a null number comes first, and repeated rows
    are turns of their own. A null conversation id is a conversation like any other. Null and
    unknown roles must be relabelled, null texts are empty. Marks of turns within a text are escaped
    (``escaped``), so that no text makes turns of its own. The result is the cheapest one over the
    whole conversation; ties are settled in a fixed order.

    Rows are range-partitioned by conversation and turn, so that a conversation with a large share
    of all rows is spread over tasks; it is numbered by adding the sizes of its earlier parts.
    """
    spark = turns.sparkSession
    named = turns.select(
        F.col(conv_col).cast("bigint").alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
        F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"),
    )
    order = ["conv", "turn", "role", "text"]
    n = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # A table in that order: row numbers inside a part are then a property of the written rows.
    ranged = named.repartitionByRange(n, *order, F.rand(5)).sortWithinPartitions(*order)
    ranged = ranged.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("row"))
    ranged = materialize(ranged, "turns")
    parts = ranged.groupBy("conv", "part").agg(F.count("*").alias("n"), F.min("row").alias("first"))
    # Few rows: a conversation has more than one part only where it crosses the end of a range.
    before = F.expr("sum(n) OVER (PARTITION BY conv ORDER BY part ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)")
    parts = parts.select(F.col("conv").alias("_c"), F.col("part").alias("_p"), "first", F.coalesce(before, F.lit(0)).alias("start"))
    met = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("part") == F.col("_p"))
    nth = F.col("row") - F.col("first") + F.col("start")
    numbered = ranged.join(parts, met).select("conv", "turn", "role", "text", nth.alias("nth"))
    numbered = materialize(numbered.withColumn("segment", F.expr(f"nth DIV {segment_turns}")), "numbered-turns")
    # Only conversations of several segments need states at the cuts.
    long = numbered.filter("segment > 0").select(F.col("conv").alias("_c")).distinct()
    cut = numbered.join(long, F.col("conv").eqNullSafe(F.col("_c")), "left_semi")
    costs = cut.select("conv", "segment", "nth", "role").groupBy("conv", "segment")
    costs = costs.applyInPandas(_segment_costs, "conv bigint, segment bigint, costs array<bigint>")
    states = costs.groupBy("conv").applyInPandas(
        _segment_states, "conv bigint, segment bigint, before int, after int, last boolean"
    )
    states = states.withColumnsRenamed({"conv": "_c", "segment": "_s"})
    same = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("segment") == F.col("_s"))
    whole = numbered.join(states, same, "left").drop("_c", "_s")
    dealt = whole.repartition("conv", "segment").sortWithinPartitions("conv", "segment", "nth")
    return dealt.mapInArrow(_repaired, _OUT)


def rendered(pieces: DataFrame, conv: int) -> Iterator[str]:
    """The text of one conversation, piece by piece."""
    own = pieces.filter(F.col("conv").eqNullSafe(F.lit(conv))).orderBy("nth").select("piece")
    return (row.piece for row in own.toLocalIterator())
