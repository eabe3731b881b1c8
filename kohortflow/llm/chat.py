"""Minimum-cost repair of the roles of conversations.

A legal conversation is at most one system turn, then user and assistant in turn, user first, assistant last. Each
turn is kept, relabelled, or merged into the turn before it; empty turns may be inserted. A shortest path over the
automaton's states (start, system, user, assistant) finds the cheapest repair; of equal ones the first in the order
keep, merge, insert, and of roles system, user, assistant, wins. The result has a row for each turn and insertion with
its rendered part; the parts in order are the rendered conversation.

A conversation is cut into fragments by turn number. A fragment's costs from each state to each other are a 4 x 4
matrix; where a conversation has several fragments, these few numbers fix the states in which fragments begin and
end, and each is then repaired by itself. So no conversation has to fit a task. Rows of a fragment are streamed.

Defined results: null texts are empty, null or unknown roles are cheap to relabel, and role names are matched without case
through ``ALIASES``. Turns with a null number come last; equal numbers are ordered by role and text. Rows without an
id are one conversation. Conversations without turns do not exist; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kohortflow.llm.common import small_batches

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = ("", "system", "user", "assistant")
#: Other names of roles.
ALIASES = {"human": "user", "prompter": "user", "customer": "user", "bot": "assistant", "ai": "assistant", "model": "assistant", "gpt": "assistant", "developer": "system", "instructions": "system"}
RELABEL, GUESS, MERGE, INSERT = 4, 2, 3, 5
FRAGMENT = 4096  # turn numbers of a fragment
NEVER = 1 << 40
OPEN, CLOSE = "<|{}|>\n", "<|end|>\n"
SHAPE = "conv_id long, turn long, place long, action string, role string, cost long, rendered string"


def code_of(role: str | None) -> int:
    name = (role or "").strip().lower()
    return ROLES.get(ALIASES.get(name, name), START)


def edges_of(code: int) -> list[tuple[int, int, int, str, tuple[int, ...]]]:
    """(from, to, cost, action, inserted roles) for a turn of this role (0: unknown), in the order that breaks ties."""
    out = []
    for role in (SYSTEM, USER, ASSISTANT):
        cost = 0 if role == code else RELABEL if code else GUESS
        name = "keep" if role == code else "relabel"
        before = {SYSTEM: (START,), USER: (START, SYSTEM, ASSISTANT), ASSISTANT: (USER,)}[role]
        out += [(s, role, cost, name, ()) for s in before]
        out.append((role, role, cost + MERGE, "merge", ()))
        if role == USER:
            out.append((USER, USER, cost + INSERT, name, (ASSISTANT,)))
        if role == ASSISTANT:
            out += [(s, ASSISTANT, cost + INSERT, name, (USER,)) for s in (START, SYSTEM, ASSISTANT)]
    rank = {"keep": 0, "relabel": 0, "merge": 1}
    return sorted(out, key=lambda e: (rank[e[3]] + 2 * bool(e[4])))


EDGES = [edges_of(code) for code in range(4)]
#: Cost of ending, and what is inserted there.
ENDS = {START: (0, ()), SYSTEM: (2 * INSERT, (USER, ASSISTANT)), USER: (INSERT, (ASSISTANT,)), ASSISTANT: (0, ())}


def _relaxed(costs: list[int], code: int) -> tuple[list[int], list[int]]:
    """Costs after a turn, and the edge by which each state is reached cheapest."""
    best, by = [NEVER] * 4, [-1] * 4
    for k, (s, t, cost, _, _) in enumerate(EDGES[code]):
        if costs[s] + cost < best[t]:
            best[t], by[t] = costs[s] + cost, k
    return best, by


def transfer(codes: Iterator[int]) -> list[int]:
    """Least cost from each state (rows) to each state, flat."""
    matrix = [[0 if i == j else NEVER for j in range(4)] for i in range(4)]
    for code in codes:
        matrix = [_relaxed(row, code)[0] for row in matrix]
    return [c for row in matrix for c in row]


def repaired(codes: list[int], start: int = START, end: int | None = None) -> tuple[list[tuple[str, int, tuple[int, ...]]], tuple[int, ...], int]:
    """(action, role, inserted before) of each turn, roles inserted at the end, cost. ``end``: the state to end in."""
    costs = [0 if s == start else NEVER for s in range(4)]
    steps = []
    for code in codes:
        costs, by = _relaxed(costs, code)
        steps.append(by)
    state = min(range(4), key=lambda s: costs[s] + ENDS[s][0]) if end is None else end
    total, last = (costs[state] + ENDS[state][0], ENDS[state][1]) if end is None else (costs[state], ())
    out = []
    for code, by in zip(reversed(codes), reversed(steps), strict=True):
        s, t, _, action, inserted = EDGES[code][by[state]]
        out.append((action, t, inserted))
        state = s
    return out[::-1], last, total


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, list[tuple]]]:
    """Rows by their first two columns (conversation, fragment), which the rows are sorted by."""
    now, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:2] != now:
                if rows:
                    yield now, rows
                now, rows = row[:2], []
            rows.append(row)
    if rows:
        yield now, rows


def _matrices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out: list[tuple] = []
    for (conv, fragment), rows in _runs(batches):
        out.append((conv, fragment, transfer(code_of(r[2]) for r in rows)))
    yield pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()), pa.array([r[2] for r in out], pa.list_(pa.int64()))], names=["conv_id", "fragment", "matrix"]
    )


def _states(parts: pd.DataFrame) -> pd.DataFrame:
    """Begin and end states of one conversation's fragments on a cheapest path."""
    parts = parts.sort_values("fragment", ignore_index=True)
    costs, steps = [0, NEVER, NEVER, NEVER], []
    for matrix in parts["matrix"]:
        options = [[costs[s] + matrix[4 * s + t] for s in range(4)] for t in range(4)]
        steps.append([min(range(4), key=o.__getitem__) for o in options])
        costs = [o[s] for o, s in zip(options, steps[-1], strict=True)]
    state = min(range(4), key=lambda s: costs[s] + ENDS[s][0])
    begin, end = [], []
    for by in reversed(steps):
        end.append(state)
        state = by[state]
        begin.append(state)
    last = [False] * (len(parts) - 1) + [True]
    return pd.DataFrame({"conv_id": parts["conv_id"], "fragment": parts["fragment"], "begin": begin[::-1], "end": end[::-1], "last": last})


def _rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (conv, fragment, turn, role, text, begin, end, last), sorted, to repaired turns."""
    names = [c.split()[0] for c in SHAPE.split(", ")]
    kinds = [pa.string() if c.endswith("string") else pa.int64() for c in SHAPE.split(", ")]
    out: list[tuple] = []

    def batch() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)], names=names)

    for (conv, fragment), rows in _runs(batches):
        begin, end, last = rows[0][5] or START, rows[0][6], rows[0][7] is not False
        steps, tail, total = repaired([code_of(r[3]) for r in rows], begin, end)
        if end is not None and last:
            tail, total = ENDS[end][1], total + ENDS[end][0]
        place = 0
        opened = begin != START
        for row, (action, role, inserted) in zip(rows, steps, strict=True):
            for extra in inserted:
                out.append((conv, row[2], fragment * (1 << 32) + place, "insert", NAMES[extra], total, (CLOSE if opened else "") + OPEN.format(NAMES[extra])))
                opened, place = True, place + 1
            text = ("\n" if action == "merge" else (CLOSE if opened else "") + OPEN.format(NAMES[role])) + (row[4] or "")
            out.append((conv, row[2], fragment * (1 << 32) + place, action, NAMES[role], total, text))
            opened, place = True, place + 1
        for extra in tail:
            out.append((conv, None, fragment * (1 << 32) + place, "insert", NAMES[extra], total, CLOSE + OPEN.format(NAMES[extra])))
            place += 1
        if last:
            out.append((conv, None, fragment * (1 << 32) + place, "end", None, total, CLOSE))
        if len(out) > 2000:
            yield batch()
            out.clear()
    yield batch()


def repair(turns: DataFrame, fragment: int = FRAGMENT) -> DataFrame:
    """Rows (conv_id, turn, place, action, role, cost, rendered) of (conv_id, turn, role, text).

    ``cost`` is that of the fragment's repair; ``place`` orders the parts of a conversation.
    """
    small_batches(turns.sparkSession)
    part = F.coalesce(F.floor(F.col("turn") / fragment), F.lit(1 << 30)).cast("long")
    rows = turns.select(F.col("conv_id").cast("long").alias("conv_id"), part.alias("fragment"), F.col("turn").cast("long").alias("turn"), "role", "text")
    counts = rows.groupBy("conv_id", "fragment").agg(F.count("*").alias("n")).groupBy("conv_id").agg(F.count("*").alias("fragments")).where("fragments > 1")
    several = rows.join(counts, rows["conv_id"].eqNullSafe(counts["conv_id"]), "left_semi")
    ordered = several.select("conv_id", "fragment", "role", "turn", "text").repartition("conv_id", "fragment").sortWithinPartitions("conv_id", "fragment", F.col("turn").asc_nulls_last(), "role", "text")
    matrices = ordered.select("conv_id", "fragment", "role").mapInArrow(_matrices, "conv_id long, fragment long, matrix array<long>")
    states = matrices.groupBy("conv_id").applyInPandas(_states, "conv_id long, fragment long, begin int, end int, last boolean")
    on = rows["conv_id"].eqNullSafe(states["conv_id"]) & (rows["fragment"] == states["fragment"])
    joined = rows.join(states, on, "left").select(rows["*"], "begin", "end", "last")
    joined = joined.repartition("conv_id", "fragment").sortWithinPartitions("conv_id", "fragment", F.col("turn").asc_nulls_last(), "role", "text")
    return joined.mapInArrow(_rendered, SHAPE)
