"""Chat formatting: cheapest repair of turn order, then the rendered conversation."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartpost.llm.tables import session, store
from chartpost.session import shuffle_partitions

# The automaton: the role of the last turn, and which roles may follow it.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
NEXT = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
FINAL = (START, ASSISTANT)
FAR = 1 << 40


@dataclass(frozen=True)
class Costs:
    """Of joining a turn to the one before, of another role for it, of an empty turn."""

    merge: int = 1
    relabel: int = 3
    insert: int = 2


@dataclass(frozen=True)
class Step:
    """How one turn moves the automaton: cost, empty turns before it, and its own role."""

    cost: int
    inserted: tuple[int, ...]
    merged: bool


@lru_cache(maxsize=64)
def detour(start: int, end: int) -> tuple[int, ...] | None:
    """Fewest empty turns that lead from ``start`` to ``end``."""
    paths = [((), start)]
    seen = {start}
    for path, state in paths:
        if state == end:
            return path
        for role in NEXT[state]:
            if role not in seen:
                seen.add(role)
                paths.append(((*path, role), role))
    return None


@lru_cache(maxsize=256)
def steps(role: str | None, costs: Costs) -> dict[tuple[int, int], Step]:
    """Cheapest step between each two states for a turn of ``role``.

    Equal costs: the turn stands alone rather than joins, and with fewer empty turns.
    """
    found = {}
    for start in range(4):
        for end in (SYSTEM, USER, ASSISTANT):
            other = costs.relabel * (role != ROLES[end])
            ways = []
            for before in range(4):
                path = detour(start, before)
                if path is not None and end in NEXT[before]:
                    ways.append(Step(costs.insert * len(path) + other, path, False))
            if start == end:
                ways.append(Step(costs.merge + other, (), True))
            if ways:
                found[start, end] = min(ways, key=lambda s: (s.cost, s.merged, len(s.inserted)))
    return found


def matrix(role: str | None, costs: Costs) -> np.ndarray:
    out = np.full((4, 4), FAR, np.int64)
    for (start, end), step in steps(role, costs).items():
        out[start, end] = step.cost
    return out


def compose(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Costs of one stretch of turns after another."""
    return np.minimum((first[:, :, None] + second[None, :, :]).min(axis=1), FAR)


def end_cost(state: int, costs: Costs) -> int:
    """Empty turns that bring ``state`` to a final one."""
    return costs.insert * min(len(detour(state, final) or ()) if state != final else 0 for final in FINAL if state == final or detour(state, final) is not None)


def path_of(roles: list[str | None], start: int, end: int, costs: Costs) -> list[int]:
    """States after each turn of a cheapest way from ``start`` to ``end``; ties to the lower state."""
    value = [0 if state == start else FAR for state in range(4)]
    back = []
    for role in roles:
        after, came = [FAR] * 4, [0] * 4
        for (a, b), step in steps(role, costs).items():
            total = value[a] + step.cost
            if total < after[b] or total == after[b] and after[b] < FAR and a < came[b]:
                after[b], came[b] = total, a
        value = after
        back.append(came)
    states = [end]
    for came in reversed(back[1:]):
        states.append(came[states[-1]])
    return states[::-1] if roles else []


COLUMNS = ("conv_id", "turn", "role", "text")
HELD = "conv_id long, turn long, role string, text string, chunk long, at long, costs array<long>"
OUT = "conv_id long, seq long, turn long, role string, action string, cost long, rendered string"


def _chunk(costs: Costs) -> Callable:
    """Number the turns of each conversation in a task; the last holds the stretch's costs."""

    def chunk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        conv, at, total, held = object(), 0, None, None
        matrices = {}

        def ended(row: dict) -> dict:
            return {**row, "costs": total.ravel().tolist()}

        schema = None
        for batch in batches:
            out = []
            schema = schema or pa.schema([*batch.schema, ("chunk", pa.int64()), ("at", pa.int64()), ("costs", pa.list_(pa.int64()))])
            for row in batch.to_pylist():
                if held is not None:
                    same = row["conv_id"] == conv
                    out.append({**held, "costs": None} if same else ended(held))
                    if not same:
                        at, total = 0, None
                conv, role = row["conv_id"], row["role"]
                step = matrices.get(role)
                if step is None:
                    step = matrices[role] = matrix(role, costs) if role in ROLES else matrix(None, costs)
                total = step if total is None else compose(total, step)
                held = {**row, "chunk": part, "at": at}
                at += 1
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held is not None:
            yield pa.RecordBatch.from_pylist([ended(held)], schema)

    return chunk


def _ends(costs: Costs) -> Callable:
    """States at the borders of one conversation's stretches, at most one per partition."""

    def ends(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("chunk")
        stretches = [np.array(c, np.int64).reshape(4, 4) for c in rows["costs"]]
        value, back = np.array([0, FAR, FAR, FAR]), []
        for stretch in stretches:
            through = value[:, None] + stretch
            back.append(through.argmin(axis=0))
            value = np.minimum(through.min(axis=0), FAR)
        final = int(np.argmin([v + end_cost(state, costs) for state, v in enumerate(value)]))
        after = [final]
        for came in reversed(back[1:]):
            after.append(int(came[after[-1]]))
        after = after[::-1]
        return pd.DataFrame(
            {
                "_conv": rows["conv_id"],
                "_chunk": rows["chunk"],
                "first": [START, *after[:-1]],
                "last": after,
                "closing": [False] * (len(after) - 1) + [True],
            }
        )

    return ends


def _opened(role: int) -> str:
    return f"<|{ROLES[role]}|>\n"


CLOSED = "<|end|>\n"


def _render(costs: Costs) -> Callable:
    """Sorted stretches -> segments of the rendered conversation."""

    def segments(rows: list[dict]) -> Iterator[dict]:
        conv, chunk = rows[0]["conv_id"], rows[0]["chunk"]
        state = rows[0]["first"]
        path = path_of([row["role"] if row["role"] in ROLES else None for row in rows], state, rows[0]["last"], costs)
        for row, after in zip(rows, path):
            known = row["role"] if row["role"] in ROLES else None
            step = steps(known, costs)[state, after]
            seq = (chunk << 40) + row["at"] * 4
            # What stands before closes when the next turn opens, so a turn may go on in the next stretch.
            for k, role in enumerate(step.inserted):
                text = CLOSED * (state != START) + _opened(role)
                yield {"conv_id": conv, "seq": seq + k, "turn": None, "role": ROLES[role], "action": "insert", "cost": costs.insert, "rendered": text}
                state = role
            moved = known != ROLES[after]
            text = "\n" if step.merged else CLOSED * (state != START) + _opened(after)
            action = ("merge" if step.merged else "keep") if not moved else ("merge_relabel" if step.merged else "relabel")
            yield {
                "conv_id": conv, "seq": seq + 3, "turn": row["turn"], "role": ROLES[after], "action": action,
                "cost": costs.merge * step.merged + costs.relabel * moved, "rendered": text + (row["text"] or ""),
            }
            state = after
        if rows[0]["closing"]:
            final = min(FINAL, key=lambda f: (0 if f == state else len(detour(state, f) or (1,) * 9)))
            for k, role in enumerate(detour(state, final) if state != final else ()):
                yield {"conv_id": conv, "seq": seq + 4 + k, "turn": None, "role": ROLES[role], "action": "insert", "cost": costs.insert, "rendered": CLOSED + _opened(role)}
            yield {"conv_id": conv, "seq": seq + 8, "turn": None, "role": None, "action": "end", "cost": 0, "rendered": CLOSED}

    schema = pa.schema([
        ("conv_id", pa.int64()), ("seq", pa.int64()), ("turn", pa.int64()), ("role", pa.string()),
        ("action", pa.string()), ("cost", pa.int64()), ("rendered", pa.string()),
    ])

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if held and (row["conv_id"], row["chunk"]) != (held[0]["conv_id"], held[0]["chunk"]):
                    out.extend(segments(held))
                    held = []
                held.append(row)
            if out:
                yield pa.RecordBatch.from_pylist(out, schema)
        if held:
            yield pa.RecordBatch.from_pylist(list(segments(held)), schema)

    return render


def repair_conversations(conversations: DataFrame, costs: Costs = Costs()) -> DataFrame:
    """Segments of every repaired conversation, from rows (conv_id, turn, role, text).

    A legal conversation is an optional system turn, then user and assistant turns by
    turns, ended by an assistant's.  Turns are taken in order of turn (ties by role, then
    text).  Each one stands, takes another role, joins the turn before, or has empty
    turns put before it, and empty turns may follow the last: the choice of least total
    cost.  One row per turn, empty turn and end, in order of seq (increasing, not
    gapless): turn (null if empty), its role in the repaired conversation, action, cost, and
    rendered text; a conversation's rendered segments in order are the formatted chat.

    An unknown or null role is relabelled always; a null text is empty; a null conv_id is
    one conversation; repeated rows are turns of their own.  An empty table gives no rows.
    Other columns are ignored.

    Rows are dealt by ranges of (conv_id, turn), which cut long conversations at any
    turn.  Each stretch yields a 4 x 4 table of costs between states; a conversation's
    tables, at most one per partition, give the states at the cuts, and then each
    stretch is solved by itself.
    """
    spark = session(conversations.sparkSession)
    rows = conversations.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long"), F.col("role").cast("string"), F.col("text").cast("string")
    )
    parts = shuffle_partitions(spark)
    order = ["conv_id", "turn", "role", F.xxhash64("text"), "text"]
    ranged = rows.repartitionByRange(parts, *order[:4]).sortWithinPartitions(*order)
    held = store(ranged.mapInArrow(_chunk(costs), HELD), "turns")
    pieces = held.where("costs is not null").select("conv_id", "chunk", "costs")
    grouped = store(
        pieces.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.max(F.struct("chunk", "costs")).alias("one")),
        "stretches",
    )
    reached = F.array(*[F.col("one.costs")[state] + end_cost(state, costs) for state in range(4)])
    whole = grouped.where("n = 1").select(
        F.col("conv_id").alias("_conv"),
        F.col("one.chunk").alias("_chunk"),
        F.lit(START).alias("first"),
        (F.array_position(reached, F.array_min(reached)) - 1).cast("int").alias("last"),
        F.lit(True).alias("closing"),
    )
    several = grouped.where("n > 1").select(F.col("conv_id").alias("_of"))
    cut = (
        pieces.join(several, F.col("conv_id").eqNullSafe(F.col("_of")), "left_semi")
        .groupBy("conv_id")
        .applyInPandas(_ends(costs), "_conv long, _chunk long, first int, last int, closing boolean")
    )
    borders = store(whole.unionByName(cut), "borders")
    joined = held.drop("costs").join(
        borders, F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk"))
    )
    return (
        joined.drop("_conv", "_chunk")
        .repartition(parts, "conv_id", "chunk")
        .sortWithinPartitions("conv_id", "chunk", "at")
        .mapInArrow(_render(costs), OUT)
    )
