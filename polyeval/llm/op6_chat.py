"""Chat formatting with minimum-cost role repair.

Legal conversations follow an automaton: an optional system turn, then user and
assistant turns by turns, ending with the assistant. A conversation is repaired by the
cheapest sequence of choices, found by dynamic programming over the automaton's
states: a turn is taken as it is or relabelled, then it follows legally, is merged
into the turn before it (same role), or follows an inserted empty turn. Ties go to
the first of the options in a fixed order. The repaired turns are rendered.

One conversation may be very long, so no task needs a whole one. Its turns are
dealt into blocks of turn numbers; a block's effect is a matrix of least costs from
each state before it to each state after it, and matrices combine by min-plus
products, block by block and level by level. The top level chooses the states at
the blocks' ends; each level hands them down; a block then repairs and renders its
own turns.

Result: a row per conversation and block (most conversations have one). The ``rendered``
texts of a conversation's blocks, in order, are its rendering: a turn stays open
over a block's end, and the next block closes it or goes on with it.

Defined cases: turns are ordered by turn (nulls last), role, text; repeated rows are
turns of their own; an unknown or null role is relabelled at its own cost; a null
text is empty; rows with a null conversation id are one conversation; an empty table
gives no rows; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from polyeval.llm.common import bounded_batches

BLOCK_BITS = 10  # turn numbers of a block
FAN_BITS = 10  # blocks that one product combines
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ("", "system", "user", "assistant")
NEXT = {BEGIN: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, RELABEL, RELABEL_UNKNOWN, INSERT = 1, 2, 1, 3
NEVER = 1 << 40
OPEN, CLOSE, JOIN = "<|im_start|>{}\n", "<|im_end|>\n", "\n\n"
LAST_BLOCK = (1 << 62) >> BLOCK_BITS


def _options(role: int | None) -> list[list[tuple[int, int, bool, bool, int]]]:
    """For each state: (state after, cost, merged, relabelled, inserted role or 0)."""
    out = []
    for state in range(4):
        ways = []
        for target in (SYSTEM, USER, ASSISTANT):
            label = 0 if target == role else RELABEL_UNKNOWN if role is None else RELABEL
            if target in NEXT[state]:
                ways.append((target, label, False, target != role, 0))
            elif target == state:
                ways.append((target, label + MERGE, True, target != role, 0))
            for between in NEXT[state]:
                if target in NEXT[between] and target not in NEXT[state]:
                    ways.append((target, label + INSERT, False, target != role, between))
        out.append(sorted(ways, key=lambda w: (w[1], w[2], w[3], w[0], w[4])))
    return out


OPTIONS = {r: _options(r) for r in (None, SYSTEM, USER, ASSISTANT)}
KNOWN = {name: i for i, name in enumerate(ROLES) if name}


def role_of(name: str | None) -> int | None:
    return KNOWN.get((name or "").strip().lower())


def ending(state: int) -> tuple[int, list[int]]:
    """Cost and roles of the empty turns that end a conversation after ``state``."""
    roles = []
    while state != ASSISTANT:
        state = USER if state in (BEGIN, SYSTEM) else ASSISTANT
        roles.append(state)
    return INSERT * len(roles), roles


def repair(roles: list[int | None], entry: int) -> tuple[list[int], list[list]]:
    """Least cost to each state after the turns, and each turn's choices by state."""
    cost = [0 if s == entry else NEVER for s in range(4)]
    chosen = []
    for role in roles:
        new, how = [NEVER] * 4, [None] * 4
        for state, ways in enumerate(OPTIONS[role]):
            if cost[state] < NEVER:
                for way in ways:
                    c = cost[state] + way[1]
                    if c < new[way[0]]:
                        new[way[0]], how[way[0]] = c, (state, way)
        cost = new
        chosen.append(how)
    return cost, chosen


def matrix(roles: list[int | None]) -> list[int]:
    """Least costs from each state (rows) to each state, flat."""
    return [c for entry in range(4) for c in repair(roles, entry)[0]]


def product(matrices: list[list[int]]) -> list[int]:
    out = matrices[0]
    for m in matrices[1:]:
        out = [min(min(out[4 * i + k] + m[4 * k + j] for k in range(4)), NEVER) for i in range(4) for j in range(4)]
    return out


def path(matrices: list[list[int]], entry: int, leave: int) -> list[int]:
    """States after each part of the cheapest way from ``entry`` to ``leave``."""
    cost, back = [0 if s == entry else NEVER for s in range(4)], []
    for m in matrices:
        best = [min(range(4), key=lambda i, j=j: (cost[i] + m[4 * i + j], i)) for j in range(4)]
        cost = [min(cost[best[j]] + m[4 * best[j] + j], NEVER) for j in range(4)]
        back.append(best)
    states, at = [], leave
    for best in reversed(back):
        states.append(at)
        at = best[at]
    return states[::-1]


def render(texts: list[str], roles: list[int | None], entry: int, leave: int, last: bool) -> dict:
    """The block's repaired turns, rendered, and what the repair did."""
    cost, chosen = repair(roles, entry)
    ways, at = [], leave
    for how in reversed(chosen):
        before, way = how[at]
        ways.append(way)
        at = before
    out, made, opened = [], [], entry != BEGIN
    total = {"cost": cost[leave], "n_merged": 0, "n_relabelled": 0, "n_inserted": 0}

    def turn(role: int, text: str) -> None:
        nonlocal opened
        out.append((CLOSE if opened else "") + OPEN.format(ROLES[role]) + text)
        made.append(ROLES[role][0])
        opened = True

    for text, (role, _, merged, relabelled, inserted) in zip(texts, reversed(ways)):
        total["n_relabelled"] += relabelled
        if inserted:
            turn(inserted, "")
            total["n_inserted"] += 1
        if merged:
            out.append(JOIN + text)
            total["n_merged"] += 1
        else:
            turn(role, text)
    if last:
        extra, roles_after = ending(leave)
        for role in roles_after:
            turn(role, "")
        total["n_inserted"] += len(roles_after)
        total["cost"] += extra
        out.append(CLOSE)
    return total | {"roles": "".join(made), "rendered": "".join(out)}


def _grouped(df: DataFrame, keys: list[str], order: list, each: Callable[[tuple, list[dict]], list[dict]], schema: str) -> DataFrame:
    """``each`` maps the rows of a key, in order, to rows; the groups of a partition
    are taken from its sorted rows one after the other."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, out = None, [], []
        for b in batches:
            for row in b.to_pylist():
                key = tuple(row[k] for k in keys)
                if rows and key != now:
                    out += each(now, rows)
                    rows = []
                    if len(out) >= 512:
                        yield pa.RecordBatch.from_pylist(out, arrow)
                        out = []
                now = key
                rows.append(row)
        if rows:
            out += each(now, rows)
        if out:
            yield pa.RecordBatch.from_pylist(out, arrow)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def format_chats(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text") -> DataFrame:
    """One row per conversation and block: id, block, n_turns, cost, n_merged,
    n_relabelled, n_inserted, roles (initials of the turns begun), rendered."""
    bounded_batches(df.sparkSession)
    turns = df.select(
        F.col(id_col).alias("conv"), F.coalesce(F.shiftright(F.col(turn_col).cast("long"), BLOCK_BITS), F.lit(LAST_BLOCK)).alias("block"),
        F.col(turn_col).cast("long").alias("turn"), F.col(role_col).cast("string").alias("role"), F.col(text_col).cast("string").alias("text"))
    kind = turns.schema["conv"].dataType.simpleString()
    in_order = [F.col("turn").asc_nulls_last(), "role", "text"]
    table = f"conv {kind}, key long, m array<long>"

    level = _grouped(turns.select("conv", "block", "turn", "role", F.lit(None).cast("string").alias("text")), ["conv", "block"], in_order,
                     lambda key, rows: [{"conv": key[0], "key": key[1], "m": matrix([role_of(r["role"]) for r in rows])}], table)
    levels = [level]
    up = level.withColumn("parent", F.shiftright("key", FAN_BITS))
    levels.append(_grouped(up, ["conv", "parent"], ["key"], lambda key, rows: [
        {"conv": key[0], "key": key[1], "m": product([r["m"] for r in rows])}], table))

    states = f"conv {kind}, key long, entry int, leave int, last boolean"

    def top(key: tuple, rows: list[dict]) -> list[dict]:
        m = [r["m"] for r in rows]
        whole = product(m)
        leave = min(range(4), key=lambda s: (whole[4 * BEGIN + s] + ending(s)[0], s))
        return _between(key[0], rows, m, BEGIN, leave, True)

    def _between(conv, rows, m, entry, leave, last):
        after = path(m, entry, leave)
        return [{"conv": conv, "key": r["key"], "entry": a, "leave": b, "last": last and i == len(rows) - 1}
                for i, (r, a, b) in enumerate(zip(rows, [entry, *after], after))]

    plan = _grouped(levels[1], ["conv"], ["key"], top, states)
    parents = plan.select(F.col("conv").alias("c"), F.col("key").alias("p"), "entry", "leave", "last")
    held = up.join(parents, F.col("conv").eqNullSafe(F.col("c")) & (F.col("parent") == F.col("p")))
    plan = _grouped(held.select("conv", "parent", "key", "m", "entry", "leave", "last"), ["conv", "parent"], ["key"], lambda key, rows: _between(
        key[0], rows, [r["m"] for r in rows], rows[0]["entry"], rows[0]["leave"], rows[0]["last"]), states)

    plan = plan.select(F.col("conv").alias("c"), F.col("key").alias("b"), "entry", "leave", "last")
    full = turns.join(plan, F.col("conv").eqNullSafe(F.col("c")) & (F.col("block") == F.col("b"))).drop("c", "b")

    def finish(key: tuple, rows: list[dict]) -> list[dict]:
        texts = [(r["text"] or "").replace("<|im_", "< |im_") for r in rows]
        done = render(texts, [role_of(r["role"]) for r in rows], rows[0]["entry"], rows[0]["leave"], rows[0]["last"])
        return [{"conv": key[0], "block": key[1], "n_turns": len(rows)} | done]

    out = _grouped(full, ["conv", "block"], in_order, finish,
                   f"conv {kind}, block long, n_turns long, cost long, n_merged long, n_relabelled long, n_inserted long, roles string, rendered string")
    return out.withColumnRenamed("conv", id_col)
