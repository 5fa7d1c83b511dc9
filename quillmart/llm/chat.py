"""Operator 2: chat formatting after a minimum-cost repair of roles.

A legal conversation is accepted by an automaton: an optional system turn, then user
and assistant turns in alternation, starting with the user.  Turns come in order and
each is kept, merged into the turn before it (same role), relabelled, or preceded by an
empty turn that makes it legal; each has a cost, and dynamic programming over the
automaton's states finds the cheapest repair.  The repaired turns are then rendered.

Costs are a (min, +) matrix per turn, so stretches of a conversation combine: the
conversations are range-partitioned by id and turn, each partition multiplies the
matrices of its stretch of a conversation that goes on elsewhere, and only these
matrices (at most two stretches a partition) are chained to give every stretch its
entry and exit state.  A conversation of any length is thus repaired in pieces, by
many tasks, with the one result that a single pass would give.

Result: one row per piece of rendered text, in order; a conversation's text is its
pieces joined.  A merged turn is a piece without a header of its own, so no long
message is gathered in one place.

Costs: merge ``MERGE``, relabel ``RELABEL`` (to or from system ``SYSTEM``), empty turn
``INSERT``; an unknown or null role costs nothing to label as user or assistant.  Of equally cheap
repairs the one is taken that, from the last turn back, leaves each turn in the first of
the states system, user, assistant; of ways to get there, the first of keep, merge,
relabel, insert.

Defined results: turns are ordered by turn (null first), role, text; a null or empty
text is an empty message; a null conversation id is a conversation of its own; repeated
rows are turns like any other; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmart.llm.common import checkpoint, table

KEEP, MERGE, RELABEL, SYSTEM, INSERT = 0, 1, 4, 6, 3
ROLES = ("system", "user", "assistant")
#: States: nothing yet, after a system turn, after a user turn, after an assistant turn.
START, AFTER_SYSTEM, AFTER_USER, AFTER_ASSISTANT = range(4)
STATES = 4
FAR = 1 << 50
_AFTER = {"system": AFTER_SYSTEM, "user": AFTER_USER, "assistant": AFTER_ASSISTANT}
_LEGAL = {(START, "system"), (START, "user"), (AFTER_SYSTEM, "user"), (AFTER_USER, "assistant"), (AFTER_ASSISTANT, "user")}
HEADER, FOOTER, JOIN = "<|{}|>\n", "<|end|>\n", "\n\n"


def normal(role: str | None) -> str | None:
    """A known role, or None."""
    role = (role or "").strip().lower()
    role = {"human": "user", "bot": "assistant", "model": "assistant", "ai": "assistant"}.get(role, role)
    return role if role in ROLES else None


def _moves(role: str | None) -> dict[tuple[int, int], tuple[int, tuple]]:
    """(from, to) -> (cost, (action, role, empty turns before)): the cheapest way to take a turn of ``role``."""
    best: dict[tuple[int, int], tuple[int, tuple]] = {}

    def offer(a: int, b: int, cost: int, how: tuple) -> None:
        if (a, b) not in best or cost < best[a, b][0]:
            best[a, b] = (cost, how)

    def label_cost(as_role: str) -> int:
        if role == as_role:
            return KEEP
        if role is None:
            return SYSTEM if as_role == "system" else KEEP
        return SYSTEM if "system" in (role, as_role) else RELABEL

    for a in range(STATES):
        for as_role in sorted(ROLES, key=lambda r: (r != role, ROLES.index(r))):
            cost, action = label_cost(as_role), "keep" if as_role == role else "relabel"
            b = _AFTER[as_role]
            if (a, as_role) in _LEGAL:
                offer(a, b, cost, (action, as_role, ()))
            if a == b:
                offer(a, b, cost + MERGE, ("merge", as_role, ()))
            for empty in ("user", "assistant"):
                if (a, empty) in _LEGAL and (_AFTER[empty], as_role) in _LEGAL:
                    offer(a, b, cost + INSERT, (action, as_role, (empty,)))
    return best


MOVES = {role: _moves(role) for role in (*ROLES, None)}
MATRIX = {role: np.array([[moves.get((a, b), (FAR,))[0] for b in range(STATES)] for a in range(STATES)]) for role, moves in MOVES.items()}


def chain(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The (min, +) product."""
    return np.minimum((a[:, :, None] + b[None]).min(1), FAR)


def costs(roles: list) -> np.ndarray:
    total = np.where(np.eye(STATES, dtype=bool), 0, FAR)
    for role in roles:
        total = chain(total, MATRIX[role])
    return total


def path(roles: list, entry: int, leave: int) -> list[int]:
    """The cheapest states after each turn from ``entry`` to ``leave`` (lowest states first among equals)."""
    back = []
    now = np.where(np.arange(STATES) == entry, 0, FAR)
    for role in roles:
        step = now[:, None] + MATRIX[role]
        back.append(step.argmin(0))
        now = np.minimum(step.min(0), FAR)
    states, at = [], leave
    for choice in reversed(back):
        states.append(at)
        at = int(choice[at])
    return states[::-1]


def render(roles: list, states: list[int], entry: int, texts: list, begins: bool, ends: bool) -> list[tuple]:
    """(action, role, empty, cost, piece) rows of a stretch; a piece closes the turn before it if it opens one."""
    out, at, opened = [], entry, not begins
    for role, to, text in zip(roles, states, texts):
        cost, (action, as_role, empties) = MOVES[role][at, to]
        if action == "merge":
            out.append((action, as_role, False, cost, JOIN + (text or "")))
        else:
            close = FOOTER if opened else ""
            for empty in empties:
                out.append(("insert", empty, True, INSERT, close + HEADER.format(empty)))
                close, cost = FOOTER, cost - INSERT
            out.append((action, as_role, False, cost, close + HEADER.format(as_role) + (text or "")))
        at, opened = to, True
    if ends and out:
        *rest, piece = out[-1]
        out[-1] = (*rest, piece + FOOTER)
    return out


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, pa.Table]]:
    """(conversation, its rows here) of a sorted partition, one after the other."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = batch.column("conv").to_pylist()
        cuts = [0, *(i for i in range(1, len(ids)) if ids[i] != ids[i - 1]), len(ids)]
        if held and held[-1].column("conv")[-1].as_py() != ids[0]:
            yield held[0].column("conv")[0].as_py(), pa.Table.from_batches(held)
            held = []
        for a, b in zip(cuts[:-2], cuts[1:-1]):
            held.append(batch.slice(a, b - a))
            yield ids[a], pa.Table.from_batches(held)
            held = []
        held.append(batch.slice(cuts[-2]))
    if held:
        yield held[0].column("conv")[0].as_py(), pa.Table.from_batches(held)


def repair(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, part, piece, turn, action, role, cost, rendered) by order of part and piece within a conversation."""
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text"))
    # A row's place of origin parts equal rows, so that even one repeated row spreads over partitions.
    rows = checkpoint(rows.withColumn("at", F.monotonically_increasing_id()))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first(), "at"]
    rows = checkpoint(rows.repartitionByRange(*order).sortWithinPartitions(*order))
    kind, turn_kind = (rows.schema[c].dataType.simpleString() for c in ("conv", "turn"))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of the first and the last conversation here: its cost matrix."""
        part, first, last = TaskContext.get().partitionId(), None, None
        for conv, own in _stretches(batches):
            if first is None:
                first = (conv, costs([normal(r) for r in own.column("role").to_pylist()]))
                last = first
            else:
                last = (conv, own)
        if first is None:
            return
        if last is not first:
            last = (last[0], costs([normal(r) for r in last[1].column("role").to_pylist()]))
        found = [first] if last is first else [first, last]
        yield pa.RecordBatch.from_arrays(
            [pa.array([c for c, _ in found], rows_type), pa.array([part] * len(found), pa.int32()),
             pa.array([m.ravel().tolist() for _, m in found], pa.list_(pa.int64()))], ["conv", "part", "matrix"])

    from pyspark.sql.pandas.types import to_arrow_type
    rows_type, turn_type = to_arrow_type(rows.schema["conv"].dataType), to_arrow_type(rows.schema["turn"].dataType)
    found = rows.mapInArrow(ends, f"conv {kind}, part int, matrix array<long>").collect()  # two rows a partition at most
    stretches: dict[object, list] = {}
    for r in sorted(found, key=lambda r: r.part):
        stretches.setdefault(r.conv, []).append((r.part, np.array(r.matrix).reshape(STATES, STATES)))
    states: dict[tuple, tuple[int, int, bool, bool]] = {}
    for conv, parts in stretches.items():
        if len(parts) < 2:
            continue
        upto = [np.where(np.arange(STATES) == START, 0, FAR)]
        for _, m in parts:
            upto.append(np.minimum((upto[-1][:, None] + m).min(0), FAR))
        leave = int(upto[-1].argmin())
        for k in range(len(parts) - 1, -1, -1):
            enter = int((upto[k] + parts[k][1][:, leave]).argmin()) if k else START
            states[conv, parts[k][0]] = (enter, leave, k == 0, k == len(parts) - 1)
            leave = enter

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, out = TaskContext.get().partitionId(), []
        for conv, own in _stretches(batches):
            roles = [normal(r) for r in own.column("role").to_pylist()]
            enter, leave, begins, closes = states.get((conv, part), (START, None, True, True))
            if leave is None:
                leave = int(costs(roles)[START].argmin())
            texts, turns = own.column("text").to_pylist(), own.column("turn").to_pylist()
            piece = 0
            turn = iter(turns)
            for action, role, empty, cost, text in render(roles, path(roles, enter, leave), enter, texts, begins, closes):
                out.append((conv, part, piece, None if empty else next(turn), action, role, cost, text))
                piece += 1
            if len(out) > 5000:
                yield batch_of(out)
                out = []
        if out:
            yield batch_of(out)

    def batch_of(out: list[tuple]) -> pa.RecordBatch:
        kinds = [rows_type, pa.int32(), pa.int32(), turn_type, pa.string(), pa.string(), pa.int32(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)

    names = ["conv", "part", "piece", "turn", "action", "role", "cost", "rendered"]
    return rows.mapInArrow(run, f"conv {kind}, part int, piece int, turn {turn_kind}, action string, role string, cost int, rendered string")


def op2_chat_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, repaired and rendered in pieces."""
    return repair(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text").withColumnRenamed("conv", "conv_id")
