"""Operator 12: conversation structure repair by Knuth's lightest-derivation agenda.

A repaired conversation has an optional system turn and then pairs of user and assistant
turns: its role initials match ``(s?(ua)+)?``.  Rows are kept (0), given the role user or
assistant (3) or deleted (4, and blank or repeated rows must be), empty user or assistant
turns are inserted (3), and a truncated row that stays adds 3.  The cheapest edits are
wanted, and of equally cheap ones those whose initials, in order, come first in ASCII.

Items are (rows consumed, state of the automaton); an edit deduces one item from
another, adding to its weight: (cost, edits so far).  Weights only grow and keep their
order under an edit, that is, the edits are monotone superior functions, so the lightest
item on the agenda is final when it is popped (Knuth's generalisation of Dijkstra's
algorithm).  Two weights of one item can't tie in cost with one's edits beginning the
other's: equal edits lead to equal states, and further inserts cost.

Any number of rows may belong to one conversation, so it is repaired in blocks of at
most ``BLOCK`` rows by many tasks.  A block's agenda gives the lightest edits from each
state that it may be entered in to each that it may be left in.  These are items too:
prefix (up to block k, in state p) and block (from p to q) together deduce the prefix up
to k + 1 in q.  Every piece of edits ends with a row's own edit, so no piece begins
another of the same block, and comparing pieces by their rank within the block compares
whole edit strings; what is chained is 16 costs and ranks a block.

Faults: blank (no character but blanks), duplicate (role and text seen before in the
conversation), truncated (the last character that isn't blank is no ``.!?``); a row's
first fault counts.

Defined results: rows are ordered by turn (nulls first), role and a hash of the text; a
null role or text is one space; a null conversation id is a conversation like any other;
empty texts are blank; a repeated row is a duplicate; very long texts are never joined
in one place (only the digest streams them, row by row); an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Hashable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quillmart.llm.common import checkpoint, table

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: Rows that one agenda takes at most.
BLOCK = 256
# States: nothing yet, after a system, a user, an assistant turn.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
NEXT = {START: (("s", SYSTEM), ("u", USER)), SYSTEM: (("u", USER),), USER: (("a", ASSISTANT),), ASSISTANT: (("u", USER),)}
LEGAL = ("su", "ua", "au")
ROLES = {"u": "user", "a": "assistant"}
#: What ends a conversation left in a state: inserted turns.
CLOSING = {START: "", ASSISTANT: "", USER: "I", SYSTEM: "II"}
NONE, BLANK, DUPLICATE, CUT = range(4)
NOT_BLANK = r"[^\x20\x09-\x0D]"

Item, Weight = Hashable, tuple


def lightest(axioms: Iterable[tuple[Item, Weight]], deduce: Callable[[Item, Weight], Iterable[tuple[Item, Weight]]],
             goals: set) -> dict[Item, Weight]:
    """Item -> lightest weight, for the items popped until every goal that can be derived is final."""
    agenda = [(w, i) for i, w in axioms]
    heapq.heapify(agenda)
    final: dict[Item, Weight] = {}
    left = set(goals)
    while agenda and left:
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        left.discard(item)
        for new, heavier in deduce(item, weight):
            if new not in final:
                heapq.heappush(agenda, (heavier, new))
    return final


def edits(initials: list[str], faults: list[int], entry: int) -> dict[int, tuple[int, str]]:
    """State after the block -> (cost, edits) of the lightest derivation from ``entry``."""
    n = len(initials)

    def deduce(item: tuple[int, int], weight: tuple[int, str]) -> Iterator[tuple]:
        i, state = item
        if i == n:
            return
        cost, audit = weight
        yield (i + 1, state), (cost + DELETE, audit + "D")
        stays, extra = faults[i] not in (BLANK, DUPLICATE), TRUNCATED if faults[i] == CUT else 0
        for initial, after in NEXT[state]:
            if initial in ROLES:
                yield (i, after), (cost + INSERT, audit + "I")
                if stays:
                    yield (i + 1, after), (cost + extra + REROLE, audit + "R")
            if stays and initials[i] == initial:
                yield (i + 1, after), (cost + extra, audit + "K")

    final = lightest([((0, entry), (0, ""))], deduce, {(n, s) for s in range(STATES)})
    return {s: final[n, s] for s in range(STATES) if (n, s) in final}


def _cut(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[tuple[object, bool, list]]:
    """(conversation, whether it may have begun before, rows) of a sorted partition, in blocks of rows."""
    nothing = object()
    conv, rows, before = nothing, [], True
    for batch in batches:
        for r in zip(*(batch.column(c).to_pylist() for c in ("conv", "place", "initial", "fault"))):
            if conv is not nothing and (r[0] != conv or len(rows) == most):
                yield conv, before, rows
                before, rows = r[0] == conv, []
            conv = r[0]
            rows.append(r[1:])
    if rows:
        yield conv, before, rows


def _blocks(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType, names: list[str], most: int) -> Iterator[pa.RecordBatch]:
    kinds = [conv_type, pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.string()),
             pa.list_(pa.string()), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
    out = []
    for conv, before, rows in _cut(batches, most):
        places, initials, faults = map(list, zip(*rows))
        found = {e: edits(initials, faults, e) for e in (range(STATES) if before else (START,))}
        pieces = [found.get(p, {}).get(q, (None, None)) for p in range(STATES) for q in range(STATES)]
        order = {a: k for k, a in enumerate(sorted({a for _, a in pieces if a is not None}))}
        illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:]))
        out.append((conv, places[0], places, [c for c, _ in pieces], [order.get(a) for _, a in pieces], [a for _, a in pieces],
                    initials, illegal, *(faults.count(f) for f in (BLANK, DUPLICATE, CUT))))
        if len(out) == 200:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
            out = []
    if out:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)


def _chain(blocks: Iterator[tuple]) -> Iterator[tuple]:
    """(place, entry, leave, closing, cost, illegal) of one conversation's blocks; the last row has the sums.

    ``blocks``: (place, costs, ranks, first initial, last initial, illegal).
    """
    now = {START: (0, 0)}  # state -> (cost, rank of the edits so far)
    back, illegal, last = [], 0, None
    for place, costs, ranks, first, final, inside in blocks:
        illegal += inside + (last is not None and last + first not in LEGAL)
        last = final
        best: dict[int, tuple] = {}
        for p, (cost, rank) in now.items():
            for q in range(STATES):
                c = costs[p * STATES + q]
                if c is not None:
                    offer = (cost + c, (rank, ranks[p * STATES + q]), p)
                    if q not in best or offer < best[q]:
                        best[q] = offer
        order = {k: n for n, k in enumerate(sorted({key for _, key, _ in best.values()}))}
        now = {q: (cost, order[key]) for q, (cost, key, _) in best.items()}
        back.append((place, {q: p for q, (_, _, p) in best.items()}))
    cost, _, closing, state = min((cost + INSERT * len(CLOSING[q]), rank, CLOSING[q], q) for q, (cost, rank) in now.items())
    for k in range(len(back) - 1, -1, -1):
        place, came = back[k]
        ends = k == len(back) - 1
        yield place, came[state], state, closing if ends else "", cost if ends else None, illegal if ends else None
        state = came[state]


def _groups(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[object, Iterator[tuple]]]:
    """(conversation, its rows) of a sorted partition; the rows of one come as a stream."""
    def flat() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(batch.column("conv").to_pylist(), zip(*(batch.column(c).to_pylist() for c in columns)))

    rows = flat()
    ahead = next(rows, None)
    while ahead is not None:
        conv = ahead[0]

        def own() -> Iterator[tuple]:
            nonlocal ahead
            while ahead is not None and ahead[0] == conv:
                row, ahead = ahead[1], next(rows, None)
                yield row

        stream = own()
        yield conv, stream
        for _ in stream:
            pass


def _steps(rows: Iterable[tuple]) -> Iterator[tuple]:
    """(place, nth, edit, given role) of blocks (places, edits, state before, initials); no role is given to a kept row."""
    for places, audit, state, initials in rows:
        at = 0
        for nth, edit in enumerate(audit):
            k = min(at, len(places) - 1)  # closing turns come after the last row
            role = None
            if edit == "K":
                state = dict(NEXT[state])[initials[k]]
            elif edit != "D":
                role, state = next((ROLES[r], s) for r, s in NEXT[state] if r in ROLES)
            yield places[k], nth, edit, role
            at += edit != "I"


def _ordered(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, place): place numbers the rows in the order of conversations and turns."""
    space = F.lit(" ")
    rows = df.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), space).alias("role"),
                     F.coalesce(F.col(text_col), space).alias("text"))
    # A row's place of origin parts equal rows, so that even one repeated row spreads over partitions.
    rows = checkpoint(rows.withColumn("at", F.monotonically_increasing_id()))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.xxhash64("text"), F.col("at")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    return checkpoint(rows.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("place")))


def _fault(text: Column, first: Column) -> Column:
    cut = ~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")
    return F.when(~text.rlike(NOT_BLANK), BLANK).when(first.isNull(), DUPLICATE).when(cut, CUT).otherwise(NONE)


def repair(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """(the edits, one row per conversation).

    Edits: (conv, place, nth, edit, role, text) in the order of place and nth: K(ept) and
    R(eroled) rows with their role and text, I(nserted) ones with an empty text, D(eleted)
    ones with the role and text that go.  Conversations: (conv, gaps, blank, duplicate,
    truncated, illegal, cost).
    """
    rows = _ordered(df, conv_col, turn_col, role_col, text_col)
    # The first of equal rows, by groups that combine before they are shuffled; joined by place, which has no hot key.
    firsts = rows.groupBy("conv", "role", F.sha2("text", 256)).agg(F.min("place").alias("first")).select("first")
    slim = rows.join(firsts, rows["place"] == firsts["first"], "left").select(
        "conv", "turn", "place", F.substring("role", 1, 1).alias("initial"), _fault(F.col("text"), F.col("first")).alias("fault"))
    slim = checkpoint(slim)
    conv, most = rows.schema["conv"].dataType, BLOCK
    ddl, conv_type = conv.simpleString(), to_arrow_type(conv)
    names = ["conv", "place", "places", "costs", "ranks", "audits", "initials", "illegal", "blank", "duplicate", "truncated"]
    # Agendas cost more than rows weigh: a given number of partitions isn't coalesced by size.
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = checkpoint(slim.repartitionByRange(tasks, "place").sortWithinPartitions("place").mapInArrow(
        lambda b: _blocks(b, conv_type, names, most),
        f"conv {ddl}, place long, places array<long>, costs array<long>, ranks array<int>, audits array<string>, initials array<string>, "
        "illegal long, blank long, duplicate long, truncated long"))

    def chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [conv_type, pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64()]
        out = []
        for conv, own in _groups(batches, ["place", "costs", "ranks", "first", "last", "illegal"]):
            for row in _chain(own):
                out.append((conv, *row))
                if len(out) == 2000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], picked)
                    out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], picked)

    picked = ["conv", "at", "entry", "leave", "closing", "cost", "illegal"]
    chosen = checkpoint(blocks.select("conv", "place", "costs", "ranks", F.element_at("initials", 1).alias("first"),
                                                 F.element_at("initials", -1).alias("last"), "illegal").repartition("conv")
                        .sortWithinPartitions("conv", "place")
                        .mapInArrow(chain, f"conv {ddl}, at long, entry int, leave int, closing string, cost long, illegal long"))
    path = F.concat(F.element_at("audits", F.col("entry") * STATES + F.col("leave") + 1), F.col("closing"))
    taken = blocks.join(chosen.select("at", "entry", "leave", "closing"), blocks["place"] == F.col("at")).select(
        "places", path.alias("audit"), "entry", "initials")
    sums = blocks.groupBy("conv").agg(*[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
    turns = slim.groupBy("conv").agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long").alias("gaps"))
    costs = chosen.where(F.col("cost").isNotNull()).select("conv", "cost", "illegal")
    whole = (costs.unionByName(sums, allowMissingColumns=True).unionByName(turns, allowMissingColumns=True)
             .groupBy("conv").agg(*[F.max(c).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]))
    return _written(taken, rows), whole


def _written(taken: DataFrame, rows: DataFrame) -> DataFrame:
    """The edits of every block, with the rows that they are about."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = list(_steps(zip(*(batch.column(c).to_pylist() for c in ("places", "audit", "entry", "initials")))))
            for at in range(0, len(out), 20000):
                part = list(zip(*out[at:at + 20000]))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(part, (pa.int64(), pa.int32(), pa.string(), pa.string()))],
                                                 ["at", "nth", "edit", "given"])

    steps = taken.mapInArrow(run, "at long, nth int, edit string, given string")
    own = rows.select("conv", "place", "role", "text")
    inserted = F.col("edit") == "I"
    return steps.join(own, steps["at"] == own["place"]).select(
        "conv", "place", "nth", "edit", F.coalesce("given", "role").alias("role"), F.when(inserted, F.lit("")).otherwise(F.col("text")).alias("text"))


def damaged(df: DataFrame) -> DataFrame:
    """``conversations`` with faults put in by the checksum of conversation and turn."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = df.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                     (F.crc32(F.encode(key, "utf-8")) % 20).alias("m")).where("m <> 0")
    text = (F.when(F.col("m") == 1, F.lit("")).when(F.col("m") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    role = F.when(F.col("m") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.when(F.col("m") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy")).drop("copy")


def digests(steps: DataFrame) -> DataFrame:
    """(conv, audit, repaired_sha256): one checksum runs over all turns of a conversation, so one task reads them in turn."""
    conv = steps.schema["conv"].dataType
    ddl, conv_type = conv.simpleString(), to_arrow_type(conv)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for conv, own in _groups(batches, ["edit", "role", "text"]):
            sha, audit, begun = hashlib.sha256(), [], False
            for edit, role, text in own:
                audit.append(edit)
                if edit != "D":
                    sha.update((("\n" if begun else "") + f"{role}:{text}").encode())
                    begun = True
            out.append((conv, "".join(audit), sha.hexdigest()))
            if len(out) == 2000:
                yield batch(out)
                out = []
        if out:
            yield batch(out)

    def batch(out: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (conv_type, pa.string(), pa.string()))], names)

    names = ["conv", "audit", "repaired_sha256"]
    slim = steps.withColumn("text", F.when(F.col("edit") != "D", F.col("text")))
    return slim.repartition("conv").sortWithinPartitions("conv", "place", "nth").mapInArrow(run, f"conv {ddl}, audit string, repaired_sha256 string")


def op12_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation of the damaged table: its faults, the cheapest repair and the repaired text's checksum."""
    rows = table(spark, sf_dir, "conversations")
    steps, whole = repair(damaged(rows), "conv_id", "turn", "role", "text")
    parts = whole.unionByName(digests(steps), allowMissingColumns=True)
    parts = parts.unionByName(rows.select(F.col("conv_id").alias("conv")).distinct(), allowMissingColumns=True)
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return parts.groupBy(F.col("conv").alias("conv_id")).agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("long").alias(c) for c in counts],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"))
