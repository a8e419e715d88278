"""Conversation structure repair by divide and conquer over four states.

A conversation is its rows by turn (null turns first; rows of one turn by role,
the text's first 32 characters and the text's hash).  Edits turn it into one
whose roles' first letters read ``(s?(ua)+)?``: keep a row (cost 0), give it the
role user or assistant (2), delete it (3; blank and duplicate rows must go),
insert an empty row of user or assistant anywhere (2).  A truncated row that
stays costs 1 more.  The cheapest edits win, among equals the one whose initials
(Keep, Rerole, Delete, Insert) are least in ASCII order, so the result is unique.

After every row the roles so far are in one of four states: nothing yet, after
a system row, after user, after assistant.  A step is a row's edit with the
inserts before it.

1. *Place.*  Rows are range-partitioned by conversation and order, so a
   conversation of any size is spread over tasks; ``at`` is a row's place.  Equal
   rows are split too: their order makes no difference.
2. *Faults.*  Blank and truncated rows by pattern; duplicates by the least
   ``at`` per conversation, role and text, joined back by ``at``.
3. *Segments.*  A task's stretch of a conversation becomes a 4 x 4 table: the
   least cost from each state to each, and the ASCII order of the best edits.
   Edits up to a row never begin one another (each ends with the row's own
   edit), so the order of two strings is settled by their first parts: ranks of
   the four states are all that is carried.
4. *Crossings.*  Hirschberg's scheme, first over the segments of a conversation,
   then over the rows of each segment on its own: forward costs and ranks of
   the left half meet backward costs of the right half, the crossing state of
   least sum and then of least rank is taken, and both halves recurse.  Costs
   are kept relative to their least, so steps are table lookups.  Space is
   linear in the stretch.

Nulls and edge cases: null roles and texts are one space (such a role can only
be changed).  A null conv_id is a conversation.  An empty role has no initial.
Repeated rows are duplicates.  Texts never enter the search, so their length
does not matter.  An empty table gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import cache
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeworks.llm.shared import spread, stored

ROWS_PER_TASK = 50_000
SEGMENTS_PER_TASK = 20_000
SPACE = r"\x20\x09-\x0D"

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
NEVER = 1 << 40
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
# The state after a row with this initial, from each state that allows one.
NEXT = {"s": {START: SYSTEM}, "u": {START: USER, SYSTEM: USER, ASSISTANT: USER}, "a": {USER: ASSISTANT}}
# The fewest inserts between two states; from states that may not end, to the end.
INSERTS = {(p, p): "" for p in STATES} | {
    (START, USER): "u", (SYSTEM, USER): "u", (ASSISTANT, USER): "u", (USER, ASSISTANT): "a",
    (START, ASSISTANT): "ua", (SYSTEM, ASSISTANT): "ua"}
TAIL = {START: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}
END_COSTS = tuple(INSERT * len(TAIL[p]) for p in STATES)
#: What the search knows of a row: its initial if it can be kept or changed, and whether it is truncated.
DELETE_ONLY = "-"

Costs = tuple[int, ...]


def row_kind(initial: str, fault: str | None) -> str:
    if fault in ("blank", "duplicate"):
        return DELETE_ONLY
    return (initial if initial in NEXT else "?") + ("t" if fault == "truncated" else "")


@cache
def steps(kind: str) -> dict[tuple[int, int], tuple[int, str, str, str]]:
    """(from, to) -> (cost, edits, roles inserted, role of the row) of a row of this kind."""
    best: dict[tuple[int, int], tuple[int, str, str, str]] = {}
    for (p, q), added in INSERTS.items():
        options = [(DELETE, "D", "", q)]
        if kind != DELETE_ONLY:
            extra = TRUNCATED * kind.endswith("t")
            if q in NEXT.get(kind[0], {}):
                options.append((KEEP + extra, "K", kind[0], NEXT[kind[0]][q]))
            options += [(REROLE + extra, "R", role, NEXT[role][q]) for role in "ua" if q in NEXT[role]]
        for cost, edit, role, r in options:
            found = (INSERT * len(added) + cost, "I" * len(added) + edit, added, role)
            best[p, r] = min(best.get((p, r), found), found)
    return best


def relative(costs: list[int]) -> tuple[int, Costs]:
    low = min(costs)
    return low, tuple(min(c - low, NEVER) for c in costs)


def advance(costs: Costs, ranks: Costs, table: dict[tuple[int, int], tuple]) -> tuple[int, Costs, Costs]:
    """Least, relative costs and ranks of the states behind a step.  ``table``:
    (from, to) -> (cost, order of its edits among those of the same start, ...)."""
    found = []
    for r in STATES:
        ways = [(costs[p] + table[p, r][0], ranks[p], table[p, r][1]) for p in STATES if (p, r) in table and costs[p] < NEVER]
        found.append(min(ways, default=(NEVER, NEVER, "")))
    order = sorted(STATES, key=lambda r: (found[r][0] >= NEVER, *found[r][1:]))
    low, out = relative([x[0] for x in found])
    return low, out, tuple(order.index(r) for r in STATES)


def retreat(costs: Costs, table: dict[tuple[int, int], tuple]) -> tuple[int, Costs]:
    """Least and relative costs of what follows, seen from before a step."""
    return relative([min((table[p, r][0] + costs[r] for r in STATES if (p, r) in table), default=NEVER) for p in STATES])


@cache
def advance_row(costs: Costs, ranks: Costs, kind: str) -> tuple[int, Costs, Costs]:
    return advance(costs, ranks, steps(kind))


@cache
def retreat_row(costs: Costs, kind: str) -> tuple[int, Costs]:
    return retreat(costs, steps(kind))


def only(state: int) -> Costs:
    return tuple(0 if p == state else NEVER for p in STATES)


def forward(items: list, enter: int, step: Callable) -> tuple[int, Costs, Costs]:
    total, costs, ranks = 0, only(enter), (0, 1, 2, 3)
    for x in items:
        low, costs, ranks = step(costs, ranks, x)
        total += low
    return total, costs, ranks


def backward(items: list, costs: Costs, step: Callable) -> Costs:
    for x in reversed(items):
        _, costs = step(costs, x)
    return costs


def crossings(items: list, enter: int, leave: int, ahead: Callable, back: Callable) -> Iterator[tuple[int, int]]:
    """(state before, state after) of every item on the best way from ``enter`` to ``leave``."""
    if len(items) == 1:
        yield enter, leave
        return
    half = len(items) // 2
    _, before, ranks = forward(items[:half], enter, ahead)
    after = backward(items[half:], only(leave), back)
    meet = min(STATES, key=lambda s: (before[s] + after[s], ranks[s]))
    yield from crossings(items[:half], enter, meet, ahead, back)
    yield from crossings(items[half:], meet, leave, ahead, back)


def best_end(costs: Costs, ranks: Costs) -> int:
    """The state after the last row from which inserts end the conversation best."""
    return min(STATES, key=lambda s: (costs[s] + END_COSTS[s], ranks[s]))


def stretches(conv: list) -> Iterator[tuple[object, int, int]]:
    """(conversation, first, end) of its rows in a task's rows."""
    low = 0
    for name, rows in groupby(conv):
        high = low + sum(1 for _ in rows)
        yield name, low, high
        low = high


def summarise(table: pa.Table) -> pa.Table:
    """One row per stretch: its 4 x 4 costs and ranks."""
    table = table.sort_by("at")
    kinds, found = table.column("kind").to_pylist(), []
    for name, low, high in stretches(table.column("conv_id").to_pylist()):
        costs, ranks = [], []
        for p in STATES:
            least, c, r = forward(kinds[low:high], p, advance_row)
            costs += [min(least + x, NEVER) for x in c]
            ranks += r
        found.append((name, costs, ranks))
    names, costs, ranks = zip(*found)
    part = table.column("part")[0].as_py()
    return pa.table({"conv_id": pa.array(names, table.schema.field("conv_id").type), "part": pa.array([part] * len(names), pa.int64()),
                     "costs": pa.array(costs, pa.list_(pa.int64())), "ranks": pa.array(ranks, pa.list_(pa.int64()))})


def meet_segments(table: pa.Table) -> pa.Table:
    """The states at the bounds of every segment, and the roles inserted at a conversation's end."""
    table = table.sort_by([("conv_id", "ascending"), ("part", "ascending")])
    conv = table.column("conv_id").to_pylist()
    segments = [{(p, r): (c[4 * p + r], k[4 * p + r]) for p in STATES for r in STATES if c[4 * p + r] < NEVER}
                for c, k in zip(table.column("costs").to_pylist(), table.column("ranks").to_pylist())]
    enter, leave, tail, cost = [], [], [], []
    for _, low, high in stretches(conv):
        total, costs, ranks = forward(segments[low:high], START, advance)
        end = best_end(costs, ranks)
        ways = list(crossings(segments[low:high], START, end, advance, retreat))
        enter += [p for p, _ in ways]
        leave += [r for _, r in ways]
        tail += [""] * (high - low - 1) + [TAIL[end]]
        cost += [total + costs[end] + END_COSTS[end]] * (high - low)
    return pa.table({"conv_id": table.column("conv_id"), "part": table.column("part"), "enter": pa.array(enter, pa.int64()),
                     "leave": pa.array(leave, pa.int64()), "tail": pa.array(tail, pa.string()), "cost": pa.array(cost, pa.int64())})


def solve(rows: pa.Table, bounds: pa.Table) -> pa.Table:
    """The edits of every row of a task's stretches."""
    rows = rows.sort_by("at")
    kinds, out = rows.column("kind").to_pylist(), []
    known = {x["conv_id"]: x for x in bounds.to_pylist()}
    for name, low, high in stretches(rows.column("conv_id").to_pylist()):
        to = known[name]
        own = kinds[low:high]
        for kind, way in zip(own, crossings(own, to["enter"], to["leave"], advance_row, retreat_row)):
            _, edits, added, role = steps(kind)[way]
            out.append([edits, added, role, "", to["cost"]])
        out[-1][0] += "I" * len(to["tail"])
        out[-1][3] = to["tail"]
    edits, added, role, after, cost = zip(*out)
    return pa.table({"at": rows.column("at"), "edits": pa.array(edits, pa.string()), "before": pa.array(added, pa.string()),
                     "now": pa.array(role, pa.string()), "after": pa.array(after, pa.string()), "cost": pa.array(cost, pa.int64())})


def repair(turns: DataFrame, per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Every row of ``turns`` (conv_id, turn, role, text) with its place ``at``,
    its ``fault`` (blank, duplicate, truncated or null), its ``edits``, the
    initials of the roles inserted ``before`` and ``after`` it, ``now`` the
    initial it has itself ('' if deleted), and its conversation's ``cost``."""
    conv = dict(turns.dtypes)["conv_id"]
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    own = F.substring("text", 1, 32).alias("head"), F.unhex(F.md5(F.concat_ws("\0", "role", "text"))).alias("key")
    order = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "head", "key", "number"]
    tasks = spread(rows.count(), per_task)
    placed = stored(rows.select("*", *own, F.monotonically_increasing_id().alias("number"))
                    .repartitionByRange(tasks, *order).sortWithinPartitions(*order)
                    .withColumn("at", F.monotonically_increasing_id()).drop("head", "number"), "turns")
    blank = ~F.col("text").rlike(f"[^{SPACE}]")
    first = placed.where(~blank).groupBy("conv_id", "key").agg(F.min("at").alias("at")).select("at", F.lit(True).alias("first"))
    fault = (F.when(blank, "blank").when(F.col("first").isNull(), "duplicate")
             .when(~F.col("text").rlike(rf"[.!?][{SPACE}]*\z"), "truncated"))
    initial = F.substring("role", 1, 1)
    kind = (F.when(F.col("fault").isin("blank", "duplicate"), F.lit(DELETE_ONLY))
            .otherwise(F.concat(F.when(initial.isin(*NEXT), initial).otherwise("?"),
                                F.when(F.col("fault") == "truncated", "t").otherwise(""))))
    known = stored(placed.join(first, "at", "left").select("conv_id", "at", F.shiftright("at", 33).alias("part"), fault.alias("fault"), "role")
                   .withColumn("kind", kind).drop("role"), "faults")
    search = known.select("conv_id", "at", "part", "kind")
    segments = stored(search.groupBy("part").applyInArrow(
        summarise, f"conv_id {conv}, part long, costs array<long>, ranks array<long>"), "segments")
    group = F.pmod(F.xxhash64("conv_id"), F.lit(spread(segments.count(), SEGMENTS_PER_TASK)))
    bounds = segments.groupBy(group).applyInArrow(
        lambda key, table: meet_segments(table), f"conv_id {conv}, part long, enter long, leave long, tail string, cost long")
    solved = search.groupBy("part").cogroup(bounds.groupBy("part")).applyInArrow(
        solve, "at long, edits string, before string, now string, after string, cost long")
    return placed.drop("key").join(known.select("at", "fault"), "at").join(solved, "at")


def names(initials: Column) -> Column:
    return F.transform(F.filter(F.split(initials, ""), lambda x: x != ""), lambda x: F.concat(role_name(x), F.lit(":")))


def role_name(initial: Column) -> Column:
    return F.when(initial == "u", "user").when(initial == "a", "assistant")


def repaired_lines(rows: DataFrame) -> Column:
    """``role:text`` of the rows that stand in a row's place, null if none."""
    edit = F.regexp_extract("edits", "[KRD]", 0)
    role = F.when(edit == "K", F.col("role")).otherwise(role_name(F.col("now")))
    own = F.when(edit == "D", F.array().cast("array<string>")).otherwise(F.array(F.concat(role, F.lit(":"), F.col("text"))))
    lines = F.concat(names(F.col("before")), own, names(F.col("after")))
    return F.when(F.size(lines) > 0, F.array_join(lines, "\n"))


def digest(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``repair``'s rows: counts, audit, and the hash
    of the repaired text.  A hash is read in order, so each conversation's rows
    stream through one task, sorted there; nothing of them is held but the audit."""
    conv = dict(rows.dtypes)["conv_id"]
    kind = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, found, open_ = None, [], False

        def closed() -> tuple:
            turns = now["turns"]
            gaps = turns[1] - turns[0] + 1 - turns[2] if turns else 0
            faults = now["faults"]
            return (now["conv"], gaps, faults.get("blank", 0), faults.get("duplicate", 0), faults.get("truncated", 0), now["illegal"],
                    now["cost"], "".join(now["audit"]), now["hash"].hexdigest())

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            own = zip(*done) if done else [[] for _ in schema]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(own, schema)], schema=schema)

        schema = None
        for batch in batches:
            if schema is None:
                schema = pa.schema([batch.schema.field("conv_id"), *((c.split()[0], pa.int64() if c.endswith("long") else pa.string())
                                                                     for c in kind.split(", "))])
            for x in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "turn", "initial", "fault", "edits", "line", "cost"))):
                conv_id, turn, initial, fault, edits, line, cost = x
                if not open_ or conv_id != now["conv"]:
                    if open_:
                        found.append(closed())
                    now, open_ = {"conv": conv_id, "turns": None, "faults": {}, "illegal": 0, "audit": [], "cost": cost, "lines": 0,
                                  "hash": hashlib.sha256()}, True
                else:
                    now["illegal"] += now["last"] + initial not in ("su", "ua", "au")
                if turn is not None:
                    low, high, count = now["turns"] or (turn, None, 0)
                    now["turns"] = low, turn, count + (turn != high)
                now["last"] = initial
                now["faults"][fault] = now["faults"].get(fault, 0) + 1
                now["audit"].append(edits)
                if line is not None:
                    now["hash"].update(("\n" if now["lines"] else "").encode() + line.encode())
                    now["lines"] += 1
            if len(found) > 10_000:
                yield batch_of(found)
                found = []
        if open_:
            found.append(closed())
            yield batch_of(found)

    return (rows.select("conv_id", "at", "turn", F.substring("role", 1, 1).alias("initial"), "fault", "edits",
                        repaired_lines(rows).alias("line"), "cost")
            .repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "at")
            .mapInArrow(stream, f"conv_id {conv}, {kind}"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of ``conversations`` after seeded faults, by the hash of ``conv_id:turn`` modulo 20."""
    blank = F.lit(" ")
    fate = F.pmod(F.crc32(F.concat(F.coalesce(F.col("conv_id").cast("string"), blank), F.lit(":"),
                                   F.coalesce(F.col("turn").cast("string"), blank))), F.lit(20))
    role, text = F.coalesce("role", blank), F.coalesce("text", blank)
    return (turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), fate.alias("fate")).where("fate <> 0")
            .select("conv_id", "turn", F.when(F.col("fate") == 4, "user").otherwise(F.col("role")).alias("role"),
                    F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
                    F.explode(F.when(F.col("fate") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("again"))
            .drop("again"))


def repaired_conversations(turns: DataFrame) -> DataFrame:
    """Every original conv_id with the digest of its damaged and repaired rows."""
    found = digest(repair(damaged(turns))).withColumnRenamed("conv_id", "own_id")
    ids = turns.select("conv_id").distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(found, F.col("conv_id").eqNullSafe(F.col("own_id")), "left").select(
        "conv_id", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
