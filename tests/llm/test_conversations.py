"""Conversation repair against a plain search over all edits, and on odd rows."""

import hashlib
import itertools
import random
import re
import zlib

import pytest

from tapeworks.llm import conversations as C

SCHEMA = "conv_id long, turn long, role string, text string"
WS = " \t\n\x0b\x0c\r"


def brute_repair(rows):
    """(cost, audit, lines) of the cheapest edits: every state keeps its best (cost, audit, lines)."""
    best = {0: (0, "", ())}
    allowed = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    name = {"u": "user", "a": "assistant"}

    def inserted(found):
        out = dict(found)
        for _ in range(4):  # more inserts than can ever help
            for p, (cost, audit, lines) in list(out.items()):
                for c in "ua":
                    if p in allowed[c]:
                        new = (cost + 2, audit + "I", (*lines, name[c] + ":"))
                        q = allowed[c][p]
                        if q not in out or new[:2] < out[q][:2]:
                            out[q] = new
        return out

    for role, text, fault in rows:
        nxt = {}
        for p, (cost, audit, lines) in inserted(best).items():
            ways = [(p, cost + 3, "D", lines)]
            if fault not in ("blank", "duplicate"):
                more = fault == "truncated"
                if role[:1] and p in allowed.get(role[:1], {}):
                    ways.append((allowed[role[0]][p], cost + more, "K", (*lines, f"{role}:{text}")))
                ways += [(allowed[c][p], cost + 2 + more, "R", (*lines, f"{name[c]}:{text}")) for c in "ua" if p in allowed[c]]
            for q, cost2, edit, lines2 in ways:
                new = (cost2, audit + edit, lines2)
                if q not in nxt or new[:2] < nxt[q][:2]:
                    nxt[q] = new
        best = nxt
    ends = inserted(best)
    return min((ends[p] for p in (0, 3) if p in ends), key=lambda x: x[:2])


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = text.strip(WS)
        if not solid:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append(None if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def brute_query(table):
    """The whole contract, row by row."""
    space = lambda x: " " if x is None else x
    found = {}
    for conv, turn, role, text in table:
        own = found.setdefault(conv, [])
        role, text = space(role), space(text)
        fate = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        own += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    out = []
    for conv, own in found.items():
        own.sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2][:32], hashlib.md5(f"{x[1]}\0{x[2]}".encode()).digest()))
        kinds = faults([x[1:] for x in own])
        turns = {x[0] for x in own if x[0] is not None}
        cost, audit, lines = brute_repair([(r, t, f) for (_, r, t), f in zip(own, kinds)])
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, kinds.count("blank"), kinds.count("duplicate"),
                    kinds.count("truncated"), sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:])),
                    cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def random_rows(rng, n):
    return [(rng.choice(["system", "user", "user", "assistant", "assistant", "tool", "", "sage"]), rng.choice(["a.", "b.", "c", "", "d!"]) + str(k % 3) * rng.randint(0, 1)) for k in range(n)]


def test_least_edits_are_those_of_all_regular_edits():
    """The brute force itself, against every edit sequence of a few rows."""
    rng = random.Random(3)
    for _ in range(40):
        rows = random_rows(rng, rng.randint(0, 2))
        rows = [(r, t, f) for (r, t), f in zip(rows, faults(rows))]
        best = None
        choices = [[(ins, op) for k in range(3) for ins in itertools.product("ua", repeat=k) for op in "DKua"] for _ in rows]
        for way in itertools.product(*choices):
            for k in range(3):
                for tail in itertools.product("ua", repeat=k):
                    cost, audit, letters = 0, "", ""
                    for (role, _, fault), (ins, op) in zip(rows, way):
                        cost += 2 * len(ins) + {"D": 3, "K": 0}.get(op, 2) + (op != "D" and fault == "truncated")
                        audit += "I" * len(ins) + (op if op in "DK" else "R")
                        letters += "".join(ins) + ({"D": "", "K": role[:1] or "?"}.get(op, op))
                        if op != "D" and fault in ("blank", "duplicate"):
                            cost = 10**9
                    cost, audit, letters = cost + 2 * k, audit + "I" * k, letters + "".join(tail)
                    if cost < 10**9 and re.fullmatch("(s?(ua)+)?", letters):
                        best = min(best or (cost, audit), (cost, audit))
        assert brute_repair(rows)[:2] == best


def test_halves_meet_on_the_same_edits():
    rng = random.Random(4)
    for n in (1, 2, 3, 7, 20, 65):
        for _ in range(30):
            rows = random_rows(rng, n)
            kinds = [C.row_kind(r[:1], f) for (r, _), f in zip(rows, faults(rows))]
            total, costs, ranks = C.forward(kinds, C.START, C.advance_row)
            end = C.best_end(costs, ranks)
            ways = C.crossings(kinds, C.START, end, C.advance_row, C.retreat_row)
            audit = "".join(C.steps(k)[w][1] for k, w in zip(kinds, ways)) + "I" * len(C.TAIL[end])
            expected = brute_repair([(r, t, f) for (r, t), f in zip(rows, faults(rows))])
            assert (total + costs[end] + C.END_COSTS[end], audit) == expected[:2]


@pytest.fixture(scope="module")
def table():
    rng = random.Random(5)
    rows = [(c, t, *x) for c in range(60) for t, x in enumerate(random_rows(rng, rng.randint(1, 9)))]
    rows += [(900, t, "user" if t % 2 else "assistant", f"line {t % 40}" + "." * (t % 3 > 0)) for t in range(700)]  # a hot one
    rows += [(901, 5, "user", "the same.")] * 300 + [(902, None, "user", f"x{k}.") for k in range(40)]
    rows += [(None, 1, "user", "hi."), (None, 2, None, None), (None, None, None, "no role."), (None, 9, "assistant", " \t\n"),
             (903, 1, "system", "é" * 40_000), (903, 2, "user", "ü. " * 20_000), (904, None, None, None), (905, 3, "", "empty role!"),
             (-1, 2**40, "user", "far"), (-1, -5, "assistant", "near?"), (-1, 2**40, "user", "far")]
    return rows


@pytest.mark.parametrize("per_task", [C.ROWS_PER_TASK, 40])  # 40: conversations cross many tasks
def test_repair_matches_brute_force(spark, table, per_task, monkeypatch):
    monkeypatch.setattr(C.repair, "__defaults__", (per_task,))
    df = spark.createDataFrame(table, SCHEMA)
    got = C.repaired_conversations(df).collect()
    assert sorted(map(tuple, got), key=str) == brute_query(table)


def test_repaired_roles_are_regular(spark, table):
    rows = C.repair(spark.createDataFrame(table, SCHEMA), 50).collect()
    by = {}
    for r in sorted(rows, key=lambda r: r.at):
        by[r.conv_id] = by.get(r.conv_id, "") + r.before + r.now + r.after
    assert len(rows) == len(table) and all(re.fullmatch("(s?(ua)+)?", x) for x in by.values())


def test_empty_and_clashing(spark):
    assert C.repaired_conversations(spark.createDataFrame([], SCHEMA)).count() == 0
    own = SCHEMA + ", at string, key int, head int, part string, cost string, first int, fault string, number int"
    df = spark.createDataFrame([(1, 1, "user", "a.", "x", 1, 2, "p", "c", 3, "f", 4)], own)
    assert tuple(C.repaired_conversations(df).first())[0] == 1
    gone = next(k for k in range(1000) if zlib.crc32(f"{k}:1".encode()) % 20 == 0)
    row = C.repaired_conversations(spark.createDataFrame([(gone, 1, "user", "a.")], SCHEMA)).first()
    assert tuple(row) == (gone, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
