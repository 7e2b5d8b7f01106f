"""Repair of conversations against plain versions: all edit strings of short rows, and a DP over whole strings."""

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from conftest import SF_SMALL
from postlake.llm import audit as au

GRAMMAR = re.compile(r"(s?(ua)+)?\Z")
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def play(light, edits):
    """(roles, cost) of an edit string over rows (initial, must go, truncated), or None where it doesn't fit."""
    out, cost, at = "", 0, 0
    for e in edits:
        if out[-1:] not in NEXT:
            return None
        if e == "I":
            out, cost = out + NEXT[out[-1:]], cost + 2
            continue
        if at == len(light):
            return None
        initial, must_go, cut = light[at]
        at += 1
        if e == "D":
            cost += 3
            continue
        if must_go:
            return None
        cost += cut
        if e == "R":
            out, cost = out + NEXT[out[-1:]], cost + 2
        else:
            out += initial
    return (out, cost) if at == len(light) and GRAMMAR.match(out) else None


def every(light):
    """The cheapest, then ASCII-least, of all edit strings."""
    best = None
    for n in range(len(light), 2 * len(light) + 3):
        for edits in itertools.product("DIKR", repeat=n):
            if (done := play(light, edits)) is not None:
                best = min(best or (99, ""), (done[1], "".join(edits)))
    return best


def strings(light):
    """The same by a DP that holds whole strings."""
    step = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def inserts(cells):
        for _ in range(4):
            for state, (cost, text) in list(cells.items()):
                to = NEXT[state]
                cells[to] = min(cells.get(to, (10**9, "")), (cost + 2, text + "I"))
        return cells

    cells = inserts({"": (0, "")})
    for initial, must_go, cut in light:
        new = {}
        for state, (cost, text) in cells.items():
            moves = [(state, 3, "D")]
            if not must_go:
                moves.append((NEXT[state], 2 + cut, "R"))
                if (state, initial) in step:
                    moves.append((step[state, initial], cut, "K"))
            for to, add, e in moves:
                new[to] = min(new.get(to, (10**9, "")), (cost + add, text + e))
        cells = inserts(new)
    return min(cells[s] for s in ("", "a") if s in cells)


def plain(rows):
    """op11 of original rows (conv_id, turn, role, text), by conversation."""
    space = lambda v: " " if v is None else str(v)
    conv = defaultdict(list)
    for c, t, role, text in rows:
        role, text = space(role), space(text)
        conv[c]  # noqa: B018
        key = zlib.crc32(f"{space(c)}:{space(t)}".encode()) % 20
        if key == 0:
            continue
        text = "" if key == 1 else re.sub("[.!?]", "", text) if key == 2 else text
        role = "user" if key == 4 else role
        conv[c] += [(t, role, text)] * (2 if key == 3 else 1)
    out = {}
    for c, rs in conv.items():
        rs.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
        faults, seen = [], set()
        for _, role, text in rs:
            solid = text.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        initials = [r[1][:1] for r in rs]
        light = [(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults)]
        cost, edits = strings(light)
        turns = [r[0] for r in rs if r[0] is not None]
        left, at, state = [], 0, ""
        for e in edits:
            role, text = (None, "") if e == "I" else rs[at][1:]
            at += e != "I"
            if e == "D":
                continue
            if e in "IR":
                role = {"u": "user", "a": "assistant"}[NEXT[state]]
            state = role[:1]
            left.append(f"{role}:{text}")
        out[c] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
                  sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, edits,
                  hashlib.sha256("\n".join(left).encode()).hexdigest())
    return out


def got(df):
    rows = df.collect()
    found = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in rows}
    assert len(found) == len(rows)
    return found


def random_light(r, n):
    return [(str(r.choice(list("suax"))), bool(r.random() < .2), bool(r.random() < .2)) for _ in range(n)]


def whole(light, run=None):
    run = run or max(1, len(light))
    cuts = [light[k:k + run] for k in range(0, len(light), run)] or [[]]
    tables = [{s: au.run_table(c, s) for s in range(4)} for c in cuts]
    cost, parts = au.join_runs(tables)
    return cost, "".join(parts)


def test_cheapest_edits_are_those_of_all_strings():
    r = np.random.default_rng(0)
    for light in [[], *[[(i, m, c)] for i in "suax" for m in (False, True) for c in (False, True)], *[random_light(r, 2) for _ in range(12)],
                  *[random_light(r, 3) for _ in range(5)]]:
        assert strings(light) == every(light) == whole(light)


@pytest.mark.parametrize("seed", range(4))
def test_linked_nodes_and_runs_match_whole_strings(seed):
    r = np.random.default_rng(seed)
    for _ in range(60):
        light = random_light(r, int(r.integers(0, 70)))
        assert strings(light) == whole(light) == whole(light, 1) == whole(light, 7)
    same = [("u", False, False)] * 400
    assert strings(same) == whole(same) == whole(same, 64)


def test_common_prefix_verifies_hashes(monkeypatch):
    def chain(text):
        node = au.Node(None, "")
        for c in text:
            node = au.Node(node, c)
        return node

    for base in (au._BASE, 0):  # with base 0 the hash is the last initial alone, so almost everything collides
        monkeypatch.setattr(au, "_BASE", base)
        for a, b in [("DIKK", "DIRK"), ("K" * 40, "K" * 25), ("KDKRK", "KRKDK"), ("", "D"), ("D", "DI"), ("KRKR", "KRKR")]:
            x, y = chain(a), chain(b)
            assert x.text() == a and x.at(len(a) // 2).text() == a[:len(a) // 2]
            p, q = au.common_prefix(x, y)
            n = next((k for k in range(min(len(a), len(b))) if a[k] != b[k]), min(len(a), len(b)))
            assert (p.depth, q.depth) == (n, n)
    light = random_light(np.random.default_rng(9), 40)
    assert whole(light) == strings(light)


def test_registered_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(au.op11(spark, SF_SMALL)) == plain(rows)


def awkward():
    r = np.random.default_rng(3)
    rows = [(None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "Ho!"), (3, None, "user", "  "), (4, None, "user", "a.")]
    for c in range(40):
        for t in range(int(r.integers(1, 9))):
            rows.append((100 + c, int(r.integers(0, 7)), str(r.choice(["user", "assistant", "system", "tool", ""])),
                         str(r.choice(["One.", "Two!", "Three", "x " * 400 + "?", "\t\n", "Ünï 漢字.", "One. \x0b"]))))
    rows += [(7, t, "user" if t % 2 else "assistant", f"turn {t % 90}.") for t in range(900)]  # a third of all rows and more
    rows.append((next(c for c in range(1000, 9999) if zlib.crc32(f"{c}:0".encode()) % 20 == 0), 0, "user", "dropped"))
    return rows + rows[5:20]  # rows that repeat


def test_awkward_rows(spark):
    from pyspark.sql import functions as F

    rows = awkward()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)
    df = df.withColumns({c: F.lit("clash") for c in ("pos", "kind", "digest", "cost", "key", "seen", "part")})
    want = plain(rows)
    assert got(au.audit(au.damaged(df))) == want
    assert want[7][5] > 0 and any(v[5:7] == (0, "") for v in want.values())


def test_empty_table(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert au.audit(none).count() == 0 and au.audit(au.damaged(none)).count() == 0
    one = spark.createDataFrame([(1, 0, "assistant", "x.")], none.schema)
    assert [(r.cost, r.audit) for r in au.audit(one).collect()] == [(2, "IK")]
