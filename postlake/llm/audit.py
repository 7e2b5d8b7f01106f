"""Repair of conversations by the cheapest edits, with a persistent audit DP.

Rows are taken in order; after each row the DP holds, for every state of the
role grammar ``(s?(ua)+)?``, the cheapest edits that lead there and, among
equal costs, the ASCII-least string of their initials.  An edit string is a
linked node (initial, parent), so prefixes are shared; a node keeps ancestors
at distances of powers of two and a rolling hash.  Equal costs are settled by
a longest-common-prefix search: both nodes are lifted to one depth, the hashes
of their ancestors are compared from the farthest down, and the initials after
the common prefix decide.  Equal hashes are verified: the ancestors must be
one node, or else their strings are compared.

The DP is a matrix over (cost, string): a run of rows is described by the
best edits from each state to each state, and runs are joined like matrices.
Two candidates of equal cost are never prefixes of each other, as they differ
by inserts, which cost, so joining keeps the ASCII-least string.

Plan: rows are dealt by range of (conversation, turn, role, text digest) and
written once with their place, so that a conversation of any size spans
tasks.  Repeated (role, text) pairs are found by an aggregate over digests
(SHA-256), which combines before the shuffle, and joined back by place, a key
without copies.  Each range is worked through in runs of at most ``_RUN``
rows, without texts.  Runs of a conversation, about four bytes a row, meet in
one task, which picks the audit.  The texts are then hashed in order: a digest
over a whole conversation is sequential by its contract, so one task streams
a conversation's rows, holding its audit and one batch of texts.
"""

from __future__ import annotations

import hashlib
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import parts, table, written

KEEP, REROLE, DELETE, INSERT, CUT = 0, 2, 3, 2, 1
_STATES = 4  # nothing yet, after a system row, after a user row, after an assistant row
_ENDS = (0, 3)
_AFTER = {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}  # the only user or assistant row that may follow
_RUN = 4096
_BASE, _MOD = 1_000_003, (1 << 61) - 1


class Node:
    """An edit string: its last initial and the node of the rest."""

    __slots__ = ("char", "depth", "code", "up")

    def __init__(self, parent: Node | None, char: str):
        self.char = char
        if parent is None:
            self.depth, self.code, self.up = 0, 0, []
            return
        self.depth = parent.depth + 1
        self.code = (parent.code * _BASE + ord(char)) % _MOD
        self.up, node, k = [parent], parent, 0
        while k < len(node.up):  # the ancestor at distance 2**(k+1) lies 2**k above the one at 2**k
            node = node.up[k]
            self.up.append(node)
            k += 1

    def at(self, depth: int) -> Node:
        """The ancestor of a depth."""
        node, far = self, self.depth - depth
        while far:
            k = far.bit_length() - 1
            node = node.up[k]
            far -= 1 << k
        return node

    def text(self, since: Node | None = None) -> str:
        """The initials after the ancestor ``since`` (all, if none is given)."""
        out, node = [], self
        while node.depth and node is not since:
            out.append(node.char)
            node = node.up[0]
        return "".join(reversed(out))


def common_prefix(a: Node, b: Node) -> tuple[Node, Node]:
    """The ancestors of both nodes at the length of their longest common prefix."""
    depth = min(a.depth, b.depth)
    x, y = a.at(depth), b.at(depth)
    if x is y:
        return x, y
    if x.code != y.code:
        for k in range(len(x.up) - 1, -1, -1):  # lift both as long as their strings differ
            if k < len(x.up) and x.up[k].code != y.up[k].code:
                x, y = x.up[k], y.up[k]
        x, y = x.up[0], y.up[0]
    if x is not y:  # equal hashes of different nodes: believe the strings alone
        s, t = x.text(), y.text()
        same = next((k for k in range(len(s)) if s[k] != t[k]), len(s))
        x, y = x.at(same), y.at(same)
    return x, y


def less(a: Node, a_char: str, b: Node, b_char: str) -> bool:
    """Whether a's string and ``a_char`` come before b's and ``b_char`` in ASCII order."""
    if a is b:
        return a_char < b_char
    x, y = common_prefix(a, b)
    after_a = a.at(x.depth + 1).char if a.depth > x.depth else a_char
    after_b = b.at(y.depth + 1).char if b.depth > y.depth else b_char
    if after_a != after_b:
        return after_a < after_b
    return a.depth < b.depth


def _offer(cells: list, state: int, cost: int, parent: Node, char: str) -> bool:
    """Put an edit into a state if it is better; cells hold (cost, parent, initial) until they are settled."""
    held = cells[state]
    if held is not None and (cost > held[0] or cost == held[0] and not less(parent, char, held[1], held[2])):
        return False
    cells[state] = (cost, parent, char)
    return True


def _inserts(cells: list) -> None:
    """Rows inserted at one place; cells become (cost, node)."""
    done: list = [None] * _STATES
    for state, held in enumerate(cells):
        if held is not None:
            done[state] = (held[0], held[1] if held[2] is None else Node(held[1], held[2]))
    for _ in range(_STATES):
        moved = False
        for state, to in _NEXT.items():
            if done[state] is None:
                continue
            cost, node = done[state][0] + INSERT, done[state][1]
            held = done[to]
            if held is None or cost < held[0] or cost == held[0] and held[1].depth and less(
                    node, "I", held[1].up[0], held[1].char):
                done[to] = (cost, Node(node, "I"))
                moved = True
        if not moved:
            break
    cells[:] = done


def run_table(rows: list, start: int) -> list:
    """Per end state the cheapest edits of a run that starts in a state: (cost, initials) or None.

    Rows are (initial of the role, must go, truncated).
    """
    cells: list = [None] * _STATES
    cells[start] = (0, Node(None, ""), None)
    _inserts(cells)
    for initial, must_go, cut in rows:
        new: list = [None] * _STATES
        for state, held in enumerate(cells):
            if held is None:
                continue
            cost, node = held
            _offer(new, state, cost + DELETE, node, "D")
            if must_go:
                continue
            extra = CUT if cut else 0
            to = _AFTER.get(initial, {}).get(state)
            if to is not None:
                _offer(new, to, cost + KEEP + extra, node, "K")
            _offer(new, _NEXT[state], cost + REROLE + extra, node, "R")
        _inserts(new)
        cells = new
    return [None if c is None else (c[0], c[1].text()) for c in cells]


def join_runs(tables: list) -> tuple[int, list[str]]:
    """The cost and the audit of each run, for the runs of one conversation: a list of {start: table} each.

    A candidate is a linked piece (string, parent); equal costs compare the
    pieces after the node both share.
    """
    cells: list = [(0, None), None, None, None]

    def pieces(node):
        out = []
        while node is not None:
            out.append(node)
            node = node[1]
        return out[::-1]

    def before(a, b):
        p, q = pieces(a), pieces(b)
        k = next((k for k in range(min(len(p), len(q))) if p[k] is not q[k]), min(len(p), len(q)))
        return "".join(x[0] for x in p[k:]) < "".join(x[0] for x in q[k:])

    for run in tables:
        new: list = [None] * _STATES
        for start, ends in run.items():
            if cells[start] is None:
                continue
            for state, held in enumerate(ends):
                if held is None:
                    continue
                cost, node = cells[start][0] + held[0], (held[1], cells[start][1])
                if new[state] is None or cost < new[state][0] or cost == new[state][0] and before(node, new[state][1]):
                    new[state] = (cost, node)
        cells = new
    best = None
    for state in _ENDS:
        if cells[state] is not None and (best is None or cells[state][0] < best[0]
                                         or cells[state][0] == best[0] and before(cells[state][1], best[1])):
            best = cells[state]
    return best[0], [p[0] for p in pieces(best[1])]


# ------------------------------------------------------------------- plan

def _text(column: str):
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone, copy): rows after the damage of the contract; ``gone`` marks dropped rows,
    which are kept as the only trace of a conversation that loses all."""
    key = F.crc32(F.concat(_text("conv_id"), F.lit(":"), _text("turn")).cast("binary")) % 20
    rows = conversations.select("conv_id", "turn", _text("role").alias("role"), _text("text").alias("text"), key.alias("key"))
    text = (F.when(F.col("key") == 1, "").when(F.col("key") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")))
    role = F.when(F.col("key") == 4, "user").otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (F.col("key") == 0).alias("gone"),
                       F.explode(F.when(F.col("key") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"))


def placed(rows: DataFrame) -> DataFrame:
    """Rows in the order of their conversation, written once with ``pos``: ascending along every conversation."""
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256))
    solid = F.rtrim(F.col("text"), F.lit(" \t\n\x0b\f\r"))
    last = F.substring(solid, -1, 1)
    rows = rows.select("conv_id", "turn", "role", "text", "gone", "copy", digest.alias("digest"), F.substring("role", 1, 1).alias("initial"),
                       (solid == "").alias("blank"), (~last.isin(".", "!", "?")).alias("cut"))
    order = ["conv_id", "turn", "role", "digest", "copy"]
    spread = rows.repartitionByRange(parts(rows.sparkSession), *order).sortWithinPartitions(*order)
    return written(spread.withColumn("pos", F.monotonically_increasing_id()), "placed")


_LIGHT = "conv_id turn initial blank cut gone seen pos".split()
_RUNS = "conv_id long, pos long, n long, blank long, duplicate long, truncated long, illegal long, turns long, " \
        "low long, high long, first string, last string, starts array<int>, costs array<long>, audits array<string>"


def _run_row(rows: list, known_start: bool) -> dict:
    """One run of one conversation: counts and its DP table from the states it may start in."""
    kept = [r for r in rows if not r["gone"]]
    faults = ["blank" if r["blank"] else "duplicate" if r["seen"] else "truncated" if r["cut"] else "" for r in kept]
    turns = [r["turn"] for r in kept if r["turn"] is not None]
    initials = [r["initial"] for r in kept]
    light = [(i, f in ("blank", "duplicate"), f == "truncated") for i, f in zip(initials, faults, strict=True)]
    starts = [0] if known_start else list(range(_STATES))
    tables = [run_table(light, s) for s in starts]
    cells = [c for t in tables for c in t]
    return {"conv_id": rows[0]["conv_id"], "pos": rows[0]["pos"], "n": len(kept),
            **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
            "illegal": sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])),
            "turns": len(set(turns)), "low": min(turns, default=None), "high": max(turns, default=None),
            "first": initials[0] if kept else None, "last": initials[-1] if kept else None, "starts": starts,
            "costs": [None if c is None else c[0] for c in cells], "audits": [None if c is None else c[1] for c in cells]}


def _rows_of(batches):
    for batch in batches:
        yield from batch.to_pylist()


def _grouped(rows, key):
    """Consecutive rows of one key as (key, iterator)."""
    rows = iter(rows)
    row = next(rows, None)
    while row is not None:
        name = key(row)

        def same():
            nonlocal row
            while row is not None and key(row) == name:
                yield row
                row = next(rows, None)
        yield name, same()


def _emit(rows, schema: pa.Schema, size: int = 2000):
    rows = iter(rows)
    while some := list(islice(rows, size)):
        yield pa.RecordBatch.from_pylist(some, schema=schema)


def _runs(batches):
    def made():
        for (_, part), rows in _grouped(_rows_of(batches), lambda r: (r["conv_id"], r["pos"] >> 33)):
            number = 0
            while some := list(islice(rows, _RUN)):
                # a run that starts neither its range nor goes on with another run starts its conversation
                yield _run_row(some, number == 0 and some[0]["pos"] != part << 33)
                number += 1
    schema = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), *[(c, pa.int64()) for c in (
        "n", "blank", "duplicate", "truncated", "illegal", "turns", "low", "high")], ("first", pa.string()), ("last", pa.string()),
        ("starts", pa.list_(pa.int32())), ("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))])
    return _emit(made(), schema)


_SUMMARY = "conv_id long, pos long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, part string"


def _summaries(batches):
    """Per conversation one row with its counts and audit, and one row a run with the run's part of the audit."""
    def made():
        for conv, rows in _grouped(_rows_of(batches), lambda r: r["conv_id"]):
            runs, total, last, end = [], dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0), None, None
            low = high = None
            for r in rows:
                runs.append((r["pos"], {s: list(zip(r["costs"][4 * k:4 * k + 4], r["audits"][4 * k:4 * k + 4]))
                                        for k, s in enumerate(r["starts"])}))
                for c in total:
                    total[c] += r[c]
                if r["first"] is not None:
                    if last is not None and last + r["first"] not in ("su", "ua", "au"):
                        total["illegal"] += 1
                    last = r["last"]
                if r["low"] is not None:
                    if end == r["low"]:
                        total["turns"] -= 1  # one turn on both sides of the seam
                    low, high, end = r["low"] if low is None else low, r["high"], r["high"]
            tables = [{s: [None if c is None else (c, a) for c, a in cells] for s, cells in run.items()} for _, run in runs]
            cost, audits = join_runs(tables)
            gaps = 0 if low is None else min(high - low + 1 - total["turns"], 2**63 - 1)
            yield {"conv_id": conv, "pos": -1, "gaps": gaps, **{c: total[c] for c in ("blank", "duplicate", "truncated", "illegal")},
                   "cost": cost, "audit": "".join(audits), "part": None}
            for (pos, _), part in zip(runs, audits, strict=True):
                yield {"conv_id": conv, "pos": pos, "part": part}
    schema = pa.schema([("conv_id", pa.int64()), ("pos", pa.int64()), *[(c, pa.int64()) for c in (
        "gaps", "blank", "duplicate", "truncated", "illegal", "cost")], ("audit", pa.string()), ("part", pa.string())])
    return _emit(made(), schema)


_RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def _hashed(batches):
    """Summaries, audits and texts of a conversation, in order, to its row."""
    def made():
        for _, rows in _grouped(_rows_of(batches), lambda r: r["conv_id"]):
            done, digest, first, state = None, hashlib.sha256(), True, 0
            edits, at = "", 0

            def put(role, text):
                nonlocal first
                digest.update((("" if first else "\n") + f"{role}:{text}").encode())
                first = False

            def inserts():
                nonlocal at, state
                while at < len(edits) and edits[at] == "I":
                    state = _NEXT[state]
                    put("user" if state == 2 else "assistant", "")
                    at += 1

            for r in rows:
                if r["kind"] == 0:
                    done = r
                elif r["kind"] == 1:
                    inserts()  # those that end the run before
                    edits, at = r["audit"], 0
                    inserts()
                elif not r["gone"]:
                    inserts()
                    edit, at = edits[at], at + 1
                    if edit == "K":
                        state = _AFTER[r["role"][:1]][state]
                        put(r["role"], r["text"])
                    elif edit == "R":
                        state = _NEXT[state]
                        put("user" if state == 2 else "assistant", r["text"])
            inserts()
            yield {c: done[c] for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")} | {
                "repaired_sha256": digest.hexdigest()}
    schema = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                        ("audit", pa.string()), ("repaired_sha256", pa.string())])
    return _emit(made(), schema)


def audit(rows: DataFrame) -> DataFrame:
    """One row a conversation of (conv_id, turn, role, text): faults, the cheapest repair and a digest of what it leaves.

    Rows stand in the order of turn (nulls first), then role and a digest of
    the text, so ties don't depend on the input's order.  Optional columns:
    ``gone`` (a row that doesn't count but keeps its conversation in the
    result) and ``copy`` (orders rows that repeat).  Null role or text: one
    space.  Null conv_id: one conversation.  Rows that repeat are duplicates.
    Very long texts pass one at a time.  Empty table: no rows.  Other columns
    are left alone.
    """
    spark = rows.sparkSession
    extra = {c.lower() for c in rows.columns}
    rows = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                       _text("role").alias("role"), _text("text").alias("text"),
                       (F.col("gone") if "gone" in extra else F.lit(False)).alias("gone"),
                       (F.col("copy") if "copy" in extra else F.lit(0)).alias("copy"))
    whole = placed(rows)
    firsts = (whole.where(~F.col("gone")).groupBy("conv_id", "digest").agg(F.min("pos").alias("pos"))
              .select("pos", F.lit(False).alias("seen")))
    light = (whole.join(firsts, "pos", "left").withColumn("seen", F.coalesce("seen", F.lit(True))).select(*_LIGHT)
             .repartition(parts(spark), F.shiftright("pos", 33)).sortWithinPartitions("pos"))
    runs = light.mapInArrow(_runs, _RUNS)
    joined = written(runs.repartition(parts(spark), "conv_id").sortWithinPartitions("conv_id", "pos").mapInArrow(_summaries, _SUMMARY), "audits")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    said = joined.select("conv_id", "pos", F.when(F.col("pos") < 0, 0).otherwise(1).alias("kind"), *counts,
                         F.coalesce("audit", "part").alias("audit"), F.lit(False).alias("gone"),
                         F.lit(None).cast("string").alias("role"), F.lit(None).cast("string").alias("text"))
    texts = whole.select("conv_id", "pos", F.lit(2).alias("kind"), *[F.lit(None).cast("long").alias(c) for c in counts],
                         F.lit(None).cast("string").alias("audit"), "gone", "role", "text")
    return (said.unionByName(texts).repartition(parts(spark), "conv_id").sortWithinPartitions("conv_id", "pos", "kind")
            .mapInArrow(_hashed, _RESULT))


def op11(spark, sf_dir: str) -> DataFrame:
    return audit(damaged(table(spark, sf_dir, "conversations")))
