"""Context-triggered piecewise hashing of documents.

A rolling hash over the last seven bytes ends a chunk wherever it hits a
value that is as likely as one in ``size`` bytes; each chunk gives one of 64
characters.  A fingerprint is ``size:chunks at size:chunks at 2 * size``,
with ``size`` = 3 * 2**k, the smallest that gives 64 chunks or fewer on
average (halved while a monotonous text gives fewer than ``SHORTEST``).  A run
of one character keeps ``RUN`` of it, and the size grows while a signature is
still longer than ``LONGEST``, so a comparison has a bound whatever the texts.
Two fingerprints are compared at the chunk size they share: the
likeness is 1 - edit distance / longer length, or 0 if they share no size or
no run of ``COMMON`` characters (half of a shorter signature).

The edited text takes the head of the next document, so neighbours by id
have to meet: ids are cut into ranges at quantiles (an id, or no id, that holds several
quantiles into ranges of its rows' text hashes), every text goes to its range
in one shuffle, and the first text of each range goes to the range
before it as well (as many extra rows as there are ranges).  A task streams
its sorted rows and holds two texts at a time.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import mix64, parts, span_hashes, table

_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
REACH = 7  # bytes that the rolling hash sees
TARGET = 64  # chunks on average, at most
COMMON = 4
SHORTEST = 16
RUN = 3
LONGEST = 4 * TARGET
_STEP = np.uint64(0x100000001B3)


def _signature(data: np.ndarray, rolling: np.ndarray, size: int) -> str:
    ends = np.flatnonzero(rolling % np.uint64(size) == size - 1) + 1
    if len(ends) == 0 or ends[-1] != len(data):
        ends = np.append(ends, len(data))
    starts = np.concatenate([[0], ends[:-1]])
    number = (span_hashes(data, starts, ends) >> np.uint64(58)).astype(np.int64)
    place = np.arange(len(number))
    run = np.maximum.accumulate(np.where(np.concatenate([[True], number[1:] != number[:-1]]), place, 0))
    return _ALPHABET[number[place - run < RUN]].tobytes().decode()


def fingerprint(text: str | None) -> str:
    """``size:first:second``; the empty text is ``3::``."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass"), np.uint8)
    size = 3
    while size * TARGET < len(data):
        size *= 2
    if len(data) == 0:
        return "3::"
    wide = np.concatenate([np.zeros(REACH - 1, np.uint64), data.astype(np.uint64) + np.uint64(1)])
    rolling = np.zeros(len(data), np.uint64)
    for k in range(REACH):
        rolling = rolling * _STEP + wide[k:k + len(data)]
    rolling = mix64(rolling) >> np.uint64(20)
    first, second = _signature(data, rolling, size), _signature(data, rolling, 2 * size)
    while size > 3 and len(first) < SHORTEST:
        size //= 2
        first, second = _signature(data, rolling, size), first
    while max(len(first), len(second)) > LONGEST:  # ends, as no hash hits a size beyond its range
        size *= 2
        first, second = second, _signature(data, rolling, 2 * size)
    return f"{size}:{first}:{second}"


def edit_distance(a: str, b: str) -> int:
    """Insertions, deletions and substitutions, one bit-parallel column a character of ``b``."""
    if not a or not b:
        return len(a) + len(b)
    where: dict[str, int] = {}
    for k, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << k
    full, top = (1 << len(a)) - 1, 1 << len(a) - 1
    up, down, score = full, 0, len(a)
    for c in b:
        at = where.get(c, 0)
        diagonal = (((at & up) + up) ^ up) | at | down
        plus, minus = down | ~(diagonal | up) & full, up & diagonal
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 | 1, minus << 1
        up, down = (minus | ~(diagonal | plus)) & full, plus & diagonal & full
    return score


def _alike(a: str, b: str) -> float:
    if a == b:
        return 1.0
    n = min(COMMON, (min(len(a), len(b)) + 1) // 2)
    runs = {a[k:k + n] for k in range(len(a) - n + 1)}
    if n == 0 or not any(b[k:k + n] in runs for k in range(len(b) - n + 1)):
        return 0.0
    return 1 - edit_distance(a, b) / max(len(a), len(b))


def likeness(a: str, b: str) -> float:
    """0 to 1; equal fingerprints are 1."""
    if a == b:
        return 1.0
    (n, a1, a2), (m, b1, b2) = a.split(":"), b.split(":")
    n, m = int(n), int(m)
    if n == m:
        return max(_alike(a1, b1), _alike(a2, b2))
    return _alike(a1, b2) if n == 2 * m else _alike(a2, b1) if m == 2 * n else 0.0


def edited(text: str, following: str) -> str:
    """The last quarter of the code points replaced by the first as many of the next document."""
    cut = len(text) // 4
    return text[:len(text) - cut] + following[:cut]


def _stream(batches):
    recent = functools.lru_cache(maxsize=4)(fingerprint)  # a text's, soon asked again as the next one's

    def rows():
        for batch in batches:
            yield from zip(*(batch.column(c).to_pylist() for c in ("id", "text", "extra")), strict=True)

    def out(done):
        names = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
        return pa.record_batch({n: pa.array(c, k) for n, c, k in zip(names, zip(*done, strict=True), kinds, strict=True)})

    done, held = [], None
    for doc, text, extra in rows():
        if held is not None:
            now, new = held[1], edited(held[1], text)
            own, other = recent(now), fingerprint(new)
            done.append((held[0], len(now), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(), own, other,
                         likeness(own, other), likeness(own, recent(text))))
            if len(done) >= 2000:
                yield out(done)
                done = []
        held = None if extra else (doc, text)
    if done:
        yield out(done)


class Ranges:
    """Ranges of (id, mark) in order: up to each cut, then, for a cut that holds several quantiles, parts of its marks;
    the rows without an id come last, in parts of their marks as well."""

    def __init__(self, quantiles: list[int], nulls: int):
        self.cuts, times = np.unique(np.array(quantiles, np.int64), return_counts=True)
        self.ways = np.where(times > 1, times, 0)  # parts of a hot id's marks
        self.first = np.concatenate([[0], np.cumsum(1 + self.ways)])
        self.nulls = max(1, nulls)

    def __len__(self) -> int:
        return int(self.first[-1]) + 1 + self.nulls

    def of(self, ids: pa.Array, marks: np.ndarray) -> np.ndarray:
        none = ids.is_null().to_numpy(zero_copy_only=False)
        given = ids.fill_null(0).to_numpy(zero_copy_only=False)
        at = np.searchsorted(self.cuts, given)
        share = (marks >> 32) + (1 << 31)  # 0 to 2**32 in the order of the marks

        def part(ways):
            return share * ways >> 32

        out = self.first[at]
        if len(self.cuts):
            near = np.minimum(at, len(self.cuts) - 1)
            hot = (at < len(self.cuts)) & (self.cuts[near] == given) & (self.ways[near] > 0)
            out = np.where(hot, out + 1 + part(self.ways[near]), out)
        return np.where(none, self.first[-1] + 1 + part(self.nulls), out)


def _deal(ranges: Ranges, extra: dict[tuple, int], text: bool):
    """Rows with the range of their id; the first rows of a range also go, marked, to the range before."""

    def run(batches):
        for batch in batches:
            ids = batch.column("id")
            at = ranges.of(ids, batch.column("mark").to_numpy())
            named = {c: batch.column(c) for c in (("id", "mark", "text") if text else ("id", "mark"))}
            first = pa.record_batch({"range": pa.array(at.astype(np.int32)), "extra": pa.array(np.zeros(len(at), np.int32))} | named)
            yield first
            if extra:
                to = [extra.get(key) for key in zip(ids.to_pylist(), batch.column("mark").to_pylist(), strict=True)]
                also = [k for k, r in enumerate(to) if r is not None]
                if also:
                    yield pa.record_batch({"range": pa.array([to[k] for k in also], pa.int32()),
                                           "extra": pa.array([1] * len(also), pa.int32())}
                                          | {c: v.take(pa.array(also)) for c, v in named.items()})
    return run


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranges: int | None = None) -> DataFrame:
    """Every text's fingerprint beside that of its edited text and the next document's.

    Columns: doc_id (long), n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next.  The next document is the one
    with the next larger id; rows of one id stand in the order of a hash of
    their text; after the last comes the first.  Null text: empty.  Rows
    without an id come last.  One row alone is its own next document.  Empty
    table: no rows.  Other columns are left out.
    """
    n = ranges or parts(docs.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("mark"), text.alias("text"))
    # bounds of the ranges and their first rows: a few numbers per range on the driver, whatever the table's size
    found = rows.agg(F.percentile_approx("id", [k / n for k in range(1, n)] or [0.5], 100 * n).alias("cuts"),
                     F.count(F.lit(1)).alias("rows"), F.count_if(F.col("id").isNull()).alias("nulls")).first()
    ranges = Ranges((found.cuts or []) if n > 1 else [], -(-found.nulls * n // max(1, found.rows)))
    dealt = rows.select("id", "mark").mapInArrow(_deal(ranges, {}, False), "range int, extra int, id long, mark long")
    firsts = sorted((r[0], (r.f.id, r.f.mark)) for r in dealt.groupBy("range").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "mark")).alias("f")).collect())
    before = [r for r, _ in firsts[-1:] + firsts[:-1]]
    extra = {key: to for (_, key), to in zip(firsts, before, strict=True)}
    return (rows.mapInArrow(_deal(ranges, extra, True), "range int, extra int, id long, mark long, text string")
            .repartitionById(len(ranges), F.col("range"))
            .sortWithinPartitions("range", "extra", F.col("id").asc_nulls_last(), "mark")
            .mapInArrow(_stream, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                                 "edited_fingerprint string, near_edited double, near_next double"))


def op8(spark, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))
