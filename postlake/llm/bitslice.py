"""Exact top-k by inner product over a bit-sliced index.

Vectors are integers.  A block of rows keeps, for every component, its
``slices`` most significant bits as bitmaps over the rows (the offset binary
of the block's range; the lower bits are left to the exact step).  A query's
score is added up in bitmap arithmetic: each set bit of a weight adds the
component's slices at its place by carry-save adders, so the sum is a
bit-sliced number as well; a negative weight adds the complement.  The best
rows are picked from the most significant slice of the sum downward.  What
the left-out bits can add is bounded per query, so all rows within that
margin of the k-th best sum form the boundary; they are scored exactly.

Plan: rows are dealt to blocks of about ``block_rows``, queries to tiles of
about ``tile_queries``; each (block, tile) cell is one task-local
computation with fixed memory and returns k rows a query.  Queries go to
every block, by definition of an exact search, but no (query, row) pair
becomes a Spark row.  The final ranking is a window per query over k rows of
each block, cut before the shuffle.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import NO_ID, table, written

K = 10
SCALE = 1024
_ONES = np.uint64(0xFFFFFFFFFFFFFFFF)


def _bitmaps(flags: np.ndarray) -> np.ndarray:
    """Rows of booleans (m, n) as (m, ceil(n / 64)) words."""
    n = flags.shape[1]
    wide = np.zeros((flags.shape[0], -(-n // 64) * 64), bool)
    wide[:, :n] = flags
    return np.packbits(wide, axis=1, bitorder="little").view(np.uint64)


class Index:
    """The bit slices of one block of integer vectors."""

    def __init__(self, rows: np.ndarray, slices: int):
        self.rows, self.n = rows, len(rows)
        self.low = rows.min(0) if self.n else np.zeros(rows.shape[1], np.int64)
        over = rows - self.low
        bits = int(over.max()).bit_length() if over.size else 0
        self.shift = max(0, bits - slices)
        self.width = bits - self.shift
        top = (over >> self.shift).T
        self.maps = [[_bitmaps((top[d:d + 1] >> i & 1).astype(bool))[0] for i in range(self.width)]
                     for d in range(rows.shape[1])]
        self.full = _bitmaps(np.ones((1, self.n), bool))[0]

    def sums(self, queries: np.ndarray) -> list[np.ndarray]:
        """Bit-sliced sums, least significant first, each (queries, words), of |q| * (slices or their complement)."""
        places: list[list[np.ndarray]] = []
        weights, negative = np.abs(queries), queries < 0
        bits = int(weights.max()).bit_length() if weights.size else 0

        def put(place, maps):
            while len(places) <= place:
                places.append([])
            held = places[place]
            held.append(maps)
            if len(held) == 3:  # a full adder: three bitmaps of one place are one there and one above
                a, b, c = held
                ab = a ^ b
                held[:] = [ab ^ c]
                put(place + 1, (a & b) | (ab & c))

        for d in range(queries.shape[1]):
            flip = np.where(negative[:, d], _ONES, np.uint64(0))[:, None]
            chosen = [np.where(weights[:, d] >> b & 1 == 1, _ONES, np.uint64(0))[:, None] for b in range(bits)]
            used = [b for b in range(bits) if chosen[b].any()]
            for i, rows in enumerate(self.maps[d]):
                value = (rows[None, :] ^ flip) & self.full
                for b in used:
                    put(i + b, value & chosen[b])
        zero = np.zeros((len(queries), len(self.full)), np.uint64)
        place = 0
        while place < len(places):  # what is left are two bitmaps a place at most
            held = places[place]
            if len(held) == 2:
                a, b = held
                held[:] = [a ^ b]
                put(place + 1, a & b)
            place += 1
        return [held[0] if held else zero for held in places]

    def margin(self, queries: np.ndarray) -> np.ndarray:
        """How far apart, in units of the sums, two rows of equal sums can be."""
        return -(-(np.abs(queries).sum(1) * ((1 << self.shift) - 1)) >> self.shift)

    def best(self, queries: np.ndarray, own: np.ndarray, k: int) -> list[np.ndarray]:
        """Row numbers, per query, that hold its k best rows (and the boundary); ``own`` bitmaps are left out."""
        sums = self.sums(queries)
        alive = ~own & self.full
        want = np.minimum(k, np.bitwise_count(alive).sum(1, dtype=np.int64))
        level = np.zeros(len(queries), dtype=object if len(sums) > 62 else np.int64)
        left = want.copy()
        for s in range(len(sums) - 1, -1, -1):  # the k-th best sum, from the top slice down
            ones = alive & sums[s]
            count = np.bitwise_count(ones).sum(1, dtype=np.int64)
            enough = (count >= left) & (left > 0)
            alive = np.where(enough[:, None], ones, alive & ~sums[s])
            left = np.where(enough, left, left - count)
            level = level + np.where(enough, 1 << s, 0)
        floor = np.maximum(level - self.margin(queries), 0)
        above, equal = np.zeros_like(alive), ~own & self.full
        for s in range(len(sums) - 1, -1, -1):  # rows of a sum of at least ``floor``
            bit = (floor >> s & 1 == 1)[:, None]
            above = np.where(bit, above, above | (equal & sums[s]))
            equal = np.where(bit, equal & sums[s], equal & ~sums[s])
        chosen = (above | equal) & np.where(want > 0, _ONES, np.uint64(0))[:, None]
        flags = np.unpackbits(chosen.view(np.uint8), axis=1, bitorder="little")[:, :self.n]
        return [np.flatnonzero(f) for f in flags]


def top_rows(rows: np.ndarray, row_keys: np.ndarray, row_ids: np.ndarray, queries: np.ndarray, query_keys: np.ndarray,
             k: int, slices: int):
    """(query number, row number, score) of each query's k best rows of a block; equal scores go to the smaller id.

    Rows whose key is the query's own are left out.
    """
    index, step = Index(rows, slices), max(1, min(512, (1 << 15) // max(1, len(rows) // 64)))
    out = []
    order = np.argsort(row_keys, kind="stable")
    for at in range(0, len(queries), step):
        some, keys = queries[at:at + step], query_keys[at:at + step]
        own = np.zeros((len(some), -(-len(rows) // 64) * 64), bool)
        lo, hi = (np.searchsorted(row_keys[order], keys, side) for side in ("left", "right"))
        for q in np.flatnonzero(hi > lo):
            own[q, order[lo[q]:hi[q]]] = True
        own = np.packbits(own, axis=1, bitorder="little").view(np.uint64)
        for q, near in enumerate(index.best(some, own, k)):
            scores = rows[near] @ some[q]
            first = np.lexsort((row_ids[near], -scores))[:k]
            out.append((np.full(len(first), at + q), near[first], scores[first]))
    return [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _whole(x: float, scale: int) -> int:
    scaled = x * scale
    return math.floor(scaled) if math.isfinite(scaled) else int(x) * scale


def wide_top_rows(rows: np.ndarray, row_keys: np.ndarray, row_ids: np.ndarray, queries: np.ndarray, query_keys: np.ndarray,
                  k: int, scale: int):
    """``top_rows`` for components of any finite size; scores are Python integers.

    Doubles with a bound of their rounding pick the rows that can be among
    the best (all of them where doubles overflow); these are scored exactly.
    """
    out = [], [], []
    with np.errstate(over="ignore", invalid="ignore"):
        r, asked = np.floor(rows * scale), np.floor(queries * scale)
    numbers: dict[int, list[int]] = {}  # of rows, as they are needed
    for q in range(len(queries)):
        others = np.flatnonzero(row_keys != query_keys[q])
        with np.errstate(over="ignore", invalid="ignore"):
            near, size = r[others] @ asked[q], np.abs(r[others]) @ np.abs(asked[q])
        if np.isfinite(size).all() and len(others) > k:
            off = size * (2 * r.shape[1] + 4) * np.finfo(float).eps
            low = np.partition(near - off, len(others) - k)[len(others) - k]
            others = others[near + off >= low]
        exact = [_whole(x, scale) for x in queries[q].tolist()]
        scores = []
        for j in others.tolist():
            if j not in numbers:
                numbers[j] = [_whole(x, scale) for x in rows[j].tolist()]
            scores.append(sum(a * b for a, b in zip(numbers[j], exact, strict=True)))
        for j in sorted(range(len(others)), key=lambda j: (-scores[j], row_ids[others[j]]))[:k]:
            out[0].append(q)
            out[1].append(others[j])
            out[2].append(scores[j])
    return np.array(out[0], np.int64), np.array(out[1], np.int64), out[2]


def _order(score: int) -> bytes:
    """Bytes that sort as the integers do."""
    raw = abs(score).to_bytes((abs(score).bit_length() + 7) // 8, "big")
    raw = len(raw).to_bytes(2, "big") + raw
    return b"\x01" + raw if score >= 0 else b"\x00" + bytes(255 - b for b in raw)


def _cell(k: int, slices: int, scale: int):
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        q_at, r_at, scores, past, order = np.zeros(0, np.int64), np.zeros(0, np.int64), [], [], []
        ids = rows.column("vec_id").fill_null(int(NO_ID)).to_numpy()
        row_keys, keys = rows.column("key").to_numpy(), queries.column("key").to_numpy()
        if len(ids) and len(keys):
            r, q = (_matrix(t.column("x").combine_chunks()) for t in (rows, queries))
            largest = [float(np.abs(m).max()) * scale + 1 for m in (r, q)]
            if max(largest) < 2**31 and largest[0] * largest[1] * r.shape[1] < 2**62:
                whole = [np.floor(m * scale).astype(np.int64) for m in (r, q)]
                q_at, r_at, scores = top_rows(whole[0], row_keys, ids, whole[1], keys, k, slices)
                past, order = np.zeros(len(scores), np.int32), [None] * len(scores)
            else:
                q_at, r_at, scores = wide_top_rows(r, row_keys, ids, q, keys, k, scale)
                past = [1 if s >= 2**63 else -1 if s < -2**63 else 0 for s in scores]
                order = [_order(s) if p else None for s, p in zip(scores, past, strict=True)]
                scores = [min(max(s, -2**63), 2**63 - 1) for s in scores]
        return pa.table({"query_key": pa.array(keys[q_at], pa.int64()), "query_id": queries.column("vec_id").take(pa.array(q_at)),
                         "vec_id": rows.column("vec_id").take(pa.array(r_at)), "score": pa.array(scores, pa.int64()),
                         "past": pa.array(past, pa.int32()), "order": pa.array(order, pa.binary())})
    return run


def finite(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(key, vec_id, x array<double>); key tells rows of one id apart.

    Rows with a null or empty vector, or a null or non-finite component, are
    left out; a null id stays.
    """
    x = F.col(f"`{vector_col}`")
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    return (vectors.where(x.isNotNull() & (F.size(x) > 0) & fine)
            .select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), x.cast("array<double>").alias("x"))
            .withColumn("key", F.monotonically_increasing_id()))


def top_k(vectors: DataFrame, is_query, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding",
          scale: int = SCALE, slices: int = 9, block_rows: int = 4096, tile_queries: int = 4096) -> DataFrame:
    """(query_id, rank from 1, vec_id, score) of the ``k`` best rows of every query, by integer inner product.

    Components become floor(scale * component).  Queries are the rows for
    which ``is_query`` (a Column of ``vec_id``) holds; candidates are all rows
    but the query's own.  Equal scores go to the smaller id, null ids last.
    Vectors as in ``finite``; vectors of another length than a query's have no
    score with it.  If ids repeat, each row is a candidate, and each query row
    is a query, of its own; equal rows are listed as often as they stand.
    Fewer rows than ``k``: all of them.  Empty table or no query: no rows.
    Cells whose scores could pass 64 bits are scored in integers of any size;
    a score beyond 64 bits ranks by its true value and is returned as the
    largest (or smallest) long.
    """
    rows = written(finite(vectors, id_col, vector_col), "vectors").withColumn("size", F.size("x"))
    asked = rows.where(is_query)
    n, n_asked = rows.count(), asked.count()
    blocks, tiles = max(1, math.ceil(n / block_rows)), max(1, math.ceil(n_asked / tile_queries))
    block, tile = (F.pmod(F.xxhash64("vec_id", "key"), F.lit(n)).cast("int") for n in (blocks, tiles))
    spread = rows.withColumn("block", block).withColumn("tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    asking = asked.withColumn("tile", tile).withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (spread.groupBy("size", "block", "tile").cogroup(asking.groupBy("size", "block", "tile"))
             .applyInArrow(_cell(k, slices, scale), "query_key long, query_id long, vec_id long, score long, past int, order binary"))
    best = Window.partitionBy("query_key").orderBy(F.desc("past"), F.desc("order"), F.desc("score"), F.asc_nulls_last("vec_id"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op3(spark, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


OP3_SQL = """
WITH v AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::HUGEINT) AS x
           FROM embeddings
           WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT q.row, q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.x, c.x), lambda p: p[1] * p[2])) AS score
      FROM v q JOIN v c ON q.row <> c.row AND len(q.x) = len(c.x) WHERE q.vec_id % 100 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY row ORDER BY score DESC, vec_id NULLS LAST) AS rank, vec_id, score FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id,
       least(greatest(score, -9223372036854775808::HUGEINT), 9223372036854775807::HUGEINT)::BIGINT AS score FROM r WHERE rank <= 10
"""
