"""Ranked lexical search over a document FP-tree with branch and bound.

Documents are restricted to the terms of the query items.  A block of
documents orders each document's terms by falling document frequency and
sorts the documents by these vectors, so documents that share their most
frequent terms share a path of a prefix tree and stand side by side.  A node
of the tree is a range of documents; it keeps the largest tf of every term in
its subtree and the smallest m, from which every term has a largest possible
contribution there.  An item goes down the tree depth first, the most
promising child first; a subtree whose bound is below the item's k-th best
score so far is skipped.  A leaf (about ``leaf_docs`` documents) is scored
exactly.  The k best of an item are kept from block to block of a task.

Plan: one pass over the texts (Arrow batches, words as byte ranges; a term
counts only if its bytes equal those of the vocabulary entry its hash leads
to) writes each document's size and restricted vector.  Counts are native
aggregates of that table.  The search reads it where it lies, without a
shuffle; a task sends k rows an item, which are ranked in two steps, by a
bucket of tasks and then by item.  Items are worked through in tiles of about
``tile_terms`` (item, term) pairs, each broadcast with its vocabulary (an
item of more terms is a tile of its own), so what is broadcast is bounded
whatever the number of items; the texts are read once a tile.
"""

from __future__ import annotations

import functools
import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.llm.common import pieces, span_hashes, table, utf8, written

K = 50
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_PIECE = 2 << 20
_CELLS = 1 << 21  # entries of a block's table of bounds
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
_SOLID = np.zeros(256, bool)
_SOLID[48:58] = _SOLID[65:91] = _SOLID[97:123] = _SOLID[128:] = True


def term_bounds(offsets: np.ndarray, data: np.ndarray):
    """Byte starts, byte ends and document index of every term (bytes of letters and digits, and all beyond ASCII)."""
    n = len(data)
    if n == 0:
        return [np.zeros(0, np.int64)] * 3
    solid = np.concatenate([[False], _SOLID[data], [False]])
    inner = np.unique(offsets[(offsets > 0) & (offsets < n)])
    inner = inner[solid[inner] & solid[inner + 1]]  # a document's end parts what stands on both sides of it
    starts = np.union1d(np.flatnonzero(solid[1:] & ~solid[:-1]), inner)
    ends = np.union1d(np.flatnonzero(~solid[1:] & solid[:-1]), inner)
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


class Terms:
    """Byte strings found by their 64-bit hash, and only if their bytes are equal."""

    def __init__(self, terms: list[bytes]):
        ends = np.cumsum([len(t) for t in terms]).astype(np.int64)
        data = np.frombuffer(b"".join(terms), np.uint8)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
        keys = span_hashes(data, starts, ends)
        order = np.argsort(keys, kind="stable")
        if len(np.unique(keys)) != len(keys):
            raise ValueError("two terms of the items have one hash")
        self.keys, self.number = keys[order], order
        self.data, self.starts, self.sizes = data, starts, ends - starts

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of each span's term, or -1."""
        if len(self.keys) == 0 or len(starts) == 0:
            return np.full(len(starts), -1)
        keys = span_hashes(data, starts, ends)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = np.flatnonzero(self.keys[at] == keys)
        number = self.number[at[hit]]
        size = ends[hit] - starts[hit]
        fits = self.sizes[number] == size
        hit, number, size = hit[fits], number[fits], size[fits]
        longest = int(size.max(initial=0))
        equal = np.ones(len(hit), bool)
        for k in range(longest):  # byte k of all spans that have one
            some = np.flatnonzero(size > k)
            equal[some] &= data[starts[hit[some]] + k] == self.data[self.starts[number[some]] + k]
        out = np.full(len(starts), -1)
        out[hit[equal]] = number[equal]
        return out


@functools.lru_cache(maxsize=2)
def _terms(content: bytes) -> Terms:
    return Terms(pickle.loads(content))


def _restrict(terms, id_col: str, text_col: str):
    def run(batches):
        known = _terms(terms.value)
        n_terms = len(known.sizes)
        for batch in batches:
            for piece in pieces(batch, text_col, _PIECE):
                offsets, data = utf8(piece.column(text_col))
                data = _FOLD[data]
                starts, ends, doc = term_bounds(offsets, data)
                number = known.find(data, starts, ends)
                keys, tf = np.unique(doc[number >= 0] * n_terms + number[number >= 0], return_counts=True)
                of, term = np.divmod(keys, max(1, n_terms))
                cuts = pa.array(np.searchsorted(of, np.arange(piece.num_rows + 1)).astype(np.int32))
                yield pa.record_batch({
                    "doc_id": piece.column(id_col).cast(pa.int64()),
                    "n": pa.array(np.bincount(doc, minlength=piece.num_rows).astype(np.int64)),
                    "terms": pa.ListArray.from_arrays(cuts, pa.array(term.astype(np.int32))),
                    "tfs": pa.ListArray.from_arrays(cuts, pa.array(tf.astype(np.int32)))})
    return run


def lengths(n: np.ndarray, n_docs: int, n_all: int) -> np.ndarray:
    """m of documents with n terms, exactly whatever the counts."""
    if 50 * int(n.max(initial=0)) * n_docs < 2**63:
        return 50 + 50 * n * n_docs // n_all
    return np.array([50 + 50 * int(x) * n_docs // n_all for x in n], np.int64)


class Tree:
    """The FP-tree of one block.

    Documents are renumbered in the order of their vectors: ``terms`` and
    ``tfs`` are the vectors one after the other, ``cuts`` where each starts.
    Nodes are ranges [lo, hi) of documents; ``children[v]`` of a leaf is
    empty.  ``bounds[i, v]`` is the largest contribution, without its
    weight, of term ``present[i]`` in the subtree of v.
    """

    def __init__(self, cuts: np.ndarray, terms: np.ndarray, tfs: np.ndarray, m: np.ndarray, frequent: np.ndarray, leaf_docs: int):
        doc = np.repeat(np.arange(len(m)), np.diff(cuts))
        place = frequent[terms]  # 0 for the most frequent term
        order = np.lexsort((place, doc))
        place, terms, tfs = place[order], terms[order], tfs[order]
        raw, at = place.astype(">u4").tobytes(), (cuts * 4).tolist()
        vectors = [raw[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
        self.order = np.array(sorted(range(len(m)), key=vectors.__getitem__), np.int64)
        sizes = np.diff(cuts)[self.order]
        self.cuts = np.concatenate([[0], np.cumsum(sizes)])
        pick = np.repeat(cuts[:-1][self.order] - self.cuts[:-1], sizes) + np.arange(len(terms))
        self.terms, self.tfs, self.place = terms[pick], tfs[pick].astype(np.int64), place[pick]
        self.m = m[self.order]
        tf, each = self.tfs, np.repeat(self.m, sizes)
        self.gain = 1_000_000_000 * tf // (1000 * tf + 20 * each)
        self.present, self.column = np.unique(self.terms, return_inverse=True)
        leaf_docs = max(leaf_docs, 8 * len(m) * len(self.present) // _CELLS)
        self.lo, self.hi, self.children = [], [], []
        self._grow(0, len(m), 0, leaf_docs)
        self._bound()

    def _grow(self, lo: int, hi: int, depth: int, leaf_docs: int) -> None:
        stack = [(lo, hi, depth, -1)]
        while stack:
            lo, hi, depth, parent = stack.pop()
            v = len(self.lo)
            self.lo.append(lo)
            self.hi.append(hi)
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(v)
            if hi - lo <= leaf_docs:
                continue
            while True:  # go down a path that all documents of the range share
                at = self.cuts[lo:hi] + depth
                ended = at >= self.cuts[lo + 1:hi + 1]
                step = np.where(ended, -1, self.place[np.minimum(at, len(self.place) - 1)])
                heads = np.flatnonzero(step[1:] != step[:-1]) + 1
                if len(heads) or ended[0]:
                    break
                depth += 1
            if len(heads) == 0:
                continue  # copies of one vector: a leaf of any size
            edges, small = [0, *heads.tolist(), hi - lo], None
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if b - a > leaf_docs and not ended[a]:
                    if small is not None:
                        stack.append((lo + small, lo + a, depth, v))
                        small = None
                    stack.append((lo + a, lo + b, depth + 1, v))
                elif small is None:
                    small = a
                elif b - small > leaf_docs:  # small neighbours make one leaf
                    stack.append((lo + small, lo + a, depth, v))
                    small = a
            if small is not None:
                stack.append((lo + small, hi, depth, v)) if small else None
                if small == 0:  # all children are small and make one leaf: this node
                    self.children[v] = []

    def _bound(self) -> None:
        n = len(self.lo)
        tf = np.zeros((n, len(self.present)), np.int64)
        low = np.full(n, np.iinfo(np.int64).max)
        for v in range(n - 1, -1, -1):  # children come after their parents
            if self.children[v]:
                tf[v] = tf[self.children[v]].max(0)
                low[v] = low[self.children[v]].min()
            else:
                part = slice(self.cuts[self.lo[v]], self.cuts[self.hi[v]])
                np.maximum.at(tf[v], self.column[part], self.tfs[part])
                low[v] = self.m[self.lo[v]:self.hi[v]].min()
        self.bounds = np.ascontiguousarray((1_000_000_000 * tf // (1000 * tf + 20 * low[:, None])).T)

    def scores(self, v: int, weight: np.ndarray) -> np.ndarray:
        """Exact scores of a leaf's documents; ``weight`` by column, 0 for terms that aren't the item's."""
        a, b = self.cuts[self.lo[v]], self.cuts[self.hi[v]]
        sums = np.concatenate([[0], np.cumsum(weight[self.column[a:b]] * self.gain[a:b])])
        at = self.cuts[self.lo[v]:self.hi[v] + 1] - a
        return sums[at[1:]] - sums[at[:-1]]


def _keep(best, scores, ids, k):
    """The k best of what an item has and of new documents: higher scores, then smaller ids."""
    scores, ids = np.concatenate([best[0], scores]), np.concatenate([best[1], ids])
    if len(scores) > k:
        first = np.lexsort((ids, -scores))[:k]
        scores, ids = scores[first], ids[first]
    return scores, ids


def search_block(tree: Tree, ids: np.ndarray, items: list, weights: np.ndarray, best: list, k: int) -> int:
    """Take a block's documents into the items' best; returns the number of documents scored."""
    scored, column = 0, np.zeros(len(tree.present), np.int64)
    for q, terms in enumerate(items):
        at = np.minimum(np.searchsorted(tree.present, terms), len(tree.present) - 1)
        hit = tree.present[at] == terms
        if not hit.any():
            continue
        rows, w = at[hit], weights[terms[hit]]
        bounds = w @ tree.bounds[rows]
        column[rows] = w
        stack = [0]
        floor = int(best[q][0].min()) if len(best[q][0]) >= k else 1
        while stack:
            v = stack.pop()
            if bounds[v] < floor:
                continue
            if tree.children[v]:
                stack += sorted(tree.children[v], key=bounds.__getitem__)
                continue
            scores = tree.scores(v, column)
            scored += len(scores)
            some = np.flatnonzero(scores >= floor)
            if len(some):
                best[q] = _keep(best[q], scores[some], ids[tree.order[tree.lo[v] + some]], k)
                if len(best[q][0]) >= k:
                    floor = int(best[q][0].min())
        column[rows] = 0
    return scored


#: Null document ids take part and rank last among equal scores.
_NULL_ID = np.iinfo(np.int64).max


def _search(shared, k: int, block_docs: int, leaf_docs: int):
    def run(batches):
        items, weights, frequent, n_docs, n_all = pickle.loads(shared.value)
        best = [(np.zeros(0, np.int64), np.zeros(0, np.int64)) for _ in items]

        def block(parts):
            ids = np.concatenate([p[0] for p in parts])
            sizes, terms, tfs = (np.concatenate([p[j] for p in parts]) for j in (2, 3, 4))
            tree = Tree(np.concatenate([[0], np.cumsum(sizes)]), terms, tfs,
                        lengths(np.concatenate([p[1] for p in parts]), n_docs, n_all), frequent, leaf_docs)
            search_block(tree, ids, items, weights, best, k)

        parts, held = [], 0
        for batch in batches:
            sizes = np.diff(batch.column("terms").offsets.to_numpy())
            some = np.flatnonzero(sizes > 0)  # the others score nothing
            if len(some) == 0:
                continue
            parts.append((batch.column("doc_id").fill_null(_NULL_ID).to_numpy()[some], batch.column("n").to_numpy()[some],
                          sizes[some].astype(np.int64), batch.column("terms").flatten().to_numpy(), batch.column("tfs").flatten().to_numpy()))
            held += len(some)
            if held >= block_docs:
                block(parts)
                parts, held = [], 0
        if parts:
            block(parts)
        part = TaskContext.get().partitionId()
        for q, (scores, ids) in enumerate(best):
            if len(scores):
                yield pa.record_batch({"item": pa.array([q] * len(ids), pa.int32()), "part": pa.array([part] * len(ids), pa.int32()),
                                       "doc_id": pa.array(ids, mask=ids == _NULL_ID), "score": pa.array(scores)})
    return run


def _tiles(items: DataFrame, text_col: str, tile_terms: int):
    """Tiles of the items: lists of (row key, item_id, distinct terms), fetched one tile at a time."""
    folded = F.translate(F.coalesce(F.col(text_col), F.lit("")), _UPPER, _LOWER)
    rows = items.withColumn("terms", F.array_distinct(F.regexp_extract_all(folded, F.lit(TERM), F.lit(0))))
    tile, held = [], 0
    for row in rows.where(F.size("terms") > 0).select("item_id", "terms").toLocalIterator():
        if tile and held + len(row.terms) > tile_terms:
            yield tile
            tile, held = [], 0
        tile.append((row.item_id, row.terms))
        held += len(row.terms)
    if tile:
        yield tile


def rank(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
         item_text: str = "text", tile_terms: int = 1 << 16, block_docs: int = 8192, leaf_docs: int = 128) -> DataFrame:
    """(item_id, rank from 1, doc_id, score) of every item's ``k`` best documents with a score above 0.

    Terms, weights and scores as in the contract of op12; equal scores go to
    the smaller id, null ids last.  Null or empty texts have no terms; items
    without terms have no rows; fewer documents than ``k``: all that score.
    Items that repeat are ranked each by itself; documents that repeat are
    documents of their own.  A very long text is worked through whole; it
    takes a multiple of its bytes in memory.  Empty tables: no rows.  Other
    columns of the inputs are left alone.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    items = items.select(F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{item_text}`").alias("text"))
    kind = items.schema["item_id"].dataType
    empty = spark.createDataFrame([], "rank int, doc_id long, score long").select(
        F.lit(None).cast(kind).alias("item_id"), "rank", "doc_id", "score")
    out = [_rank_tile(spark, docs, tile, k, block_docs, leaf_docs, kind) for tile in _tiles(items, "text", tile_terms)]
    return functools.reduce(DataFrame.unionByName, out, empty)


def _rank_tile(spark, docs, tile, k, block_docs, leaf_docs, kind):
    names = sorted({t for _, terms in tile for t in terms})
    number = {t: j for j, t in enumerate(names)}
    shared = spark.sparkContext.broadcast(pickle.dumps([t.encode() for t in names]))
    vectors = written(docs.mapInArrow(_restrict(shared, "doc_id", "text"), "doc_id long, n long, terms array<int>, tfs array<int>"), "restricted")
    total = vectors.agg(F.count_if(F.col("n") > 0), F.coalesce(F.sum("n"), F.lit(0))).first()
    seen = vectors.select(F.explode("terms").alias("t")).groupBy("t").count().collect()  # one row a term of the tile
    df = np.zeros(len(names), np.int64)
    df[[r.t for r in seen]] = [r["count"] for r in seen]
    weights = np.array([math.floor(1000 * math.log((2 * total[0] + 2) / (2 * int(x) + 1))) for x in df], np.int64)
    frequent = np.empty(len(names), np.int64)
    frequent[np.lexsort((np.arange(len(names)), -df))] = np.arange(len(names))
    items = [np.sort(np.array([number[t] for t in terms], np.int64)) for _, terms in tile]
    shared = spark.sparkContext.broadcast(pickle.dumps((items, weights, frequent, total[0], max(1, total[1]))))
    found = written(vectors.mapInArrow(_search(shared, k, block_docs, leaf_docs), "item int, part int, doc_id long, score long"), "ranked")
    best = [F.desc("score"), F.asc_nulls_last("doc_id")]
    first = F.row_number().over(Window.partitionBy("item", F.pmod("part", F.lit(64))).orderBy(*best))
    last = F.row_number().over(Window.partitionBy("item").orderBy(*best))
    ranked = (found.withColumn("r", first).where(F.col("r") <= k).withColumn("rank", last).where(F.col("rank") <= k))
    ids = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(tile)], "item int, item_id long").withColumn("item_id", F.col("item_id").cast(kind))
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def op12(spark, sf_dir: str) -> DataFrame:
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP12_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{TERM}') AS w,
                  row_number() OVER () AS row FROM documents),
q AS (SELECT row_number() OVER () AS item, item_id,
             list_distinct(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{TERM}')) AS w FROM benchmark),
s AS (SELECT count(*) AS n, sum(len(w))::HUGEINT AS l FROM d WHERE len(w) > 0),
m AS (SELECT row, doc_id, 50 + (50 * len(w)::HUGEINT * n) // l AS m FROM d, s WHERE len(w) > 0),
t AS (SELECT row, term, count(*) AS tf FROM (SELECT row, unnest(w) AS term FROM d) GROUP BY ALL),
v AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS weight
      FROM (SELECT term, count(*) AS df FROM t GROUP BY term), s),
p AS (SELECT item, m.row, any_value(doc_id) AS doc_id,
             sum(weight * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
      FROM (SELECT item, unnest(w) AS term FROM q) JOIN v USING (term) JOIN t USING (term) JOIN m ON m.row = t.row
      GROUP BY item, m.row),
r AS (SELECT item, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
      FROM p WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM r JOIN q USING (item) WHERE rank <= {K}
"""
