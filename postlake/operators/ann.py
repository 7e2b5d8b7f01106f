"""Cosine search over a quantised cell index: approximate (K2, J3) and exact with pruning (K1).

The index cuts unit vectors into cells by two levels of centroids, trained on
bounded samples (``SAMPLE_ROWS`` rows for the first level and for the codes,
``CELL_SAMPLE`` rows of each first-level cell for the second); their number
follows from the number of rows.  Every row is indexed: its residual (vector
less centre) is product-quantised, one byte for each ``sub_dim`` numbers.

* ``search``: a query visits its ``nprobe`` nearest cells, scores their codes
  with one table of partial products a subspace (asymmetric distances), keeps
  a shortlist and ranks that by the exact similarity.  ``nprobe`` is measured
  when the index is built: the least number of cells that hold ``target`` of
  the exact neighbours of a sample of rows, so it is small where the vectors
  have clusters and large where they have none.
  Vectors are kept as 32-bit floats.
* ``exact_search``: a cell's centre and radius bound every similarity in it
  (q.x <= q.c + radius for unit q), cells are visited in the order of their
  bound, and those whose bound is below the k-th best similarity so far are
  never read.  The result is that of ``search.knn``.

Layout: ``codes`` (a few bytes a row, read by every search) and ``rows``
(vectors, read for the shortlist alone) in folders of first-level cells,
``payload`` as the rows came (joined to the hits), ``centroids`` with row
counts and radii, ``codebooks``, ``meta``; versioned like other snapshots.  Rows without a direction (zero, null or of
another dimension) stand in a reserved cell that every query visits.
Centroids (cells x dim numbers, ``max_cells`` at most) and codebooks (codes x
dim) are broadcast; rows and codes never are.  A cell of any size is dealt to
blocks, its queries to tiles, so a cell of copies doesn't grow a group.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.functions.vector import cosine_similarity
from postlake.operators.search import (ROW_KEY, TIE_DECIMALS, ZERO_CELL, _best, _blocks, _dealt, _final_topk, _queries, _search,
                                       _unit_rows, _with_payload, knn)
from postlake.session import materialise
from postlake.sources.lake import latest_version, marked, next_version, write_marker

SAMPLE_ROWS, CELL_SAMPLE, CALIBRATION_ROWS = 32_768, 8_192, 64
BLOCK_ROWS, TILE_QUERIES, SLICE_ROWS = 65_536, 256, 4096


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float32)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def _lists(x: np.ndarray) -> pa.Array:
    cuts = np.arange(len(x) + 1, dtype=np.int32) * (x.shape[1] if x.ndim == 2 else 0)
    return pa.ListArray.from_arrays(pa.array(cuts), pa.array(np.ascontiguousarray(x, np.float32).ravel()))


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _nearest(x: np.ndarray, centres: np.ndarray, chunk: int = 1 << 22) -> np.ndarray:
    half, step = (centres * centres).sum(1) / 2, max(1, chunk // max(1, len(centres)))
    return np.concatenate([np.argmax(x[a:a + step] @ centres.T - half, 1) for a in range(0, len(x), step)] or [np.zeros(0, np.int64)])


def lloyd(x: np.ndarray, k: int, seed: int, rounds: int = 12) -> np.ndarray:
    """At most ``k`` centres of the rows by Lloyd's algorithm; an empty cell takes the row farthest from its centre."""
    distinct = np.unique(x, axis=0)
    r = np.random.default_rng(seed)
    centres = distinct[np.sort(r.choice(len(distinct), min(k, len(distinct)), replace=False))].astype(np.float32)
    if len(centres) == len(distinct):
        return centres
    for _ in range(rounds):
        cell = _nearest(x, centres)
        count = np.bincount(cell, minlength=len(centres))
        sums = np.zeros((len(centres), x.shape[1]))
        np.add.at(sums, cell, x)
        some = count > 0
        centres[some] = (sums[some] / count[some, None]).astype(np.float32)
        if not some.all():
            far = np.argsort(-((x - centres[cell]) ** 2).sum(1), kind="stable")
            centres[~some] = x[far[:np.count_nonzero(~some)]]
    return centres


def _train(k: int, seed: int, group: str, vector: str):
    def run(key, rows):
        centres = lloyd(_matrix(rows.column(vector)), k, seed)
        return pa.table({group: pa.array([key[0].as_py()] * len(centres), pa.int32()), "number": pa.array(np.arange(len(centres), dtype=np.int32)),
                         "centre": _lists(centres)})
    return run


def _learn(df: DataFrame, k: int, seed: int, group: str) -> list:
    """Centres of each group of a bounded sample: (group, number, centre) rows, at most groups x k."""
    out = df.groupBy(group).applyInArrow(_train(k, seed, group, "vector"), f"{group} int, number int, centre array<float>")
    return sorted((r[group], r.number, r.centre) for r in out.collect())


def _sampled(df: DataFrame, rows: int, n: int, salt: int) -> DataFrame:
    """About ``rows`` of ``n`` rows by a hash of the row key; all of them if there are fewer."""
    return df if n <= rows else df.where(F.pmod(F.xxhash64(ROW_KEY, F.lit(salt)), F.lit(1 << 30)) < int(rows / n * (1 << 30)))


@dataclass
class Cells:
    """What a search needs of an index besides codes and rows; it is broadcast."""
    centres: np.ndarray     # (cells, dim)
    coarse: np.ndarray      # the first-level cell of each
    coarse_centres: np.ndarray
    books: np.ndarray       # (subspaces, codes, sub_dim)
    dim: int

    def parts(self, x: np.ndarray) -> np.ndarray:
        """(subspaces, rows, sub_dim), the last one filled up with zeros."""
        m, _, width = self.books.shape
        wide = np.zeros((len(x), m * width), np.float32)
        wide[:, :x.shape[1]] = x
        return wide.reshape(len(x), m, width).transpose(1, 0, 2)

    def place(self, x: np.ndarray) -> np.ndarray:
        """The cell of unit rows: the nearest of the children of the nearest first-level centre."""
        first, out = _nearest(x, self.coarse_centres), np.zeros(len(x), np.int64)
        for c in np.unique(first):
            mine, rows = np.flatnonzero(self.coarse == c), np.flatnonzero(first == c)
            out[rows] = mine[_nearest(x[rows], self.centres[mine])]
        return out

    def encode(self, residual: np.ndarray) -> np.ndarray:
        """(rows, subspaces) codes."""
        return np.stack([_nearest(p, b) for p, b in zip(self.parts(residual), self.books, strict=True)], 1).astype(np.uint8)

    def order(self, q: np.ndarray) -> np.ndarray:
        """(queries, cells) cells from near to far."""
        return np.argsort(-(q @ self.centres.T - (self.centres * self.centres).sum(1) / 2), axis=1, kind="stable")


def _assign(cells, with_codes: bool):
    def run(batches):
        index: Cells = cells.value
        for batch in batches:
            x = _unit(_matrix(batch.column("vector")))
            if batch.num_rows == 0:
                continue
            at = index.place(x)
            rest = x - index.centres[at]
            out = {"cell": pa.array(at.astype(np.int32)), "coarse": pa.array(index.coarse[at].astype(np.int32)),
                   "far": pa.array(np.sqrt((rest.astype(np.float64) ** 2).sum(1)))}
            if with_codes:
                out["codes"] = pa.array([c.tobytes() for c in index.encode(rest)], pa.binary())
            yield pa.record_batch({c: batch.column(c) for c in batch.schema.names} | out)
    return run


def build_index(vectors: DataFrame, path: str, id_col: str = "id", vec_col: str = "embedding", payload: Sequence[str] = (),
                rows_per_cell: int = 1000, min_cells: int = 16, max_cells: int = 16_384, sub_dim: int = 4, codes: int = 256,
                target: float = 0.97, k: int = 10, seed: int = 42, row_key: str | None = None) -> str:
    """Index every row of ``vectors``; returns the path of the new version.

    ``rows_per_cell`` sets the number of cells, between ``min_cells`` and
    ``max_cells``.  ``target`` and ``k`` set the default number of cells a
    search visits, measured on about ``CALIBRATION_ROWS`` rows.  ``row_key``
    names a long column of a written table that is never null and tells its
    rows apart; without one the rows are copied once.
    """
    spark, payload = vectors.sparkSession, list(payload)
    norm = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    source = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<float>").alias("vector"), *payload,
                            (F.col(row_key) if row_key else F.monotonically_increasing_id()).alias(ROW_KEY))
    if not row_key:
        source = materialise(source, "ann-rows")  # fixes the key
    data = source.select("id", "vector", ROW_KEY, norm.alias("_norm"))
    dim = data.where("_norm > 0").agg(F.max(F.size("vector")).alias("d")).first().d or 0
    whole = (F.col("_norm") > 0) & (F.size("vector") == dim) & (F.col("_norm") < float("inf"))
    full = data.where(whole)
    n = full.count()
    where = f"{path}/v={next_version(spark, path)}"
    wanted = min(max_cells, max(min_cells, math.ceil(n / rows_per_cell)))
    first = math.ceil(math.sqrt(wanted))
    index = Cells(np.zeros((0, dim), np.float32), np.zeros(0, np.int64), np.zeros((0, dim), np.float32), np.zeros((0, 0, sub_dim), np.float32), dim)
    if n:
        sample = _sampled(full, SAMPLE_ROWS, n, seed).select("vector", ROW_KEY)
        unit = sample.mapInArrow(_units, "vector array<float>, _all int")
        index.coarse_centres = np.array([c for *_, c in _learn(unit.withColumnRenamed("_all", "coarse"), first, seed, "coarse")], np.float32)
        index = _second_level(spark, full, n, index, math.ceil(wanted / first), seed)
        index.books = _codebooks(spark, sample, index, sub_dim, codes, seed)
        shared = spark.sparkContext.broadcast(index)
        kind = T.StructType([*full.schema.fields, T.StructField("cell", T.IntegerType()), T.StructField("coarse", T.IntegerType()),
                             T.StructField("far", T.DoubleType()), T.StructField("codes", T.BinaryType())])
        placed = full.mapInArrow(_assign(shared, True), kind)
    else:
        placed = data.where("false").withColumns({"cell": F.lit(0), "coarse": F.lit(0), "far": F.lit(0.0), "codes": F.lit(None).cast("binary")})
    rest = data.where(~F.coalesce(whole, F.lit(False))).withColumns({
        "cell": F.lit(ZERO_CELL), "coarse": F.lit(ZERO_CELL), "far": F.lit(0.0), "codes": F.lit(None).cast("binary")})
    placed = materialise(placed.unionByName(rest).drop("_norm"), "ann-placed")
    if payload:
        source.select(ROW_KEY, *payload).write.option("compression", "zstd").parquet(f"{where}/payload")
    sizes = {r.cell: (r.n, r.far) for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()}
    blocks = _blocks({c: v[0] for c, v in sizes.items()}, BLOCK_ROWS)
    dealt = _dealt(placed, blocks, "_block", ROW_KEY).repartition("coarse", "cell", "_block").sortWithinPartitions("cell").drop("_block", "far")
    for name, kept in (("codes", dealt.select("id", ROW_KEY, "cell", "codes", "coarse")), ("rows", dealt.drop("codes"))):
        (kept.write.partitionBy("coarse") if sizes else kept.write).parquet(f"{where}/{name}")  # folders of no rows hold no columns
    centres = [(c, int(index.coarse[c]) if c >= 0 else c, [float(x) for x in index.centres[c]] if c >= 0 else [], *sizes[c]) for c in sizes]
    spark.createDataFrame(centres, "cell int, coarse int, centre array<float>, n_rows long, radius double").write.parquet(f"{where}/centroids")
    books = [(s, j, [float(x) for x in c]) for s, book in enumerate(index.books) for j, c in enumerate(book)]
    spark.createDataFrame(books, "sub int, code int, centre array<float>").write.parquet(f"{where}/codebooks")
    nprobe, recall = _calibrated(placed.where(F.col("cell") >= 0), index, sorted(sizes), n, target, k, seed)
    spark.createDataFrame([(dim, sub_dim, nprobe, recall, n)], "dim int, sub_dim int, nprobe int, recall double, n_rows long").write.parquet(f"{where}/meta")
    write_marker(spark, where)
    return where


def _units(batches):
    for batch in batches:
        if batch.num_rows:
            yield pa.record_batch({"vector": _lists(_unit(_matrix(batch.column("vector")))), "_all": pa.array([0] * batch.num_rows, pa.int32())})


def _second_level(spark, full: DataFrame, n: int, index: Cells, children: int, seed: int) -> Cells:
    """Children of each first-level cell, from a sample of each that has the same bound whatever the cell's size."""
    firsts = Cells(index.coarse_centres, np.arange(len(index.coarse_centres)), index.coarse_centres, index.books, index.dim)
    shared = spark.sparkContext.broadcast(firsts)
    sample = _sampled(full, CELL_SAMPLE * len(firsts.centres), n, seed + 1).select("vector", ROW_KEY)
    kind = f"vector array<float>, {ROW_KEY} long, cell int, coarse int, far double"
    placed = materialise(sample.mapInArrow(_assign(shared, False), kind), "ann-sample")
    count = {r.coarse: r["count"] for r in placed.groupBy("coarse").count().collect()}  # a row a first-level cell
    share = F.element_at(F.create_map(*[F.lit(x) for c, m in count.items() for x in (c, int(min(1.0, CELL_SAMPLE / m) * (1 << 30)))]), F.col("coarse"))
    some = placed.where(F.pmod(F.xxhash64(ROW_KEY, F.lit(seed + 2)), F.lit(1 << 30)) < share)
    unit = some.mapInArrow(_kept_units, "vector array<float>, coarse int")
    found = _learn(unit, children, seed, "coarse")
    return Cells(np.array([c for *_, c in found], np.float32), np.array([g for g, *_ in found]), index.coarse_centres, index.books, index.dim)


def _kept_units(batches):
    for batch in batches:
        if batch.num_rows:
            yield pa.record_batch({"vector": _lists(_unit(_matrix(batch.column("vector")))), "coarse": batch.column("coarse")})


def _codebooks(spark, sample: DataFrame, index: Cells, sub_dim: int, codes: int, seed: int) -> np.ndarray:
    """(subspaces, codes, sub_dim): each subspace of the sample's residuals is trained in a task of its own."""
    m = math.ceil(index.dim / sub_dim)
    shared = spark.sparkContext.broadcast(Cells(index.centres, index.coarse, index.coarse_centres, np.zeros((m, 1, sub_dim), np.float32), index.dim))

    def cut(batches):
        cells: Cells = shared.value
        for batch in batches:
            x = _unit(_matrix(batch.column("vector")))
            if batch.num_rows:
                parts = cells.parts(x - cells.centres[cells.place(x)])
                yield pa.record_batch({"sub": pa.array(np.repeat(np.arange(m, dtype=np.int32), len(x))), "vector": _lists(parts.reshape(-1, sub_dim))})

    found = _learn(sample.mapInArrow(cut, "sub int, vector array<float>"), codes, seed, "sub")
    books = np.zeros((m, max(j for _, j, _ in found) + 1, sub_dim), np.float32)
    for s in range(m):
        mine = [c for g, _, c in found if g == s]
        books[s] = np.array([mine[min(j, len(mine) - 1)] for j in range(books.shape[1])], np.float32)  # short books repeat their last code
    return books


def _calibrated(placed: DataFrame, index: Cells, cells: list[int], n: int, target: float, k: int, seed: int) -> tuple[int, float]:
    """The least number of cells that hold ``target`` of the exact neighbours of a sample of rows, and the share they hold."""
    if not n:
        return 1, 1.0
    asked = materialise(_sampled(placed, CALIBRATION_ROWS, n, seed + 3).select(F.col(ROW_KEY).alias("query_id"), F.col("vector").alias("embedding")).limit(4 * CALIBRATION_ROWS), "ann-asked")
    queries = {r.query_id: r.embedding for r in asked.collect()}
    if not queries:
        return len(index.centres), 1.0
    rows = placed.select(F.col(ROW_KEY).alias("id"), F.col("vector").alias("embedding"), "cell")
    near = knn(rows, asked, k=k, payload=["cell"], row_key="id").select("query_id", "cell").collect()  # k rows a query of the sample
    names = list(queries)
    order = index.order(_unit(np.array([queries[q] for q in names], np.float32)))
    rank = np.argsort(order, axis=1)
    at = {q: i for i, q in enumerate(names)}
    needed = np.sort([rank[at[r.query_id], r.cell] for r in near])
    nprobe = int(needed[min(len(needed), math.ceil(target * len(needed))) - 1]) + 1
    return nprobe, float((needed < nprobe).mean())


# ------------------------------------------------------------------ searching

@dataclass
class Index:
    where: str
    cells: Cells
    sizes: dict[int, int]
    radius: dict[int, float]
    nprobe: int
    recall: float


def open_index(spark: SparkSession, path: str) -> Index:
    """The newest version's centroids and codebooks (bounded by ``max_cells`` and the codes) and its measured settings."""
    where = f"{path}/v={latest_version(spark, path)}"
    meta = spark.read.parquet(f"{where}/meta").first()
    rows = sorted(spark.read.parquet(f"{where}/centroids").collect())
    real = [r for r in rows if r.cell >= 0]
    width = meta.dim
    # cells are numbered without gaps when they are trained; one that no row chose stands here without rows
    count = max((r.cell for r in real), default=-1) + 1
    centres, coarse = np.full((count, width), np.inf, np.float32), np.full(count, ZERO_CELL)
    for r in real:
        centres[r.cell], coarse[r.cell] = r.centre, r.coarse
    books = sorted(spark.read.parquet(f"{where}/codebooks").collect())
    m = max((b["sub"] for b in books), default=-1) + 1
    table = np.zeros((m, len(books) // m if m else 0, meta.sub_dim), np.float32)
    for b in books:
        table[b["sub"], b.code] = b.centre
    return Index(where, Cells(centres, coarse, np.zeros((0, width), np.float32), table, width), {r.cell: r.n_rows for r in rows},
                 {r.cell: r.radius for r in rows}, meta.nprobe, meta.recall)


def _payload(spark: SparkSession, index: Index) -> DataFrame:
    """Where the rows' payload stands; in indexes built earlier, beside the vectors."""
    return spark.read.parquet(f"{index.where}/{'payload' if marked(spark, index.where, 'payload') else 'rows'}")


def _probes(index: Index, asked: DataFrame, nprobe: int | None) -> DataFrame:
    """(query_id, cell, near, bound) of each query's cells: the ``nprobe`` nearest, or all with their bounds; and the reserved cell."""
    real = np.array([c for c in sorted(index.sizes) if c >= 0], np.int64)
    centres = index.cells.centres[real].astype(np.float64)
    radius = np.array([index.radius[c] for c in real.tolist()])
    shared = asked.sparkSession.sparkContext.broadcast((real, centres, radius, index.cells.dim, ZERO_CELL in index.sizes))

    def run(batches):
        real, centres, radius, dim, reserved = shared.value
        half = (centres * centres).sum(1) / 2
        for batch in batches:
            for name, vector in zip(batch.column("query_id"), batch.column("vector"), strict=True):
                q = np.array(vector.as_py() or [], np.float64)
                size = np.sqrt((q * q).sum()) if len(q) == dim else 0.0
                if size > 0:
                    near = centres @ (q / size)
                    chosen = np.argsort(half - near, kind="stable")[:nprobe]
                    bound = (near + radius)[chosen]
                else:  # no direction: no similarity to any row, wherever it stands
                    near, chosen = np.zeros(len(real)), np.arange(len(real))
                    bound = np.full(len(real), np.inf)
                cells, bases, bounds = real[chosen], near[chosen], bound
                if reserved:
                    cells, bases, bounds = np.append(cells, ZERO_CELL), np.append(bases, 0.0), np.append(bounds, np.inf)
                if len(cells):
                    yield pa.record_batch({"query_id": pa.array([name.as_py()] * len(cells), batch.schema.field("query_id").type),
                                           "cell": pa.array(cells.astype(np.int32)), "near": pa.array(bases), "bound": pa.array(bounds)})

    kind = T.StructType([asked.schema["query_id"], T.StructField("cell", T.IntegerType()), T.StructField("near", T.DoubleType()), T.StructField("bound", T.DoubleType())])
    return materialise(asked.select("query_id", "vector").mapInArrow(run, kind), "ann-probes")


def _paired(spark, index: Index, rows: DataFrame, there: DataFrame, block_rows: int, tile_queries: int) -> tuple[DataFrame, DataFrame]:
    """Rows by block and queries by tile of each probed cell, each side as often as the other has parts."""
    probed = {r.cell: r["count"] for r in there.groupBy("cell").count().collect()}  # a row a cell
    sizes = {c: n for c, n in index.sizes.items() if c in probed}
    blocks, tiles = _blocks(sizes, block_rows), _blocks({c: probed[c] for c in sizes}, tile_queries)
    counts = F.broadcast(spark.createDataFrame([(c, blocks[c], tiles[c]) for c in sizes], "cell int, _blocks int, _tiles int"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    folders = sorted({int(index.cells.coarse[c]) if c >= 0 else ZERO_CELL for c in sizes})
    rows = rows.where(F.col("coarse").isin([str(c) for c in folders])).drop("coarse").where(F.col("cell").isin(list(sizes)))
    here = _dealt(rows, blocks, "_block", ROW_KEY).join(counts, "cell").withColumn("_tile", each("_tiles")).drop("_blocks", "_tiles")
    there = _dealt(there, tiles, "_tile", "query_id").join(counts, "cell").withColumn("_block", each("_blocks")).drop("_blocks", "_tiles")
    return here, there


def _code_scores(cells: Cells, q: np.ndarray, near: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """(queries, rows) similarities of the queries to the rows' codes; ``near`` is each query's similarity to the cell's centre."""
    scores = np.repeat(near.astype(np.float32)[:, None], len(codes), 1)
    for s, (part, book) in enumerate(zip(cells.parts(q), cells.books, strict=True)):
        scores += (part @ book.T)[:, codes[:, s]]
    return scores


def _cosines(asked: list, vectors: list) -> np.ndarray:
    """(queries, rows) exact similarities; NaN where the lengths differ or a side has no direction."""
    out = np.full((len(asked), len(vectors)), np.nan)
    for size in {len(v) for v in asked if v is not None} & {len(v) for v in vectors if v is not None}:
        at, here = ([j for j, v in enumerate(side) if v is not None and len(v) == size] for side in (asked, vectors))
        (q, q_ok), (x, x_ok) = _unit_rows([asked[j] for j in at], size), _unit_rows([vectors[j] for j in here], size)
        similar = q @ x.T
        similar[~q_ok[:, None] | ~x_ok[None, :]] = np.nan
        out[np.ix_(at, here)] = similar
    return out


def _shortlisted(shared, shortlist: int, tile_queries: int, best: int | None = None):
    """One block of a cell and one tile of its queries: the rows of the best code scores.

    With ``best`` the shortlist holds every row, whose vectors stand beside the codes: the ``best`` rows by the exact similarity
    are passed on, from slices of ``SLICE_ROWS`` rows.
    """
    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        cells: Cells = shared.value
        names, keys, found = queries.column("query_id").combine_chunks(), rows.column(ROW_KEY).to_numpy(), []
        ids = rows.column("id").to_numpy()
        if len(keys) and len(names):
            by_id = np.argsort(ids, kind="stable")
            coded = rows.column("codes").null_count == 0
            m = len(cells.books)
            codes = np.frombuffer(b"".join(rows.column("codes").to_pylist()), np.uint8).reshape(-1, m)[by_id] if coded else None
            exact = rows.column("_vector").combine_chunks().to_numpy(zero_copy_only=False)[by_id] if best else None
            for a in range(0, len(names), tile_queries):
                vectors = queries.column("vector").slice(a, tile_queries).to_pylist()
                near = queries.column("near").slice(a, tile_queries).to_numpy()
                q = np.zeros((len(vectors), cells.dim), np.float32)
                for j, v in enumerate(vectors):
                    if v is not None and len(v) == cells.dim and (size := np.sqrt(np.square(np.array(v, float)).sum())) > 0:
                        q[j] = np.array(v, float) / size
                held = []
                for b in range(0, len(keys), SLICE_ROWS if best else len(keys)):
                    some = slice(b, b + SLICE_ROWS) if best else slice(None)
                    n = len(keys[some])
                    scores = _code_scores(cells, q, near, codes[some]) if coded else np.full((len(q), n), -np.inf, np.float32)
                    if best:
                        similar = _cosines(vectors, list(exact[some]))
                        top = _best(similar, np.arange(n), best)  # rows in id order
                    else:
                        similar = None
                        top = np.argsort(-scores, axis=1, kind="stable")[:, :shortlist]  # rows in id order: ties go to smaller ids
                    held.append((b + top, *(np.take_along_axis(x, top, 1) if x is not None else np.full(top.shape, np.nan) for x in (scores, similar))))
                top, scores, similar = (np.concatenate([h[j] for h in held], axis=1) for j in range(3))
                if best and top.shape[1] > best:
                    of = _best(similar, np.arange(top.shape[1]), best)  # slices follow each other in id order
                    top, scores, similar = (np.take_along_axis(x, of, 1) for x in (top, scores, similar))
                found.append((a + np.repeat(np.arange(len(q)), top.shape[1]), by_id[top.ravel()], scores.ravel(), similar.ravel()))
        kinds = (np.int64, np.int64, np.float64, np.float64)
        at_q, at_r, scores, similar = (np.concatenate([f[j] for f in found]) if found else np.zeros(0, kind) for j, kind in enumerate(kinds))
        out = {"query_id": names.take(pa.array(at_q)), "id": rows.column("id").take(pa.array(at_r)), ROW_KEY: pa.array(keys[at_r], pa.int64()),
               "cell": rows.column("cell").take(pa.array(at_r)), "near": pa.array(scores.astype(np.float64))}
        return pa.table(out | {"similarity": pa.array(similar, from_pandas=True)} if best else out)
    return run


def search(spark: SparkSession, path: str, queries: DataFrame, k: int = 10, nprobe: int | None = None, shortlist: int | None = None,
           id_col: str = "id", query_id: str = "query_id", query_vec: str = "embedding", k_col: str | None = None,
           payload: Sequence[str] = (), block_rows: int = BLOCK_ROWS, tile_queries: int = TILE_QUERIES) -> DataFrame:
    """K2: approximate top-k -> ``(query_id, id, *payload, similarity, rank)``; similarities are exact.

    ``nprobe`` cells are visited (by default as many as the index measured),
    the best ``shortlist`` rows by their codes (20 * k, 200 at least) are ranked
    exactly.  With all cells and a shortlist of all rows the result is that of
    ``knn``.  A query without a direction visits every cell.

    A shortlist of all rows isn't written out pair by pair: each block ranks
    its rows exactly and passes on the best k of a query, so the work is that
    of all pairs, the rows between the steps are queries x blocks x k at most.
    """
    payload, index = list(payload), open_index(spark, path)
    asked = _queries(queries, query_id, query_vec, k_col, k)
    kmax = int(asked.agg(F.max("k").alias("k")).first().k or k)
    shortlist = shortlist or max(200, 20 * kmax)
    probes = _probes(index, asked, index.nprobe if nprobe is None else nprobe)
    shared = spark.sparkContext.broadcast(index.cells)
    codes = spark.read.parquet(f"{index.where}/codes")
    rows = spark.read.parquet(f"{index.where}/rows").select("id", ROW_KEY, F.col("vector").alias("_vector"))
    every = shortlist >= sum(index.sizes.values())
    if every:
        codes = codes.join(rows.select(ROW_KEY, "_vector"), ROW_KEY)
    here, there = _paired(spark, index, codes, probes.join(asked, "query_id").select("query_id", "vector", "cell", "near"), block_rows, tile_queries)
    kind = T.StructType([asked.schema["query_id"], codes.schema["id"], T.StructField(ROW_KEY, T.LongType()), T.StructField("cell", T.IntegerType()),
                         T.StructField("near", T.DoubleType()), *([T.StructField("similarity", T.DoubleType())] if every else [])])
    keys = ["cell", "_block", "_tile"]
    near = here.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInArrow(
        _shortlisted(shared, shortlist, tile_queries, kmax if every else None), kind)
    order = [F.desc_nulls_last(F.round("similarity", TIE_DECIMALS)), F.asc("id")] if every else [F.desc("near"), F.asc("id")]
    best = Window.partitionBy("query_id").orderBy(*order)
    chosen = near.withColumn("_n", F.row_number().over(best)).where(F.col("_n") <= F.lit(kmax if every else shortlist)).select("query_id", ROW_KEY)
    ranked = (rows.join(materialise(chosen, "ann-chosen"), ROW_KEY).join(asked, "query_id")
              .withColumn("similarity", F.when(F.size("_vector") == F.size("vector"), cosine_similarity("_vector", "vector")))
              .select("query_id", "id", ROW_KEY, "similarity", "k"))
    return _with_payload(_final_topk(ranked, kmax), _payload(spark, index), payload, id_col)


def exact_search(spark: SparkSession, path: str, queries: DataFrame, k: int = 10, nprobe: int | None = None, id_col: str = "id",
                 query_id: str = "query_id", query_vec: str = "embedding", payload: Sequence[str] = (),
                 block_rows: int = 4096, tile_queries: int = 1024) -> tuple[DataFrame, int]:
    """K1: the hits of ``knn`` -> (``(query_id, id, *payload, similarity, rank)``, number of (query, row) pairs scored).

    First each query's ``nprobe`` cells of the highest bound are read, then
    those others whose bound reaches the k-th similarity found.
    """
    payload, index = list(payload), open_index(spark, path)
    asked = _queries(queries, query_id, query_vec, None, k)
    probes = _probes(index, asked, None)
    nprobe = nprobe or max(1, math.isqrt(len(index.sizes)))
    ahead = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("bound"), "cell")) <= nprobe
    probes = materialise(probes.withColumn("_first", ahead | (F.col("cell") == ZERO_CELL)), "ann-bounds")
    rows = spark.read.parquet(f"{index.where}/rows").select("id", F.col("vector").cast("array<double>").alias("vector"), ROW_KEY, "cell", "coarse")

    def scored(some: DataFrame, name: str) -> DataFrame:
        here, there = _paired(spark, index, rows, some.join(asked, "query_id").select("query_id", "vector", "k", "cell"), block_rows, tile_queries)
        out = _search(here, there, ["cell", "_block", "_tile"], k, [ROW_KEY], "id", rows.schema["id"].dataType,
                      asked.schema["query_id"].dataType, tile_queries, block_rows)
        return materialise(out, name)

    first = scored(probes.where("_first"), "ann-first")
    floor = first.groupBy("query_id").agg(F.min(F.when(F.col("rank") == k, F.col("similarity"))).alias("_floor"))
    more = materialise(probes.where(~F.col("_first")).join(floor, "query_id", "left")
                       .where(F.coalesce(F.col("bound") >= F.col("_floor") - 1e-6, F.lit(True))).select("query_id", "cell"), "ann-more")
    second = scored(more, "ann-second")
    sizes = spark.createDataFrame(list(index.sizes.items()), "cell int, n long")
    count = (probes.where("_first").select("cell").unionByName(more.select("cell")).groupBy("cell").count().join(F.broadcast(sizes), "cell")
             .agg(F.coalesce(F.sum(F.col("count") * F.col("n")), F.lit(0))).first()[0])
    both = first.drop("rank").unionByName(second.drop("rank")).withColumn("k", F.lit(k).cast("long"))
    return _with_payload(_final_topk(both, k), _payload(spark, index), payload, id_col), int(count)
