"""Cosine search (K1..K4, T18, D5, J2, J3).

Exact top-k (K1) works in blocks: vectors are dealt to blocks of about
``block_rows``, queries to tiles of about ``tile_queries``, and every (block,
tile) cell is one grouped task that multiplies the two matrices and returns
the best ``k`` rows of each of its queries.  Neither side is collected or
broadcast, a cell's product matrix has a fixed size, and no (query, vector)
pair becomes a row.  The winners of up to ``merge_blocks`` blocks are merged
in the task that computed them (a task takes a run of blocks); the final
top-k per query is a window over those, cut before the shuffle by the
literal largest k.  A payload stays behind and is joined to the winners, which
are written for that.

Approximate top-k (K2) is an IVF index: k-means cells over unit vectors, kept
with their centroids as versioned snapshots; rows without a direction (zero
vectors) stay in a reserved cell that every query probes.  Each query goes to
its ``nprobe`` nearest cells, and the same cell-wise search runs there: the
rows of an index cell are dealt to blocks and its queries to tiles, as many
as their counts need, by keys that tell equal rows apart.  A query gets fewer than k hits if its probed cells hold fewer rows.

Ordering everywhere: similarity descending, NULL (zero vector) last, then
id ascending.  Similarities equal to ``TIE_DECIMALS`` places are ties (so
exact copies rank by id whatever the summation order of the hardware).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlake.session import materialise
from postlake.sources.lake import latest_version, next_version, write_marker

TIE_DECIMALS = 9
ZERO_CELL = -1
ROW_KEY = "_row"
BLOCK_ROWS, MERGE_BLOCKS, SUB_BLOCKS = 4096, 16, 4


def _unit_rows(vectors: list, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Unit rows and whether each has a direction (right length, not zero)."""
    out = np.zeros((len(vectors), dim))
    good = np.array([v is not None and len(v) == dim for v in vectors], bool)
    if good.any():
        out[good] = np.stack([np.asarray(v, dtype=np.float64) for v, g in zip(vectors, good, strict=True) if g])
    norm = np.sqrt((out * out).sum(axis=1))
    return np.divide(out, norm[:, None], out=out, where=norm[:, None] > 0), norm > 0


def _best(similar: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """(n_queries, min(k, rows)) row numbers by similarity descending, id ascending; NaN last."""
    ranked = np.where(np.isnan(similar), -np.inf, np.round(similar, TIE_DECIMALS))
    by_id = np.argsort(ids, kind="stable")
    # a stable sort of the negated similarities over rows in id order breaks ties by id
    order = np.argsort(-ranked[:, by_id], axis=1, kind="stable")[:, :k]
    return by_id[order]


def _cell(kmax: int, payload: list[str], tile_queries: int, block_rows: int):
    """One group: the best rows of each of its queries among its vectors, in slices of fixed size."""
    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({c: [] for c in ["query_id", "id", *payload, "similarity", "k"]})
        if rows.empty or queries.empty:
            return empty
        dim = max((len(v) for v in queries["vector"] if v is not None), default=0)
        found = []
        for a in range(0, len(queries), tile_queries):
            asked = queries.iloc[a:a + tile_queries]
            q, q_ok = _unit_rows(asked["vector"].tolist(), dim)
            held: list[pd.DataFrame] = []
            for b in range(0, len(rows), block_rows):
                some = rows.iloc[b:b + block_rows]
                v, v_ok = _unit_rows(some["vector"].tolist(), dim)
                similar = q @ v.T
                similar[~q_ok[:, None] | ~v_ok[None, :]] = np.nan
                top = _best(similar, some["id"].to_numpy(), kmax)
                at = np.repeat(np.arange(len(asked)), top.shape[1])
                part = some.iloc[top.ravel()][["id", *payload]].reset_index(drop=True)
                part["similarity"] = similar[at, top.ravel()]
                part["_q"] = at
                held.append(part)
            whole = pd.concat(held, ignore_index=True)
            whole["_s"] = np.where(whole["similarity"].isna(), -np.inf, whole["similarity"].round(TIE_DECIMALS))
            whole = whole.sort_values(["_q", "_s", "id"], ascending=[True, False, True], kind="stable")
            whole = whole[whole.groupby("_q").cumcount() < kmax]
            whole.insert(0, "query_id", asked["query_id"].to_numpy()[whole["_q"]])
            whole["k"] = asked["k"].to_numpy()[whole["_q"]]
            found.append(whole.drop(columns=["_q", "_s"]))
        return pd.concat(found, ignore_index=True)
    return run


def _final_topk(partial: DataFrame, kmax: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.desc_nulls_last(F.round("similarity", TIE_DECIMALS)), F.asc("id"))
    return (partial.withColumn("similarity", F.when(~F.isnan("similarity"), F.col("similarity")))
                   .withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= F.lit(kmax))  # literal: a limit per group
                   .where(F.col("rank") <= F.col("k")).drop("k"))


def _search(rows: DataFrame, queries: DataFrame, keys: list[str], kmax: int, payload: list[str], id_name: str, id_type,
            query_type, tile_queries: int, block_rows: int) -> DataFrame:
    schema = T.StructType([T.StructField("query_id", query_type), T.StructField("id", id_type)]
                          + [rows.schema[c] for c in payload]
                          + [T.StructField("similarity", T.DoubleType()), T.StructField("k", T.LongType())])
    partial = (rows.groupBy(*keys).cogroup(queries.groupBy(*keys))
               .applyInPandas(_cell(kmax, payload, tile_queries, block_rows), schema))
    return _final_topk(partial, kmax).withColumnRenamed("id", id_name)


def _queries(queries: DataFrame, query_id: str, query_vec: str, k_col: str | None, k: int) -> DataFrame:
    """The query set, evaluated once: (query_id, vector, k)."""
    wanted = F.col(k_col).cast("long") if k_col else F.lit(k).cast("long")
    return materialise(queries.select(F.col(query_id).alias("query_id"), F.col(query_vec).cast("array<double>").alias("vector"),
                                      wanted.alias("k")), "queries")


def _with_payload(hits: DataFrame, rows: DataFrame, payload: list[str], id_col: str) -> DataFrame:
    """The winners with their rows' payload.  They are written first: by their size the join needn't shuffle the payload of all rows."""
    if payload:
        hits = materialise(hits, "hits").join(rows.select(ROW_KEY, *payload), ROW_KEY)
    return hits.select("query_id", F.col("id").alias(id_col), *payload, "similarity", "rank")


def knn(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "id", vec_col: str = "embedding",
        query_id: str = "query_id", query_vec: str = "embedding", k_col: str | None = None,
        payload: Sequence[str] = (), block_rows: int = 4096, tile_queries: int = 1024, merge_blocks: int = 4,
        row_key: str | None = None) -> DataFrame:
    """K1: exact cosine top-k per query -> ``(query_id, id, *payload, similarity, rank)``.

    ``row_key`` names a column of a written table that is never null and
    tells its rows apart; without one the vectors are copied once.
    """
    payload = list(payload)
    # floats stay floats on the way and become doubles in the cell
    vector = F.col(vec_col) if vectors.schema[vec_col].dataType == T.ArrayType(T.FloatType()) else F.col(vec_col).cast("array<double>")
    # the payload waits under a key until the winners are known
    rows = vectors.select(F.col(id_col).alias("id"), vector.alias("vector"), *payload,
                          (F.col(row_key) if row_key else F.monotonically_increasing_id()).alias(ROW_KEY))
    if not row_key:
        rows = materialise(rows, "vectors")  # fixes the key
    asked = _queries(queries, query_id, query_vec, k_col, k)
    size = asked.agg(F.count(F.lit(1)).alias("n"), F.max("k").alias("k")).first()
    groups = max(1, math.ceil(rows.count() / (block_rows * merge_blocks)))
    tiles = max(1, math.ceil(size.n / tile_queries))
    # a group of blocks meets a tile in one task; each side goes as often as the other has parts
    here = rows.drop(*payload).withColumn("_group", F.pmod(F.xxhash64("id", "vector"), F.lit(groups)).cast("int")).withColumn(
        "_tile", F.explode(F.sequence(F.lit(0), F.lit(tiles - 1))))
    there = asked.withColumn("_tile", F.pmod(F.xxhash64("query_id"), F.lit(tiles)).cast("int")).withColumn(
        "_group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1))))
    hits = _search(here, there, ["_group", "_tile"], int(size.k or k), [ROW_KEY], "id", vectors.schema[id_col].dataType,
                   queries.schema[query_id].dataType, tile_queries, block_rows)
    return _with_payload(hits, rows, payload, id_col)


# ------------------------------------------------------------------ IVF (K2)

def _blocks(sizes: dict[int, int], rows: int, least: int = 1) -> dict[int, int]:
    """The number of parts of each cell that hold about ``rows`` rows at most."""
    return {cell: max(least, math.ceil(n / rows)) for cell, n in sizes.items()}


def _dealt(df: DataFrame, parts: dict[int, int], name: str, key: str) -> DataFrame:
    """``df`` with the part of its cell that a hash of ``key`` deals each row to; as many parts as ``parts`` has for the cell."""
    counts = F.broadcast(df.sparkSession.createDataFrame(list(parts.items()), "cell int, _parts long"))  # a row per cell
    return df.join(counts, "cell").withColumn(name, F.pmod(F.xxhash64(key), "_parts").cast("int")).drop("_parts")


def build_ivf(vectors: DataFrame, path: str, cells: int = 16, id_col: str = "id", vec_col: str = "embedding",
              seed: int = 42, max_iter: int = 20) -> str:
    """K2 index: k-means (cosine) over all vectors; returns the path of the new version,
    with the rows by ``cell``, the ``centroids`` (cells x dim numbers) and the ``sizes`` of the cells."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    spark = vectors.sparkSession
    norm = F.aggregate(vec_col, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    # a key of its own for every row, fixed by the write: equal rows can be dealt apart
    data = materialise(vectors.withColumns({"_norm": norm, ROW_KEY: F.monotonically_increasing_id()}), "ivf")
    full = data.where("_norm > 0").withColumn("_features", array_to_vector(F.col(vec_col)))
    where = f"{path}/v={next_version(spark, path)}"
    cached = full.select("_features").cache()
    model = KMeans(k=cells, seed=seed, maxIter=max_iter, featuresCol="_features", predictionCol="cell",
                   distanceMeasure="cosine").fit(cached)
    cached.unpersist()
    placed = model.transform(full).drop("_features").unionByName(
        data.where("_norm IS NULL OR NOT _norm > 0").withColumn("cell", F.lit(ZERO_CELL))).drop("_norm")
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n_rows")).collect()  # a row per cell
    spark.createDataFrame(sizes, "cell int, n_rows long").write.parquet(f"{where}/sizes")
    # dealt by cell and block: few files a cell, and a large cell in as many tasks as its rows need
    blocks = _blocks({r.cell: r.n_rows for r in sizes}, BLOCK_ROWS * MERGE_BLOCKS, SUB_BLOCKS)
    (_dealt(placed, blocks, "_block", ROW_KEY).repartition("cell", "_block").drop("_block")
     .write.partitionBy("cell").parquet(f"{where}/rows"))
    centres = [(i, [float(x) for x in c]) for i, c in enumerate(model.clusterCenters())]
    spark.createDataFrame(centres, "cell int, centre array<double>").write.parquet(f"{where}/centroids")
    write_marker(spark, where)
    return where


def ivf_search(spark: SparkSession, index_path: str, queries: DataFrame, k: int = 10, nprobe: int = 4, id_col: str = "id",
               vec_col: str = "embedding", query_id: str = "query_id", query_vec: str = "embedding",
               payload: Sequence[str] = (), sub_blocks: int = SUB_BLOCKS, block_rows: int = BLOCK_ROWS, tile_queries: int = 1024,
               merge_blocks: int = MERGE_BLOCKS) -> DataFrame:
    """K2: approximate cosine top-k over the newest version, probing the ``nprobe`` nearest cells.

    A cell is dealt to blocks of about ``block_rows * merge_blocks`` rows (``sub_blocks`` of them at least), its
    queries to tiles of about ``tile_queries``: a group has a fixed bound whatever the table or its largest cell.
    """
    where = f"{index_path}/v={latest_version(spark, index_path)}"
    payload = list(payload)
    rows = spark.read.parquet(f"{where}/rows").withColumn("cell", F.col("cell").cast("int"))
    asked = _queries(queries, query_id, query_vec, None, k)
    dot = lambda a, b: F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    # bounded by the index: cells x dim numbers
    centres = spark.read.parquet(f"{where}/centroids").agg(F.collect_list(F.struct("cell", "centre")).alias("c"))
    near = asked.join(F.broadcast(centres)).withColumn("_by", F.sort_array(F.transform("c", lambda c: F.struct(
        (dot(c["centre"], F.col("vector")) / F.sqrt(dot(c["centre"], c["centre"]))).alias("s"), (-c["cell"]).alias("cell"))),
        asc=False))
    probes = F.concat(F.transform(F.slice("_by", 1, nprobe), lambda c: -c["cell"]), F.array(F.lit(ZERO_CELL)))
    near = materialise(near.select("query_id", "vector", "k", probes.alias("cells")), "probes")
    there = near.select("query_id", "vector", "k", F.explode("cells").alias("cell"))
    probed = {r.cell: r["count"] for r in there.groupBy("cell").count().collect()}  # at most the index's cells
    sizes = {r.cell: r.n_rows for r in spark.read.parquet(f"{where}/sizes").collect() if r.cell in probed}
    blocks, tiles = _blocks(sizes, block_rows * merge_blocks, sub_blocks), _blocks(probed, tile_queries)
    # a block of a cell meets a tile of its queries in one group; each side goes as often as the other has parts
    counts = F.broadcast(spark.createDataFrame([(c, blocks[c], tiles[c]) for c in sizes], "cell int, _blocks int, _tiles int"))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    here = (_dealt(rows.where(F.col("cell").isin(list(sizes)))  # prunes the folders of other cells
                   .select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vector"), "cell", ROW_KEY, *payload),
                   blocks, "_block", ROW_KEY)
            .join(counts, "cell").withColumn("_tile", each("_tiles")).drop("_blocks", "_tiles", ROW_KEY))
    there = (_dealt(there, {c: tiles[c] for c in sizes}, "_tile", "query_id")
             .join(counts, "cell").withColumn("_block", each("_blocks")).drop("_blocks", "_tiles"))
    return _search(here, there, ["cell", "_block", "_tile"], k, payload, id_col, rows.schema[id_col].dataType,
                   queries.schema[query_id].dataType, tile_queries, block_rows)


def recall_at_k(approx: DataFrame, exact: DataFrame, id_col: str = "id") -> float:
    """Share of exact hits the approximate search also returns."""
    hit = exact.join(approx.select("query_id", id_col), ["query_id", id_col], "left_semi").count()
    total = exact.count()
    return hit / total if total else 1.0


def by_author_recent(df: DataFrame, n: int = 5, author: str = "by_author", ts: str = "created_ts",
                     id_col: str = "id") -> DataFrame:
    """K4: each author's ``n`` most recent items (partial top-n before the shuffle)."""
    from postlake.operators.curate import top_n_per_group
    return top_n_per_group(df, author, n, [F.desc_nulls_last(ts), F.asc(id_col)])
