"""Connected components of an edge table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlake.llm.common import hot_join, written


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of ``edges`` (columns u, v long); root is the smallest node.

    Each round links every node's larger neighbours to its smallest one
    (large star), then every node and its smaller neighbours to the smallest
    (small star); the rounds grow with the logarithm of the longest path.
    Minima are aggregated before the shuffle and joined back by parts of
    bounded size (``hot_join``), so a hub's edges are never gathered; every
    round is a written table.  Repeated edges, loops and an empty table are
    fine.
    """
    now = written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                  "edges")
    before = _print_of(now)
    for _ in range(max_rounds):
        if before[0] == 0:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        above = F.count_if(F.col("v") > F.col("u"))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"), above.alias("_n"))
        large = (hot_join(both.where("v > u"), low, "u", before[0]).select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("_n"))
        small = (hot_join(large, low, "u", before[0]).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = written(small, "edges")
        after = _print_of(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
