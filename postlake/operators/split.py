"""Reproducible stratified train/test split (M1).

Each row gets a 32-bit hash of ``id:seed`` (md5, so SQL engines can
reproduce it).  Per class, the ``ceil(fraction * n_class)`` rows with the
smallest ``(hash, id)`` form the test set: exact class proportions, the
same rows on every run, independent of partitioning.

Finding the cut without sorting a whole class in one task: the input is
read once for the narrow rows ``(label, id, hash)``, written to the shared
folder; the high 16 bits of the hash give 65,536 buckets; bucket counts per
class locate the one bucket that straddles the cut, and only rows of that
bucket are ranked.  The limit ``(hash, id)`` of each class, one row per
class, is then compared with every row in a single pass over the features.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from postlake.session import materialise

HASH_BITS = 32
BUCKET_SHIFT = 16


def split_hash(id_col: str = "id", seed: int = 42) -> Column:
    h = F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def stratified_split(df: DataFrame, label: str, id_col: str = "id", test_fraction: float = 0.2,
                     seed: int = 42, split_col: str = "split") -> DataFrame:
    """Adds ``split`` in {'train', 'test'}; a null label is train.  Rows of one id are split alike."""
    narrow = materialise(df.select(F.col(label).alias("_label"), F.col(id_col).alias("_id"),
                                   split_hash(id_col, seed).alias("_h")), "split")
    bucketed = narrow.withColumn("_bk", F.shiftright("_h", BUCKET_SHIFT))
    counts = bucketed.groupBy("_label", "_bk").agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy("_label").orderBy("_bk").rowsBetween(Window.unboundedPreceding, 0)
    cum = (counts.withColumn("_cum", F.sum("_c").over(w))
                 .withColumn("_n", F.sum("_c").over(Window.partitionBy("_label")))
                 .withColumn("_k", F.ceil(F.col("_n") * F.lit(test_fraction)).cast("long")))
    # per class: the bucket where the cumulative count reaches k, and rows still needed there
    cut = (cum.where((F.col("_cum") >= F.col("_k")) & (F.col("_cum") - F.col("_c") < F.col("_k")))
              .select("_label", "_bk", (F.col("_k") - (F.col("_cum") - F.col("_c"))).alias("_need")))
    rank = F.row_number().over(Window.partitionBy("_label").orderBy("_h", "_id"))
    # at most (number of classes) rows: size bounded by the label domain
    limit = (bucketed.join(F.broadcast(cut), ["_label", "_bk"]).withColumn("_r", rank).where("_r = _need")
             .select(F.col("_label").alias("_of"), F.col("_h").alias("_limit_h"), F.col("_id").alias("_limit_id")))
    here = split_hash(id_col, seed)
    test = (here < F.col("_limit_h")) | ((here == F.col("_limit_h")) & (F.col(id_col) <= F.col("_limit_id")))
    return (df.join(F.broadcast(limit), F.col(label) == F.col("_of"), "left")
              .withColumn(split_col, F.when(test, F.lit("test")).otherwise(F.lit("train")))
              .drop("_of", "_limit_h", "_limit_id"))


def split_sql(src: str, label: str, id_col: str = "id", test_fraction: float = 0.2, seed: int = 42) -> str:
    """The same split in SQL (DuckDB) for the oracle."""
    return f"""
SELECT *, CASE WHEN row_number() OVER (PARTITION BY {label} ORDER BY _h, {id_col})
                  <= ceil(count(*) OVER (PARTITION BY {label}) * {test_fraction})
          THEN 'test' ELSE 'train' END AS split
FROM (SELECT *, CAST(('0x' || substr(md5(CAST({id_col} AS VARCHAR) || ':{seed}'), 1, 8)) AS BIGINT) AS _h
      FROM {src}) _s"""
