"""The vector table (S11..S14, T20, B9).

An upsert replaces whole rows: every column of an existing id is replaced
by the new row's value, NULL included, and ``indexed_at`` is refreshed.
Expressed as ``existing LEFT ANTI JOIN new`` union ``new``.  Within one
batch, a repeated id keeps a single row chosen by a total order
(``dedup_order``), so the outcome does not depend on partitioning.

On the lake the table is cut into ``buckets`` by a hash of the id.  A batch
reads and rewrites only the buckets its ids fall in (``lake.merge_snapshot``),
so the files of untouched buckets stay, and a job that dies leaves the table
as it was.

Constraint checks (S12) return a rejects frame ``(id, reason)`` instead of
failing a whole batch on the first bad row; rows without an id are rejected
before an upsert, as no row could ever replace them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from postlake.functions import now_utc
from postlake.operators.curate import best_per_key
from postlake.schemas import EMBEDDING_DIM, VECTORS
from postlake.session import materialise
from postlake.sources.lake import latest_version, merge_snapshot, read_snapshot


def with_lineage(df: DataFrame, model_name: str, run_id: str | None) -> DataFrame:
    """Contract types (NULLs preserved) and lineage columns, in the order of ``schemas.VECTORS``."""
    stamped = df.withColumns({"model_name": F.lit(model_name), "model_run_id": F.lit(run_id), "indexed_at": now_utc()})
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in VECTORS.fields])


def upsert(existing: DataFrame | None, new: DataFrame, key: str = "id",
           dedup_order: Sequence[str] = ("indexed_at", "created_ts", "score"), within: Sequence[str] = ()) -> DataFrame:
    """Whole-row replace by ``key``; rows dealt by ``within`` are replaced where they lie (see ``best_per_key``)."""
    fresh = best_per_key(new, key, [c for c in dedup_order if c in new.columns], within)
    if existing is None:
        return fresh
    if within:
        both = existing.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1)), allowMissingColumns=True)
        newest = F.max("_new").over(Window.partitionBy(*within, key))
        return both.withColumn("_newest", newest).where(F.col(key).isNull() | (F.col("_new") == F.col("_newest"))).drop("_new", "_newest")
    kept = existing.join(fresh.select(key), key, "left_anti")
    return kept.unionByName(fresh, allowMissingColumns=True)


def upsert_snapshot(root: str, new: DataFrame, key: str = "id", buckets: int = 16, files: int = 1,
                    keep_versions: int = 2, written: bool = False) -> int:
    """S11 on the lake: rewrites the buckets that ``new`` touches.  Returns the number of ids written
    (0 and nothing changed when empty).

    The batch is evaluated once, written beside the table; one that is
    ``written`` already is read from there, and shuffled once.  ``buckets``
    belongs to the table; one writer per table.
    """
    fresh = new.where(F.col(key).isNotNull())
    if not written:
        fresh = materialise(upsert(None, fresh, key), "upsert")
    keys = fresh.select(key)
    n = keys.distinct().count() if written else fresh.count()

    def merge(existing: DataFrame | None, batch: DataFrame, within: Sequence[str] = ()) -> DataFrame:
        return batch if existing is None and not written else upsert(existing, batch, key, within=within)

    if n:
        merge_snapshot(root, fresh, key, merge, buckets, files, keep_versions, keys=keys if written else None)
    return n


def read_vectors(spark, root: str) -> DataFrame | None:
    """The newest rows of all buckets; None if there are none yet."""
    return None if latest_version(spark, root) is None else read_snapshot(spark, root)


def constraint_violations(df: DataFrame, key: str = "id", dim: int = EMBEDDING_DIM,
                          not_null: Sequence[str] = ("title", "embedding", "model_name"),
                          vec_col: str = "embedding") -> DataFrame:
    """``(id, reason)`` for duplicate keys, NULLs in required columns
    and vectors of the wrong dimension."""
    dup = df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1) \
            .select(key, F.lit("duplicate_id").alias("reason"))
    checks = [F.when(F.col(key).isNull(), F.lit(f"null_{key}"))]
    checks += [F.when(F.col(c).isNull(), F.lit(f"null_{c}")) for c in not_null if c in df.columns]
    checks.append(F.when(F.col(vec_col).isNotNull() & (F.size(vec_col) != dim), F.lit("wrong_dimension")))
    rows = df.select(key, F.explode(F.filter(F.array(*checks), lambda r: r.isNotNull())).alias("reason"))
    return dup.unionByName(rows)


def write_vectors_sorted(df: DataFrame, path: str, author_col: str = "by_author", ts_col: str = "created_ts") -> None:
    """K4 layout: rows range-partitioned by author and sorted by (author, time)
    inside each file, so Parquet min/max statistics let an author lookup skip
    row groups (the btree indexes of the original table)."""
    (df.repartitionByRange(author_col, ts_col).sortWithinPartitions(author_col, F.desc(ts_col))
       .write.mode("overwrite").parquet(path))  # one unpartitioned table: static overwrite


def author_lookup(spark, path: str, author: str, n: int | None = None,
                  author_col: str = "by_author", ts_col: str = "created_ts") -> DataFrame:
    """K4: one author's rows, newest first (filter pushed to the scan)."""
    df = spark.read.parquet(path).where(F.col(author_col) == author).orderBy(F.desc_nulls_last(ts_col), "id")
    return df.limit(n) if n else df
