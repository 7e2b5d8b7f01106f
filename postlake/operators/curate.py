"""Curation: union of snapshots and one best row per key (U1, D1..D4, A10).

The best-row reduction is an aggregate, not a window: ``max_by`` over an
ordering struct is computed partially on the map side, so a key holding a
third of all rows is reduced inside every task before the shuffle, and
the shuffle carries at most one row per key per task.  The ordering is
total (the last component is a hash of the whole row), so the result does
not depend on input order and a replay gives the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def union_by_name(*frames: DataFrame) -> DataFrame:
    """Union all by column name; a column missing on one side is NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _order_key(order_by: Sequence[str], all_cols: Sequence[str]) -> Column:
    parts: list[Column] = []
    for c in order_by:
        # (is not null, value): NULLs rank below every value -> "desc nulls last"
        parts += [F.col(c).isNotNull(), F.col(c)]
    parts.append(F.xxhash64(*[F.col(c) for c in all_cols]))
    return F.struct(*parts)


def best_per_key(df: DataFrame, key: str | Sequence[str] = "id",
                 order_by: Sequence[str] = ("score", "ingested_at"), within: Sequence[str] = ()) -> DataFrame:
    """Per key, the row with the largest ``order_by`` values
    (descending, NULLs last, then the next column as tie-break).

    ``within`` names columns that follow from the key and by which ``df`` is
    dealt: the rows of a key then meet where they lie, without a shuffle.
    They have no part in the order.
    """
    keys = [*within, *([key] if isinstance(key, str) else key)]
    cols = [c for c in df.columns if c not in within]
    payload = [c for c in cols if c not in keys]
    best = F.max_by(F.struct(*[F.col(c) for c in payload]), _order_key(order_by, cols)).alias("_best")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col(f"_best.{c}").alias(c) for c in payload]).select(*df.columns)


def key_repeats(df: DataFrame, key: str = "id") -> bool:
    """Whether any key has two rows; reads and shuffles the keys alone."""
    return not df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).isEmpty()


def curate(current: DataFrame | None, new: DataFrame, key: str = "id",
           order_by: Sequence[str] = ("score", "ingested_at"), within: Sequence[str] = ()) -> DataFrame:
    """Merge a new raw batch into the curated snapshot: U1 then D1."""
    merged = new if current is None else union_by_name(current, new)
    return best_per_key(merged, key, order_by, within)


def sort_desc_nulls_last(df: DataFrame, col: str = "score", tiebreak: str = "id") -> DataFrame:
    """D3: global sort, range-partitioned."""
    return df.orderBy(F.desc_nulls_last(col), F.asc(tiebreak))


def top_n(df: DataFrame, n: int, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """First ``n`` rows of a global order with their rank.

    ``orderBy().limit()`` plans as TakeOrderedAndProject (a partial top-n in
    every task); the rank window then runs over the ``n`` survivors only.
    """
    top = df.orderBy(*order).limit(n)
    return top.withColumn(rank_col, F.row_number().over(Window.orderBy(*order)))


def top_n_per_group(df: DataFrame, group: str | Sequence[str], n: int, order: Sequence[Column],
                    rank_col: str = "rank") -> DataFrame:
    """Top ``n`` per group; Catalyst inserts a partial WindowGroupLimit before
    the shuffle, so a hot group ships at most ``n`` rows per task."""
    groups = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*groups).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= n)
