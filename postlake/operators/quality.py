"""Gates and row validation (P10..P16).

Gates answer with as little work as possible (``limit(n).count()`` instead
of a full count).  Row validation never fails a batch: every row gets a
``reasons`` array (empty when valid), and the caller splits valid rows from
rejects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlake import schemas

MIN_TRAIN_SAMPLES = 20
SEARCH_K_DEFAULT, SEARCH_K_MIN, SEARCH_K_MAX = 10, 1, 50


class GateError(ValueError):
    pass


def has_at_least(df: DataFrame, n: int) -> bool:
    return df.limit(n).count() >= n


def gate_min_rows(df: DataFrame, n: int = MIN_TRAIN_SAMPLES) -> DataFrame:
    """At least ``n`` rows, or fail."""
    if not has_at_least(df, n):
        raise GateError(f"fewer than {n} rows for training")
    return df


def gate_two_classes(df: DataFrame, target: str = schemas.TARGET) -> DataFrame:
    """The target has two classes, or fail."""
    if df.select(target).distinct().limit(2).count() < 2:
        raise GateError("the binary target has only one class")
    return df


def gate_not_empty(df: DataFrame, what: str = "text features") -> int:
    """Fail when empty; otherwise the row count."""
    if df.isEmpty():
        raise GateError(f"{what} are empty")
    return df.count()


def _reasons(*checks: Column) -> Column:
    return F.filter(F.array(*checks), lambda r: r.isNotNull())


def validate_predict(df: DataFrame) -> DataFrame:
    """Title required; hour 0..23 and weekday 0..6 required; by_author
    defaults to 'unknown'; url optional.  Adds ``reasons`` and ``valid``."""
    hour, wd = F.col("hour"), F.col("weekday")
    reasons = _reasons(
        F.when(F.col("title").isNull(), F.lit("title_required")),
        F.when(hour.isNull(), F.lit("hour_required")).when(~hour.between(0, 23), F.lit("hour_out_of_range")),
        F.when(wd.isNull(), F.lit("weekday_required")).when(~wd.between(0, 6), F.lit("weekday_out_of_range")),
    )
    return (df.withColumn("by_author", F.coalesce(F.col("by_author"), F.lit("unknown")))
              .withColumn("reasons", reasons)
              .withColumn("valid", (F.size("reasons") == 0).cast("int")))


def validate_search(df: DataFrame, query_col: str = "query", k_col: str = "k") -> DataFrame:
    """Non-empty query; ``k`` in 1..50, default 10."""
    k = F.coalesce(F.col(k_col), F.lit(SEARCH_K_DEFAULT)) if k_col in df.columns else F.lit(SEARCH_K_DEFAULT)
    q = F.col(query_col)
    reasons = _reasons(
        F.when(q.isNull() | (F.length(q) < 1), F.lit("query_required")),
        F.when(~k.between(SEARCH_K_MIN, SEARCH_K_MAX), F.lit("k_out_of_range")),
    )
    return (df.withColumn(k_col, k.cast("int"))
              .withColumn("reasons", reasons)
              .withColumn("valid", (F.size("reasons") == 0).cast("int")))


def split_valid(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    return df.where(F.col("valid") == 1), df.where(F.col("valid") == 0)


def search_hits(hits: DataFrame) -> DataFrame:
    """The output contract of a hit (no ``created_ts``)."""
    return hits.select(*[c for c in ["query_id", "rank"] if c in hits.columns], *schemas.SEARCH_HIT_COLUMNS)
