"""Fitted statistics for preprocessing.

* ``category_vocabulary``: per categorical feature, each training value
  with its count and its mapped value: itself when seen at least
  ``min_frequency`` times, else the shared ``RARE`` value.  Scoring joins
  this vocabulary; a value never seen at fit time maps to NULL, which the
  one-hot stage turns into all zeros (not the rare column).
* ``standard_stats``: mean and *population* standard deviation per numeric
  feature (the sample std of MLlib's StandardScaler differs).

Both are grouped aggregates with partial aggregation; the vocabulary is
joined as an ordinary table (AQE broadcasts it only when it is small).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RARE = "__rare__"


def _long(df: DataFrame, cols: Sequence[str], value_type: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast(value_type).alias("value")) for c in cols])
    return df.select(F.inline(pairs))


def category_vocabulary(train: DataFrame, cols: Sequence[str], min_frequency: int = 5) -> DataFrame:
    """A3: ``(feature, category, n, mapped)``."""
    counts = _long(train, cols, "string").groupBy("feature", F.col("value").alias("category")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("mapped", F.when(F.col("n") >= min_frequency, F.col("category")).otherwise(F.lit(RARE)))


def apply_vocabulary(df: DataFrame, vocab: DataFrame, cols: Sequence[str], suffix: str = "_cat",
                     hot: Sequence[str] = ("no_url", "unknown"), value: str = "mapped") -> DataFrame:
    """Map each categorical column through the fitted vocabulary (to its column ``value``); NULL for a value it lacks.

    ``hot`` values (those of rows without a URL or author), which may stand in
    most rows, are looked up as literals and keep out of the join.
    """
    known = {(r.feature, r.category): r[value]
             for r in vocab.where(F.col("category").isin(list(hot)) & F.col("feature").isin(list(cols))).collect()}
    out = df
    for c in cols:
        v = vocab.where(F.col("feature") == c).select(F.col("category").alias("_category"), F.col(value).alias("_mapped"))
        key = F.when(~F.col(c).isin(list(hot)), F.col(c))
        out = out.withColumn("_key", key).join(v, F.col("_key") == F.col("_category"), "left")
        mapped = F.col("_mapped")
        for common in hot:
            mapped = F.when(F.col(c) == common, F.lit(known.get((c, common)))).otherwise(mapped)
        out = out.withColumn(c + suffix, mapped).drop("_key", "_category", "_mapped")
    return out


def standard_stats(train: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A4: ``(feature, mean, std)`` with the population std."""
    return _long(train, cols, "double").groupBy("feature").agg(
        F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))


def standardize(df: DataFrame, stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """M3: ``(x - mean) / std`` (std 0 -> 0), with the stats of the fit.

    ``stats`` has one row per feature (a bounded handful of numbers), so it
    is read once and the scaling is a plain projection.
    """
    fitted = {r["feature"]: (r["mean"], r["std"]) for r in stats.where(F.col("feature").isin(list(cols))).collect()}
    out = df
    for c in cols:
        mean, std = fitted[c]
        out = out.withColumn(c, (F.col(c) - F.lit(mean)) / F.lit(std) if std else F.lit(0.0))
    return out
