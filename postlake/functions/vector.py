"""Vector functions (T17..T20, E4) on ``array<float>`` columns.

All are higher-order SQL functions evaluated in the JVM; a zero vector has
no direction, so its cosine is NULL (ranked last by the search operators).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dot(a, b) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")),
                       F.lit(0.0), lambda acc, v: acc + v)


def l2_norm(v) -> Column:
    return F.sqrt(F.aggregate(_col(v), F.lit(0.0), lambda acc, x: acc + x.cast("double") * x.cast("double")))


def cosine_similarity(a, b) -> Column:
    """``1 - (a <=> b)``; NULL when either side is a zero vector."""
    denom = l2_norm(a) * l2_norm(b)
    return F.when(denom > 0, dot(a, b) / denom)


def cosine_distance(a, b) -> Column:
    return F.lit(1.0) - cosine_similarity(a, b)


def l2_normalize(v) -> Column:
    """Unit length; a zero vector stays zero."""
    n = l2_norm(v)
    return F.transform(_col(v), lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0)).cast("float"))


def dimension(v) -> Column:
    """T20."""
    return F.size(_col(v))


def quantize(v, decimals: int = 6) -> Column:
    """Round each element to ``decimals`` places, then back to float32."""
    return F.transform(_col(v), lambda x: F.round(x.cast("double"), decimals).cast("float"))


def to_text(v, decimals: int = 6) -> Column:
    """``'[x1,x2,...]'`` with fixed decimals (Java rounds halves up)."""
    fmt = f"%.{decimals}f"
    return F.concat(F.lit("["), F.array_join(F.transform(_col(v), lambda x: F.format_string(fmt, x.cast("double"))), ","),
                    F.lit("]"))


def from_text(s) -> Column:
    """Inverse of ``to_text``."""
    return F.from_json(_col(s), "array<double>")
