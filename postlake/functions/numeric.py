"""Numeric functions (T10..T13)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCORE_THRESHOLD = 100
DECISION_THRESHOLD = 0.5

# what pandas.to_numeric accepts: optional sign, digits with optional point, exponent,
# or inf/nan spelled out; Java's parser would also take '12d', which pandas rejects
NUMERIC_TEXT = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|inf|infinity|nan)\s*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lenient_int(c, dtype: T.DataType | None = None) -> Column:
    """``to_numeric(errors='coerce').fillna(0).astype(int)``.

    Bad text, NaN, null and +-inf give 0; finite values truncate toward zero.
    ``dtype`` (the input column's type) skips the text path for numbers.
    """
    x = _col(c)
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return F.coalesce(x.cast("bigint"), F.lit(0).cast("bigint"))
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        d = x.cast("double")
    else:
        s = x.cast("string")
        d = F.when(F.lower(s).rlike(NUMERIC_TEXT), F.trim(s).try_cast("double"))
        whole = F.when(s.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(s).try_cast("bigint"))  # exact beyond 2**53
    finite = d.isNotNull() & ~F.isnan(d) & (F.abs(d) < F.lit(float("inf")))
    parsed = F.when(finite, d.try_cast("bigint"))
    if not isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        parsed = F.coalesce(whole, parsed)
    return F.coalesce(parsed, F.lit(0).cast("bigint"))


def is_numeric_null(c, dtype: T.DataType | None = None) -> Column:
    """pandas ``isna``: NULL, and NaN for floating columns."""
    x = _col(c)
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return x.isNull() | F.isnan(x)
    return x.isNull()


def target_flag(score, threshold: int = SCORE_THRESHOLD) -> Column:
    """``score >= threshold`` as 0/1."""
    return (_col(score) >= F.lit(threshold)).cast("int")


def to_class(p, threshold: float = DECISION_THRESHOLD) -> Column:
    """Probability to class, ``>=`` (ties go to class 1)."""
    return (_col(p) >= F.lit(threshold)).cast("int")
