"""Time functions (T7..T9, T15, T16).  The session zone is UTC (see
``postlake.session``); timestamps in feature tables are TIMESTAMP_NTZ in UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# pandas' nanosecond range in whole seconds: outside it ``to_datetime`` coerces to NaT
EPOCH_SECONDS_MIN = -9223372036
EPOCH_SECONDS_MAX = 9223372036


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_to_ts(c) -> Column:
    """Epoch seconds to a UTC timestamp; out of range (no overflow) or not a number: NULL."""
    t = _col(c).try_cast("double")
    t = F.when(~F.isnan(t) & (F.abs(t) < 2.0**62), F.floor(t).cast("bigint"))
    return F.when(t.between(EPOCH_SECONDS_MIN, EPOCH_SECONDS_MAX),
                  F.timestamp_seconds(t).cast("timestamp_ntz"))


def hour_utc(ts) -> Column:
    """T7."""
    return F.hour(_col(ts))


def weekday_monday0(ts) -> Column:
    """Monday = 0 .. Sunday = 6 (``weekday``, not ``dayofweek``)."""
    return F.weekday(_col(ts))


def partition_date(ts) -> Column:
    """``dt`` partition value."""
    return F.date_format(_col(ts), "yyyy-MM-dd")


def partition_hour(ts) -> Column:
    """``hr`` partition value, two digits."""
    return F.date_format(_col(ts), "HH")


def now_utc() -> Column:
    """T16."""
    return F.current_timestamp()
