"""Session arithmetic on epoch seconds.

All of it is integer arithmetic on the epoch, never a rendered timestamp:
a timestamp answers in the session time zone, the epoch does not. So the
results are the same on any cluster whatever `spark.sql.session.timeZone`
says.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barkeep.schema import IST_OFFSET_S, SESSION_CLOSE_M, SESSION_OPEN_M


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def epoch_seconds(col, dtype: T.DataType) -> Column:
    """Whole epoch seconds (floored) of a timestamp column.

    TIMESTAMP_NTZ is read as UTC wall clock, independent of the session zone.
    """
    c = _c(col)
    if isinstance(dtype, T.TimestampNTZType):
        origin = F.lit("1970-01-01 00:00:00").cast(T.TimestampNTZType())
        return F.timestamp_diff("SECOND", origin, c)
    if isinstance(dtype, T.TimestampType):
        return F.unix_seconds(c)
    return c.cast("long")


def ist_seconds(ts) -> Column:
    return _c(ts) + F.lit(IST_OFFSET_S)


def minute_of_day(ts) -> Column:
    """IST minute of the day, 0..1439."""
    return F.floor(F.pmod(ist_seconds(ts), F.lit(86400)) / 60).cast("int")


def session_date(ts) -> Column:
    """Y2: IST calendar date of an epoch second."""
    return F.date_from_unix_date(F.floor(ist_seconds(ts) / 86400).cast("int"))


def in_session(ts) -> Column:
    """Minute-of-day inside the trading session, both ends inclusive."""
    return minute_of_day(ts).between(SESSION_OPEN_M, SESSION_CLOSE_M)


def clock_bucket(ts, seconds: int) -> Column:
    """Clock-aligned bucket start, `ts - ts % seconds`."""
    t = _c(ts)
    return t - F.pmod(t, F.lit(seconds))


def floor_to(ts, seconds: int) -> Column:
    """Epoch floored to a multiple of `seconds`."""
    return F.floor(_c(ts) / seconds).cast("long") * F.lit(seconds)
