"""Schemas and fixed constants of the bar archive.

Every read in the library passes one of these explicitly: no inference,
no surprises when a file is empty or a vintage drops a key.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: must equal the source semantics for results to agree ---
# Exchange session in IST, minute-of-day bounds, both ends inclusive
# (09:15 .. 15:30), and the fixed IST offset in seconds (no DST).
SESSION_OPEN_M = 555
SESSION_CLOSE_M = 930
IST_OFFSET_S = 19800
# The two stored grains.
INTERVALS = ("1m", "5m")
# Quality gates: a session must reach minute 900 (15:00) for at least 95 %
# of the symbols trading that day; the newest partition may be 3 days old.
REACH_BY_M = 900
MIN_REACHING_PCT = 95
STALE_DAYS = 3
# Board: about 120 candles per board; specs are
# (days, target minutes, source interval).
BOARD_CANDLES = 120
BOARD_SPECS = (
    (1, 1, "1m"),
    (3, 3, "1m"),
    (7, 7, "1m"),
    (20, 20, "5m"),
    (44, 60, "5m"),
)
# Offender reports show this many example rows.
EXAMPLES = 5
# --- end of fixed values ---


def interval_minutes(interval: str) -> int:
    """'5m' -> 5; anything that strips to 0 counts as 1."""
    return int(interval.rstrip("m")) or 1


def session_cap(interval: str) -> int:
    """Most bars one symbol can have in one session at this grain."""
    return (SESSION_CLOSE_M - SESSION_OPEN_M) // interval_minutes(interval) + 1


# One stored bar (silver row, without partition columns).
BAR = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ts", T.LongType()),
    T.StructField("o", T.DoubleType()),
    T.StructField("h", T.DoubleType()),
    T.StructField("l", T.DoubleType()),
    T.StructField("c", T.DoubleType()),
    T.StructField("v", T.LongType()),
])
BAR_COLS = [f.name for f in BAR.fields]

# Where a stored bar comes from: decides which of two fetches is newer.
# Kept in silver, hidden by the readers.
PROVENANCE = ["fetched", "landed_at"]

# Silver as read back, partition columns included.
SILVER = T.StructType(BAR.fields + [
    T.StructField("fetched", T.DateType()),
    T.StructField("landed_at", T.TimestampType()),
    T.StructField("interval", T.StringType()),
    T.StructField("date", T.DateType()),
])

# The headerless CSV spool format, seven bar columns plus session date.
BAR_CSV = T.StructType(BAR.fields + [T.StructField("d", T.DateType())])

# A landed raw response as stored in bulk; interval and fetched come
# from the folder names.
LANDED = "symbol string, landed_at timestamp, payload string, interval string, fetched date"

# The upstream chart payload. Split and dividend numbers and dates are kept
# as strings, so their text survives into the action subject and a number that
# arrives as text is no error.
_QUOTE = T.StructType([
    T.StructField(name, T.ArrayType(T.DoubleType()))
    for name in ("open", "high", "low", "close", "volume")
])
_SPLIT = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("numerator", T.StringType()),
    T.StructField("denominator", T.StringType()),
    T.StructField("splitRatio", T.StringType()),
])
_DIVIDEND = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("amount", T.StringType()),
])
EVENTS = T.StructType([
    T.StructField("splits", T.MapType(T.StringType(), _SPLIT)),
    T.StructField("dividends", T.MapType(T.StringType(), _DIVIDEND)),
])
PAYLOAD = T.StructType([
    T.StructField("chart", T.StructType([
        T.StructField("result", T.ArrayType(T.StructType([
            T.StructField("timestamp", T.ArrayType(T.LongType())),
            T.StructField("indicators", T.StructType([
                T.StructField("quote", T.ArrayType(_QUOTE)),
            ])),
            T.StructField("events", EVENTS),
        ]))),
    ])),
])

# One corporate action.
ACTION = T.StructType([
    T.StructField("symbol", T.StringType()),
    T.StructField("ex_date", T.DateType()),
    T.StructField("kind", T.StringType()),
    T.StructField("factor", T.DoubleType()),
    T.StructField("subject", T.StringType()),
])
ACTION_COLS = [f.name for f in ACTION.fields]
ACTION_KEY = ["symbol", "ex_date", "kind"]

# The exchange action feed; field names differ by vintage.
ACTION_FEED = T.StructType([
    T.StructField(name, T.StringType())
    for name in ("symbol", "exDate", "ex_dt", "exdate", "subject", "purpose")
])

# One gate verdict.
CHECK_RESULT = T.StructType([
    T.StructField("interval", T.StringType()),
    T.StructField("check", T.StringType()),
    T.StructField("ok", T.BooleanType()),
    T.StructField("detail", T.StringType()),
])
