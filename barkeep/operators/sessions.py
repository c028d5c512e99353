"""Session-level selections: last N sessions per symbol (W3), latest bars
(L5), 1m -> 5m source fallback (J3), session listing (S6/A9).

Windows here rank the DISTINCT (symbol, date) table, whose groups hold one
row per session; bars are then kept with a semi-join on (symbol, date).
No window ever spans a symbol's whole bar history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def sessions(bars: DataFrame) -> DataFrame:
    """The (interval, date) partitions present. On a partitioned
    parquet scan this reads partition values only (empty ReadSchema)."""
    keys = [c for c in ("interval", "date") if c in bars.columns]
    return bars.select(*keys).distinct()


def last_session_days(bars: DataFrame, n: int) -> DataFrame:
    """(symbol, date) of each symbol's newest `n` sessions present."""
    days = bars.select("symbol", "date").distinct()
    w = Window.partitionBy("symbol").orderBy(F.col("date").desc())
    return days.withColumn("_r", F.row_number().over(w)) \
               .where(F.col("_r") <= n).drop("_r")


def last_sessions(bars: DataFrame, n: int) -> DataFrame:
    """Keep only each symbol's newest `n` distinct session dates."""
    return bars.join(last_session_days(bars, n), ["symbol", "date"], "left_semi")


def latest_bars(bars: DataFrame, n: int) -> DataFrame:
    """Each symbol's newest `n` bars. The candidates are first cut to
    the newest `n` sessions (every session holds at least one bar), so the
    per-symbol ranking sees at most n x session-cap rows."""
    cand = last_sessions(bars, n)
    w = Window.partitionBy("symbol").orderBy(F.col("ts").desc())
    return cand.withColumn("_r", F.row_number().over(w)) \
               .where(F.col("_r") <= n).drop("_r")


def source_fallback(fine: DataFrame, coarse: DataFrame) -> DataFrame:
    """Per symbol, the fine bars when it has any, else the coarse ones.
    Rows carry `src_minutes` (1 or 5) so callers can label candle sizes.

    The choice is made on the distinct (symbol, date, grain) table - a
    per-symbol window over one row per session and grain - and the bars
    are kept with a semi-join on all three keys, so no join group is a
    whole symbol's history."""
    tagged = (fine.withColumn("src_minutes", F.lit(1))
                  .unionByName(coarse.withColumn("src_minutes", F.lit(5))))
    days = tagged.select("symbol", "date", "src_minutes").distinct()
    best = days.withColumn("_best", F.min("src_minutes").over(Window.partitionBy("symbol"))) \
               .where(F.col("src_minutes") == F.col("_best")).drop("_best")
    return tagged.join(best, ["symbol", "date", "src_minutes"], "left_semi")


def bars_by_symbol_day(bars: DataFrame) -> DataFrame:
    """One row per (symbol, date) holding that session's bars as a
    time-ordered array of (ts, o, h, l, c, v) - the chart-ready nested form.
    Grouped per session, never per symbol: a group is at most one day's
    bars, however long a symbol's history."""
    return bars.groupBy("symbol", "date").agg(
        F.sort_array(F.collect_list(F.struct("ts", "o", "h", "l", "c", "v"))).alias("bars"))


def in_time_order(bars: DataFrame) -> DataFrame:
    """L1 / L2: (symbol, ts) order, for the edge that presents rows; a
    global sort is a range shuffle, so keep it out of intermediate plans."""
    return bars.orderBy("symbol", "ts")
