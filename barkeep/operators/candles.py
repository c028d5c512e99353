"""Candle building: ticks -> bars, exact positional folds (A1/W2) and
clock-aligned resampling (A4).

Every aggregate here is a hash aggregate with a map-side partial step, so
a symbol holding a third of all rows is combined inside each input task
before anything is shuffled; no operator collects a symbol's history into
one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barkeep.functions.timecols import (clock_bucket, epoch_seconds, floor_to,
                                        in_session, session_date)
from barkeep.schema import BAR_COLS


def ticks_to_bars(ticks: DataFrame, seconds: int, *, symbol="symbol",
                  ts="ts", price="price", seq="seq", size=None,
                  interval: str | None = None) -> DataFrame:
    """Trades -> OHLCV bars of `seconds`, inside the session only.

    open/close are the price of the first/last tick by `seq` (a unique,
    increasing tick id), high/low the extremes, volume the tick count (or
    the sum of `size` when given). The session filter is on the bar start
    and is applied before the shuffle.
    """
    dtype = ticks.schema[ts].dataType
    t = ticks.select(
        F.upper(F.col(symbol)).alias("symbol"),
        floor_to(epoch_seconds(ts, dtype), seconds).alias("ts"),
        F.col(price).alias("p"),
        F.col(seq).alias("seq"),
        (F.col(size).cast("long") if size else F.lit(1).cast("long")).alias("n"),
    ).where(in_session("ts") & F.col("p").isNotNull())
    bars = t.groupBy("symbol", "ts").agg(
        F.min_by("p", "seq").alias("o"),
        F.max("p").alias("h"),
        F.min("p").alias("l"),
        F.max_by("p", "seq").alias("c"),
        F.sum("n").alias("v"),
    )
    out = bars.withColumn("date", session_date("ts"))
    if interval:
        out = out.withColumn("interval", F.lit(interval))
    return out


def fold_bars(bars: DataFrame, factor: int) -> DataFrame:
    """A1: fold every `factor` consecutive bars of one symbol's session into
    one candle: first ts and open, highest high, lowest low, last close,
    summed volume. Positional, not clock aligned: the last candle of a
    session may be short, and a candle never crosses a session.

    `factor` may be an int or a Column (per-row step, e.g. a board's).
    Partitioned by (symbol, date) and the columns carried along (a grain, a
    step), so rows of two grains never share a candle: a group is one
    symbol-session, at most 376 bars at 1m, and does not grow with the
    archive.
    """
    if isinstance(factor, int) and factor <= 1:
        return bars
    step = F.lit(factor) if isinstance(factor, int) else factor
    keys = ["symbol", "date"]
    extra = [c for c in bars.columns if c not in BAR_COLS + ["date", "_step"]]
    w = Window.partitionBy(*keys, *extra).orderBy("ts")
    b = bars.withColumn("_step", step.cast("long"))
    b = b.withColumn(
        "_bucket", F.floor((F.row_number().over(w) - 1) / F.col("_step")))
    return b.groupBy(*keys, *extra, "_bucket").agg(
        F.min("ts").alias("ts"),
        F.min_by("o", "ts").alias("o"),
        F.max("h").alias("h"),
        F.min("l").alias("l"),
        F.max_by("c", "ts").alias("c"),
        F.sum("v").alias("v"),
    ).drop("_bucket")


def resample(bars: DataFrame, seconds: int = 300) -> DataFrame:
    """A4: clock-aligned buckets `ts - ts % seconds` per symbol with the
    low, high and volume of each (the benchmark's resample shape)."""
    return bars.groupBy(
        "symbol", clock_bucket("ts", seconds).alias("bucket")
    ).agg(
        F.min("l").alias("lo"),
        F.max("h").alias("hi"),
        F.sum("v").alias("vol"),
    )

