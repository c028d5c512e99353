"""Chart-ready boards - the bars a board of `days` sessions should draw,
at about 120 candles, for one symbol or for all at once.

    pick spec (Y9) -> load the widened date range -> 1m/5m fallback (J3)
    -> newest `days` sessions per symbol (W3) -> adjust for actions (J1,
    BEFORE folding) -> step = max(1, round(bars / 120)) per symbol (W4)
    -> positional fold by that step (A1)

Plan shape: one aggregation of the bars to a DAY TABLE (symbol, date,
source grain, bar count). Fallback, last-N sessions, step and action
factors are all decided on that table - its per-symbol windows hold one
row per session and grain, however many bars a symbol has - and the bars
are joined to it once, on (symbol, date, grain), before the fold. The
date range is a literal, so a silver scan prunes to those partitions.

Output: symbol, date, ts, o, h, l, c, v, minutes (= step x source grain;
the candle size actually drawn).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barkeep.operators.actions import action_factors, rescale
from barkeep.operators.candles import fold_bars
from barkeep.schema import BAR_COLS, BOARD_CANDLES, BOARD_SPECS, interval_minutes
from barkeep.session import scratch_path
from barkeep.sources.silver import available, current_check_summary, load_bars


def board_spec(days: int):
    """The first spec whose day count covers `days`, else the last."""
    return next((s for s in BOARD_SPECS if s[0] >= days), BOARD_SPECS[-1])


def _as_date(x) -> dt.date:
    if isinstance(x, dt.datetime):
        return x.date()
    if isinstance(x, dt.date):
        return x
    return dt.date.fromisoformat(str(x)[:10])


def board_days(bars1: DataFrame, bars5: DataFrame, actions: DataFrame, days: int,
               end: dt.date | None, source: str) -> tuple[DataFrame, DataFrame]:
    """(tagged bars in range, day table with step and factor per
    (symbol, date, src_minutes) kept)."""
    cols = BAR_COLS + ["date"]
    back = days * 2 + 10
    if end is None:
        # The newest date of either grain the spec may use, as a one-row
        # subquery of the same plan: no job runs while it is built.
        held = bars5.select("date")
        if source == "1m":
            held = held.unionByName(bars1.select("date"))
        last = held.agg(F.max("date").alias("_end"))
        last_date, first_date = last.scalar(), last.select(F.date_sub("_end", back)).scalar()
    else:
        last_date, first_date = F.lit(end), F.lit(end - dt.timedelta(days=back))

    def in_range(df, minutes):
        return (df.where((F.col("date") >= first_date) & (F.col("date") <= last_date))
                  .select(*cols).withColumn("src_minutes", F.lit(minutes)))

    tagged = in_range(bars5, 5)
    if source == "1m":
        tagged = in_range(bars1, 1).unionByName(tagged)

    d = tagged.groupBy("symbol", "date", "src_minutes").agg(F.count("*").alias("_n"))
    return tagged, _decided(d, actions, days, last_date)


def _decided(d: DataFrame, actions: DataFrame, days: int, last_date) -> DataFrame:
    """The day table (symbol, date, src_minutes, _n) of a range narrowed to
    what the board draws, with each row's step and factor."""
    per_sym = Window.partitionBy("symbol")
    # The finest grain a symbol has anywhere in range
    d = d.withColumn("_best", F.min("src_minutes").over(per_sym)) \
         .where(F.col("src_minutes") == F.col("_best"))
    # Newest `days` sessions
    d = d.withColumn("_r", F.row_number().over(per_sym.orderBy(F.col("date").desc()))) \
         .where(F.col("_r") <= days)
    # Candle step from the bars kept
    d = d.withColumn("_total", F.sum("_n").over(per_sym)).withColumn(
        "step", F.greatest(F.lit(1), F.bround(F.col("_total") / F.lit(float(BOARD_CANDLES)), 0)
                           .cast("long")))
    d = d.select("symbol", "date", "src_minutes", "step")
    # J1 factors on the same small table
    f = action_factors(d.select("symbol", "date"), actions, last_date)
    return d.join(f, ["symbol", "date"], "left")


def _drawn(tagged: DataFrame, d: DataFrame) -> DataFrame:
    """Bars of the day table's rows, adjusted, then folded by their step."""
    b = rescale(tagged.join(d, ["symbol", "date", "src_minutes"]), "factor")
    # The fold's groups carry the join's keys and reuse its layout.
    b = b.withColumn("minutes", F.col("step") * F.col("src_minutes"))
    folded = fold_bars(b, F.col("step"))
    return folded.select("symbol", "date", "ts", "o", "h", "l", "c", "v", "minutes")


def board(bars1: DataFrame, bars5: DataFrame, actions: DataFrame, days: int,
          upto=None, symbol: str | None = None) -> DataFrame:
    """Board of `days` sessions ending at `upto` (a date or ISO string;
    None = the newest session date held at any grain the spec may use. On an
    archive, pass the last of `available()` of both grains: a literal date
    prunes folders when the plan is built)."""
    _d, _target, source = board_spec(days)
    if symbol:
        sym = symbol.upper()
        bars1 = bars1.where(F.col("symbol") == sym)
        bars5 = bars5.where(F.col("symbol") == sym)
    end = _as_date(upto) if upto is not None else None
    tagged, d = board_days(bars1, bars5, actions, days, end, source)
    return _drawn(tagged, d)


def board_of_archive(spark: SparkSession, silver_root: str, summary_root: str, actions: DataFrame, days: int,
                     upto=None, symbol: str | None = None) -> DataFrame:
    """C1 from an archive with a kept summary. The day table is the gates'
    summary (a row per symbol and session with its bar count), kept per date
    with the version of the date it was made from and brought up to date
    first, so no bar is read to decide what to draw. The decided rows, at most
    `days` a symbol, are stored; the bars are then scanned once per grain, in
    a literal range of dates."""
    _d, _target, source = board_spec(days)
    grains = ("1m", "5m") if source == "1m" else ("5m",)
    held = [d for iv in grains for d in available(spark, silver_root, iv)]
    if upto is None and not held:
        end = dt.date(1970, 1, 1)                         # nothing is held: no row is drawn
    else:
        end = _as_date(upto) if upto is not None else max(held)
    start = end - dt.timedelta(days=days * 2 + 10)
    table = tagged = None
    for iv in grains:
        minutes = F.lit(interval_minutes(iv)).alias("src_minutes")
        d = current_check_summary(spark, silver_root, summary_root, iv).where(F.col("date").between(F.lit(start), F.lit(end)))
        b = load_bars(spark, silver_root, iv, symbol=symbol, since=start, upto=end).select(*BAR_COLS, "date", minutes)
        if symbol:
            d = d.where(F.col("symbol") == symbol.upper())
        d = d.select("symbol", "date", minutes, F.col("n").alias("_n"))
        table = d if table is None else table.unionByName(d)
        tagged = b if tagged is None else tagged.unionByName(b)
    path = scratch_path(spark, "board-days")
    decided = _decided(table, actions, days, F.lit(end))
    decided.write.parquet(path)
    return _drawn(tagged, spark.read.schema(decided.schema).parquet(path))
