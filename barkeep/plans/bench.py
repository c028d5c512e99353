"""The archive's three access patterns (A2-A4, P12, L8) as DataFrame plans:

    scan      every symbol, every session - nothing prunes
    point     one symbol, one day - partition pruning + row-group skipping
    resample  1m -> 5m clock buckets for one symbol across the archive
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barkeep.operators.candles import resample


def bench_scan(bars5: DataFrame) -> DataFrame:
    """A2: per symbol, bars held and mean volume (largest first at the edge)."""
    return bars5.groupBy("symbol").agg(F.count("*").alias("bars"),
                                        F.avg("v").alias("avg_vol"))


def bench_point(bars5: DataFrame, symbol, day) -> DataFrame:
    """One symbol on one day - count, low, high."""
    return bars5.where((F.col("symbol") == symbol) & (F.col("date") == F.lit(day).cast("date"))) \
                .agg(F.count("*").alias("bars"), F.min("l").alias("lo"), F.max("h").alias("hi"))


def bench_resample(bars1: DataFrame, symbol) -> DataFrame:
    """A4: one symbol's minute bars in 300-second clock buckets."""
    return resample(bars1.where(F.col("symbol") == symbol), 300)


def sample_symbol_day(bars5: DataFrame) -> DataFrame:
    """A (symbol, date) that exists - the first in (symbol, date) order,
    so the probe is deterministic."""
    return bars5.select("symbol", "date").orderBy("symbol", "date").limit(1)

