"""Merge bars so that the newest fetch wins per (symbol, ts).

Every row carries where it comes from: the `fetched` date and the
`landed_at` time of its response, kept in silver beside the bar. A later
fetch wins, then a later landing, whichever of the two rows is already in
the archive, so batches may arrive in any order and any cut. Of rows with
equal provenance (or none) the incoming one wins; equal rows after that
resolve by the bar values, so a replayed batch changes nothing.

The order is one decimal rank, and each column is the `max_by` of it: all
aggregation buffers have a fixed width, so it plans as a hash aggregate that
combines the copies of a key before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barkeep.schema import BAR_COLS, PROVENANCE


def _with_provenance(df: DataFrame, incoming: int) -> DataFrame:
    fetched = F.col("fetched").cast("date") if "fetched" in df.columns else F.lit(None).cast("date")
    landed = F.col("landed_at").cast("timestamp") if "landed_at" in df.columns else F.lit(None).cast("timestamp")
    return df.select(*BAR_COLS, "date", fetched.alias("fetched"), landed.alias("landed_at"),
                     F.lit(incoming).alias("_src"))


def _rank() -> Column:
    """fetched day | landing microseconds | incoming | hash of the values, as
    one decimal(38,0): 7, 18, 1 and 10 digits."""
    day = F.coalesce(F.unix_date("fetched"), F.lit(-1_000_000)) + 1_000_001
    at = F.coalesce(F.unix_micros("landed_at"), F.lit(-1)) + 1
    values = F.pmod(F.xxhash64("o", "h", "l", "c", "v"), F.lit(10_000_000_000))
    part = lambda c, zeros: c.cast("decimal(38,0)") * F.lit("1" + "0" * zeros).cast("decimal(38,0)")
    high = (part(day, 29) + part(at, 11)).cast("decimal(38,0)")
    return (high + part(F.col("_src"), 10) + values.cast("decimal(38,0)")).cast("decimal(38,0)")


def newest_wins(rows: DataFrame) -> DataFrame:
    """W1 over rows with fetched, landed_at and _src."""
    g = rows.withColumn("_rank", _rank()).groupBy("symbol", "ts", "date")
    return g.agg(*[F.max_by(c, "_rank").alias(c) for c in ("o", "h", "l", "c", "v", *PROVENANCE)])


def merge_bars(incoming: DataFrame, existing: DataFrame | None = None,
               provenance: bool = False) -> DataFrame:
    """G1: incoming UNION ALL existing, newest per (symbol, ts).

    `existing` should already be restricted to the dates `incoming` touches
    (see `sources.silver.merge_into_silver`, which prunes partitions).
    Output: symbol, ts, o, h, l, c, v, date[, fetched, landed_at].
    """
    u = _with_provenance(incoming, 1)
    if existing is not None:
        u = u.unionByName(_with_provenance(existing, 0))
    out = newest_wins(u).select(*BAR_COLS, "date", *PROVENANCE)
    return out if provenance else out.drop(*PROVENANCE)
