"""Corporate actions: normalise the feed (S12), classify (Y10), upsert into
the store (G2, J2), report conflicts (X9) and counts (A11), and put bars on
the price basis in force at a date (A10, J1).

Store rows follow `schema.ACTION`: symbol, ex_date, kind, factor, subject.
A factor means: multiply prices from BEFORE the ex-date by it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barkeep.functions.actions import classify_columns, first_present, parse_feed_date
from barkeep.schema import ACTION_COLS, ACTION_KEY


def classify_actions(df: DataFrame, subject: str = "subject") -> DataFrame:
    """Add `kind` and `factor` classified from the subject line."""
    return classify_columns(df.drop("kind", "factor"), subject)


def normalise_actions(feed: DataFrame) -> DataFrame:
    """Exchange feed rows (any vintage of field names) -> store rows.

    symbol trimmed and upper-cased; ex-date from the first non-empty of
    exDate / ex_dt / exdate in any of three formats; subject from the first
    non-empty of subject / purpose, trimmed. Rows without a symbol or a
    parseable date are dropped; the rest are classified.
    """
    # Vintages differ only by letter case (exDate / exdate): give every
    # column a positional name first, so resolution is exact whatever
    # spark.sql.caseSensitive says.
    names = list(feed.columns)
    feed = feed.toDF(*["_f%d" % i for i in range(len(names))])
    pos = {n: "_f%d" % i for i, n in enumerate(names)}

    def pick(*wanted):
        present = [pos[n] for n in wanted if n in pos]
        return first_present(*present) if present else F.lit(None).cast("string")

    # the raw date text is staged as its own column: the parser reads it
    # several times, and an inlined copy per read would multiply its cost
    rows = feed.select(
        F.upper(F.trim(F.coalesce(pick("symbol"), F.lit("")))).alias("symbol"),
        F.initcap(F.trim(pick("exDate", "ex_dt", "exdate"))).alias("_raw_date"),
        F.trim(F.coalesce(pick("subject", "purpose"), F.lit(""))).alias("subject"),
    )
    rows = rows.withColumn("ex_date", parse_feed_date("_raw_date")).drop("_raw_date") \
               .where((F.col("symbol") != "") & F.col("ex_date").isNotNull())
    return classify_actions(rows).select(*ACTION_COLS)


def _ranked(df: DataFrame, src: int) -> DataFrame:
    return df.select(*ACTION_COLS, F.lit(src).alias("_src"))


def merge_actions(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Upsert keyed on (symbol, ex_date, kind); incoming wins and old
    actions are never forgotten. Two incoming rows for one key resolve by
    a total order (greatest subject, then factor) so the result is
    deterministic. An aggregate, not a window: copies of one key are
    combined map-side before the shuffle."""
    u = _ranked(incoming, 1).unionByName(_ranked(existing, 0))
    best = F.max(F.struct(
        F.col("_src"), F.col("subject"),
        F.col("factor").isNotNull().alias("_has"), F.col("factor")))
    return (u.groupBy(*ACTION_KEY).agg(best.alias("_w"))
             .select(*ACTION_KEY, F.col("_w.factor").alias("factor"),
                     F.col("_w.subject").alias("subject"))
             .select(*ACTION_COLS))


def new_actions(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming rows whose key the store does not hold (a repeated new
    key counts once per row, as the counter it feeds)."""
    return incoming.join(existing.select(*ACTION_KEY).distinct(),
                         ACTION_KEY, "left_anti")


def adjusting(actions: DataFrame) -> DataFrame:
    """Actions whose factor is known (the ones adjust applies)."""
    return actions.where(F.col("factor").isNotNull())


def unparsed(actions: DataFrame) -> DataFrame:
    """split/bonus rows without a usable ratio - they stay unadjusted,
    so they are worth listing."""
    return actions.where(F.col("factor").isNull() & F.col("kind").isin("split", "bonus"))


def splits(actions: DataFrame) -> DataFrame:
    """Split rows only (the new-split report)."""
    return actions.where(F.col("kind") == "split")


def in_store_order(actions: DataFrame) -> DataFrame:
    """(ex_date, symbol) order, for presentation at the edge."""
    return actions.orderBy("ex_date", "symbol", "kind")


def action_counts(actions: DataFrame) -> DataFrame:
    """Rows per kind, plus how many of them adjust (factor known) and
    how many split/bonus rows lack a usable ratio (P11)."""
    unparsed = F.col("factor").isNull() & F.col("kind").isin("split", "bonus")
    return actions.groupBy("kind").agg(
        F.count("*").alias("n"),
        F.count("factor").alias("adjusting"),
        F.count_if(unparsed).alias("unparsed"))


def action_conflicts(actions: DataFrame) -> DataFrame:
    """X9 report: (symbol, ex_date) holding more than one known factor -
    e.g. one bonus recorded by two sources as bonus and as split, which
    would otherwise be applied twice."""
    known = actions.where(F.col("factor").isNotNull())
    return (known.groupBy("symbol", "ex_date")
                 .agg(F.count("*").alias("n_factors"),
                      F.concat_ws(",", F.sort_array(F.collect_list("kind"))).alias("kinds"),
                      F.product("factor").alias("combined"))
                 .where(F.col("n_factors") > 1))


def _as_date_col(upto) -> Column:
    if isinstance(upto, Column):
        return upto
    if isinstance(upto, (dt.date, dt.datetime)):
        upto = upto.isoformat()[:10]
    return F.lit(upto).cast("date")


def action_factors(days: DataFrame, actions: DataFrame, upto) -> DataFrame:
    """For each (symbol, date) row of `days`, the product of every
    known factor of that symbol with date < ex_date <= upto (1.0 if none).

    An as-of lookup, not a range join - no session is paired with every
    later action. Per symbol: the factors of one ex-date are multiplied;
    a suffix product runs over ex-dates from `upto` backwards; then days
    and ex-dates are merged in one date order (an ex-date sorts before a
    day of the same date) and each day takes the suffix of the first
    ex-date after it. The window holds one row per session or action of
    the symbol - the DISTINCT (symbol, date) `days` set, never bars.
    """
    end = _as_date_col(upto)
    a = (actions.where(F.col("factor").isNotNull() & (F.col("ex_date") <= end))
                .groupBy("symbol", "ex_date").agg(F.product("factor").alias("_f")))
    later = Window.partitionBy("symbol").orderBy(F.col("ex_date").desc()) \
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    a = a.select("symbol", F.col("ex_date").alias("date"),
                 F.product("_f").over(later).alias("_suffix"), F.lit(0).alias("_tag"))
    d = days.select("symbol", "date", F.lit(None).cast("double").alias("_suffix"),
                    F.lit(1).alias("_tag"))
    # From the latest date backwards: a running frame, linear in the rows.
    ahead = Window.partitionBy("symbol").orderBy(F.col("date").desc(), F.col("_tag").desc()) \
                  .rowsBetween(Window.unboundedPreceding, -1)
    u = a.unionByName(d).withColumn(
        "factor", F.coalesce(F.last("_suffix", ignorenulls=True).over(ahead), F.lit(1.0)))
    return u.where(F.col("_tag") == 1).select("symbol", "date", "factor")


def scale_price(price: Column, factor: Column) -> Column:
    """Price x factor rounded half-up to 4 places, in exact decimal
    arithmetic (a 4-place price times a 10-place factor fits DECIMAL(37,14)
    without loss), so the result does not depend on how an engine prints
    or rounds binary doubles."""
    prod = price.cast("decimal(18,4)") * factor.cast("decimal(18,10)")
    return F.round(prod, 4).cast("double")


def adjust_bars(bars: DataFrame, actions: DataFrame, upto) -> DataFrame:
    """Put every bar on the price basis in force at `upto`.

    Prices are multiplied by the factor and rounded to 4 places (exact
    decimal, half-up); volume is
    divided by it and rounded half-even to an integer; a factor of exactly
    1.0 leaves the bar untouched. Factors are computed once per
    symbol-session and joined back on (symbol, date), a key whose groups
    are one session each - no symbol-wide group, however hot the symbol.
    """
    days = bars.select("symbol", "date").distinct()
    f = action_factors(days, actions, upto)
    j = bars.join(f, ["symbol", "date"], "left")
    return rescale(j, "factor").select(*bars.columns)


def rescale(bars: DataFrame, factor: str = "factor") -> DataFrame:
    """Apply a per-row factor column (NULL = 1.0) to prices and volume,
    then drop it. Exactly 1.0 leaves the bar untouched; a factor of 0
    leaves the volume alone."""
    fac = F.coalesce(F.col(factor), F.lit(1.0))
    same = fac == 1.0
    out = bars
    for p in ("o", "h", "l", "c"):
        out = out.withColumn(p, F.when(same, F.col(p)).otherwise(scale_price(F.col(p), fac)))
    out = out.withColumn(
        "v", F.when(same | (fac == 0), F.col("v"))
              .otherwise(F.bround(F.col("v") / fac, 0).cast("long")))
    return out.drop(factor)
