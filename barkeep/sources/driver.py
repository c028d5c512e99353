"""Inputs derived from the driver's tables.

The driver ships no market data, so the archive's inputs are derived from
`events` (ticks: event_type -> symbol, value -> price, event_id -> order).
Every derivation keeps every row and is plain Spark, so the work grows
with the tables:

* `bars(spark, sf, "1m"|"5m")` - minute / five-minute bars (silver rows).
* `action_feed` - one exchange-feed row per event: vintage, date format
  and subject wording all follow from the event's own fields.
* `weekly_feed` - one feed row per symbol and week, worded from the
  week's tick count; the action store used by adjust and board.
* `payloads` - one upstream chart payload per symbol and IST day, built
  from every tick of that day (inside and outside the session).
* `symbol_list` - the symbol master list, one row per event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barkeep.functions.timecols import epoch_seconds, floor_to, session_date
from barkeep.operators.candles import ticks_to_bars
from barkeep.schema import PAYLOAD, interval_minutes
from barkeep.session import table_path


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def ticks(spark: SparkSession, sf_dir: str, key: str = "event_type") -> DataFrame:
    """Events as ticks. `key="user_id"` gives one symbol per user
    ('U' || user_id), a wider universe for scale runs."""
    ev = read_table(spark, sf_dir, "events")
    sym = (F.col("event_type") if key == "event_type"
           else F.concat(F.lit("U"), F.col("user_id").cast("string")))
    return ev.select(sym.alias("symbol"), "ts", F.col("value").alias("price"),
                     F.col("event_id").alias("seq"))


def bars(spark: SparkSession, sf_dir: str, interval: str = "1m",
         key: str = "event_type") -> DataFrame:
    """Silver-shaped bars (symbol, ts, o, h, l, c, v, date, interval)."""
    return ticks_to_bars(ticks(spark, sf_dir, key),
                         60 * interval_minutes(interval), interval=interval)


def _k(ev: DataFrame):
    return F.get_json_object(ev["props"], "$.k").cast("int")


# --- fixed values: exchange subject wordings used to derive the feed ---
# (template, kind the classifier must give); {a},{b},{x} filled from data.
FEED_SUBJECTS = (
    "Bonus 1:{b}",
    "Bonus issue 3:5",
    "Split From Rs 10/- To Rs {x}/-",
    "Sub-Division From Re 1/- To Re 0.50",
    "Dividend - Rs {a}",
    "",
    "Annual General Meeting",
    "Bonus 1:1 And Dividend Rs 2",
    "Split From Rs 2/- To Rs 10/-",
    "Split From Rs 1.2.3/- To Rs 1/-",
)
# --- end of fixed values ---


def _subject(k, a, b, x):
    branches = None
    for i, tpl in enumerate(FEED_SUBJECTS):
        parts = []
        rest = tpl
        while "{" in rest:
            head, tail = rest.split("{", 1)
            name, rest = tail.split("}", 1)
            parts += [F.lit(head), {"a": a, "b": b, "x": x}[name].cast("string")]
        parts.append(F.lit(rest))
        expr = F.concat(*parts)
        cond = F.pmod(k, F.lit(len(FEED_SUBJECTS))) == i
        branches = F.when(cond, expr) if branches is None else branches.when(cond, expr)
    return branches


def _fmt_date(d, style):
    return (F.when(style == 0, F.date_format(d, "dd-MMM-yyyy"))
             .when(style == 1, F.date_format(d, "yyyy-MM-dd"))
             .when(style == 2, F.date_format(d, "dd-MM-yyyy"))
             .otherwise(F.lit("soon")))


def action_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exchange feed (`feed_rows`).

    Emitted through a generator (one row in, one row out): a feed read from
    JSON has plain columns, and so does this one to the optimizer - predicates
    on them stay above instead of being re-inlined into the derivation."""
    return feed_rows(spark, sf_dir).select(F.inline(F.array("row")))


def feed_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exchange feed as JSON arrays, one per event type and IST day."""
    day = feed_rows(spark, sf_dir).groupBy("_d", "event_type").agg(F.collect_list("row").alias("rows"))
    return day.select(F.to_json("rows").alias("value"))


def feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_type, _d = IST day, row): the exchange feed (D13 columns), one row per event.

    k = props.k picks vintage (k % 3: exDate+subject / ex_dt+purpose /
    exdate+subject), date format (k % 4, 3 = junk) and wording (k % 10);
    numbers in the wording come from user_id and value. A symbol is padded
    and lower case (normalising trims and upper-cases it); an empty symbol
    when user_id % 7 == 0 is dropped by the normaliser.
    """
    ev = read_table(spark, sf_dir, "events")
    epoch = epoch_seconds("ts", ev.schema["ts"].dataType)
    # k and the session date staged once per row (each feeds many branches)
    ev = ev.select("user_id", "event_type", "value", _k(ev).alias("_k"),
                   session_date(epoch).alias("_d"))
    k, d = F.col("_k"), F.col("_d")
    ev = ev.withColumn("_when", _fmt_date(d, F.pmod(k, F.lit(4))))
    when_str = F.col("_when")
    vintage = F.pmod(k, F.lit(3))
    subj = _subject(k, F.floor(F.col("value")).cast("long"),
                    F.pmod(F.col("user_id"), F.lit(4)) + 1,
                    F.element_at(F.array(F.lit(1), F.lit(2), F.lit(5)),
                                 (F.pmod(F.col("user_id"), F.lit(3)) + 1).cast("int")))
    sym = F.when(F.pmod(F.col("user_id"), F.lit(7)) == 0, F.lit("  ")) \
           .otherwise(F.concat(F.lit(" "), F.col("event_type"), F.lit(" ")))
    ev = ev.withColumn("_subj", subj)
    subj = F.col("_subj")
    null = F.lit(None).cast("string")
    row = F.struct(
        sym.alias("symbol"),
        F.when(vintage == 0, when_str).otherwise(null).alias("exDate"),
        F.when(vintage == 1, when_str).otherwise(null).alias("ex_dt"),
        F.when(vintage == 2, when_str).otherwise(null).alias("exdate"),
        F.when(vintage != 1, subj).otherwise(null).alias("subject"),
        F.when(vintage == 1, subj).otherwise(null).alias("purpose"),
    )
    return ev.select("event_type", "_d", row.alias("row"))


# --- fixed values: wordings of the weekly store (factors 0.5, 0.625,
# 0.25 and a dividend that is recorded but not applied) ---
WEEKLY_SUBJECTS = (
    "Bonus 1:1",
    "Bonus issue 3:5",
    "Split From Rs 4/- To Re 1/-",
    "Dividend Rs 7",
)
# --- end of fixed values ---


def weekly_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One feed row per (symbol, calendar week): ex-date is the first
    session date of the week; the wording is picked by the week's tick
    count modulo 4. Grows by aggregation over every event."""
    ev = read_table(spark, sf_dir, "events")
    epoch = epoch_seconds("ts", ev.schema["ts"].dataType)
    t = ev.select(F.upper("event_type").alias("sym"),
                  session_date(epoch).alias("d"))
    g = t.groupBy("sym", F.date_trunc("week", "d").cast("date").alias("wk")) \
         .agg(F.min("d").alias("d"), F.count("*").alias("n"))
    idx = F.pmod(F.col("n"), F.lit(len(WEEKLY_SUBJECTS)))
    subj = None
    for i, s in enumerate(WEEKLY_SUBJECTS):
        subj = F.when(idx == i, F.lit(s)) if subj is None else subj.when(idx == i, F.lit(s))
    row = F.struct(F.col("sym").alias("symbol"),
                   F.date_format("d", "yyyy-MM-dd").alias("exDate"),
                   subj.alias("subject"))
    return g.select(F.inline(F.array(row)))   # plain columns to the optimizer


def payloads(spark: SparkSession, sf_dir: str, interval: str = "1m") -> DataFrame:
    """Upstream chart payloads (bronze rows: symbol, interval, fetched,
    payload JSON) - one per symbol and IST day, holding every bar of that
    day including those outside the session, plus the split and dividend
    events of the weekly store whose ex-date is that day (a split as
    numerator 4.0 / denominator 1.0, its ratio text '4:1' only in even
    weeks).
    A group is one symbol-day: bounded, never a symbol's whole history."""
    ev = read_table(spark, sf_dir, "events")
    secs = 60 * interval_minutes(interval)
    epoch = epoch_seconds("ts", ev.schema["ts"].dataType)
    raw = ev.select(F.upper("event_type").alias("symbol"),
                    floor_to(epoch, secs).alias("ts"),
                    F.col("value").alias("p"), F.col("event_id").alias("seq"))
    b = raw.groupBy("symbol", "ts").agg(
        F.min_by("p", "seq").alias("o"), F.max("p").alias("h"),
        F.min("p").alias("l"), F.max_by("p", "seq").alias("c"),
        F.count("*").cast("double").alias("v"))
    b = b.withColumn("date", session_date("ts"))
    days = b.groupBy("symbol", "date").agg(
        F.sort_array(F.collect_list(F.struct("ts", "o", "h", "l", "c", "v"))).alias("bars"))

    wk = weekly_feed(spark, sf_dir).select(
        "symbol", F.to_date("exDate").alias("date"), "subject")
    ex_epoch = (F.unix_date("date").cast("long") * 86400 - 19800 + 9 * 3600)
    even = (F.weekofyear("date") % 2) == 0
    split = F.struct(ex_epoch.alias("date"), F.lit("4.0").alias("numerator"),
                     F.lit("1.0").alias("denominator"),
                     F.when(even, F.lit("4:1")).alias("splitRatio"))
    div = F.struct(ex_epoch.alias("date"), F.lit("7").alias("amount"))
    ev_rows = wk.select(
        "symbol", "date",
        F.when(F.col("subject").startswith("Split"),
               F.create_map(ex_epoch.cast("string"), split)).alias("splits"),
        F.when(F.col("subject").startswith("Dividend"),
               F.create_map(ex_epoch.cast("string"), div)).alias("dividends"))

    j = days.join(ev_rows, ["symbol", "date"], "left")
    result = F.struct(
        F.transform("bars", lambda x: x["ts"]).alias("timestamp"),
        F.struct(F.array(F.struct(
            F.transform("bars", lambda x: x["o"]).alias("open"),
            F.transform("bars", lambda x: x["h"]).alias("high"),
            F.transform("bars", lambda x: x["l"]).alias("low"),
            F.transform("bars", lambda x: x["c"]).alias("close"),
            F.transform("bars", lambda x: x["v"]).alias("volume"),
        )).alias("quote")).alias("indicators"),
        F.struct(F.col("splits").alias("splits"),
                 F.col("dividends").alias("dividends")).alias("events"),
    )
    payload = F.to_json(F.struct(F.struct(F.array(result).alias("result")).alias("chart")))
    return j.select("symbol", F.lit(interval).alias("interval"),
                    F.col("date").alias("fetched"),
                    F.current_timestamp().alias("landed_at"),
                    payload.alias("payload"))


def symbol_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The symbol master list as read from CSV in its older vintage (header
    ' SERIES' with a leading space): one row per event, series from
    user_id % 3 (EQ / BE / N1), an empty symbol when props.k == 0."""
    ev = read_table(spark, sf_dir, "events")
    k = _k(ev)
    series = F.element_at(F.array(F.lit("EQ"), F.lit(" BE"), F.lit("N1")),
                          (F.pmod(F.col("user_id"), F.lit(3)) + 1).cast("int"))
    sym = F.when(k == 0, F.lit(" ")).otherwise(
        F.concat(F.upper("event_type"), F.lit(" ")))
    return ev.select(sym.alias("SYMBOL"), series.alias(" SERIES"),
                     F.col("event_id").cast("string").alias("ISIN NUMBER"))


def faulty_bars(bars_df: DataFrame, interval: str = "1m") -> DataFrame:
    """Bars with one planted fault per gate, derived from the bars:

    * the session-open bar (minute 555) of every symbol-day appears twice;
    * bars at minute 600 get a high below the low (h = l - 0.5);
    * bars at minute 601 get an open of 0;
    * every bar on the 13th of a month loses its volume (v = 0);
    * on the 20th every symbol trading that day gets a complete synthetic
      session (one bar per slot, price 1.0, volume 1) on top of its own,
      so the day holds more bars than a session can.
    """
    from barkeep.functions.timecols import minute_of_day
    from barkeep.schema import IST_OFFSET_S, SESSION_OPEN_M, session_cap

    m = minute_of_day("ts")
    b = bars_df.select("symbol", "ts", "o", "h", "l", "c", "v", "date")
    b = (b.withColumn("h", F.when(m == 600, F.col("l") - 0.5).otherwise(F.col("h")))
          .withColumn("o", F.when(m == 601, F.lit(0.0)).otherwise(F.col("o")))
          .withColumn("v", F.when(F.dayofmonth("date") == 13, F.lit(0).cast("long"))
                      .otherwise(F.col("v"))))
    dup = b.where(minute_of_day("ts") == 555)
    step = interval_minutes(interval)
    cap = session_cap(interval)
    days = b.where(F.dayofmonth("date") == 20).select("symbol", "date").distinct()
    full = days.select(
        "symbol", "date",
        F.explode(F.sequence(F.lit(0), F.lit(cap - 1))).alias("i"))
    full = full.select(
        "symbol",
        (F.unix_date("date").cast("long") * 86400 - IST_OFFSET_S
         + (F.lit(SESSION_OPEN_M) + F.col("i") * step) * 60).alias("ts"),
        F.lit(1.0).alias("o"), F.lit(1.0).alias("h"), F.lit(1.0).alias("l"),
        F.lit(1.0).alias("c"), F.lit(1).cast("long").alias("v"), "date")
    return b.unionByName(dup).unionByName(full)


def damaged_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed payloads where every response fetched on the 7th of a month
    arrived cut in half (a truncated transfer): the quarantine must name
    exactly those."""
    p = payloads(spark, sf_dir)
    half = F.substring(F.col("payload"), 1, (F.length("payload") / 2).cast("int"))
    return p.withColumn("payload", F.when(F.dayofmonth("fetched") == 7, half)
                        .otherwise(F.col("payload")))


def dirty_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads with what a response may lack: every seventh minute has no
    close, volumes are null in every third minute, the volume array is one
    short, days divisible by 5 have no low array at all, and opens come with
    a third decimal."""
    minute = lambda x: F.floor(x["ts"] / 60)
    p = payloads(spark, sf_dir).select("symbol", "interval", "fetched", "landed_at", F.from_json("payload", PAYLOAD).alias("p"))
    node = F.col("p.chart.result")[0]
    quote = node["indicators"]["quote"][0]
    rows = F.arrays_zip(node["timestamp"].alias("ts"), quote["open"].alias("o"), quote["high"].alias("h"),
                        quote["low"].alias("l"), quote["close"].alias("c"), quote["volume"].alias("v"))
    p = p.withColumn("rows", rows.cast("array<struct<ts:bigint,o:double,h:double,l:double,c:double,v:double>>"))
    volume = F.transform("rows", lambda x: F.when(minute(x) % 3 != 0, x["v"]))
    low = F.when(F.dayofmonth("fetched") % 5 != 0, F.transform("rows", lambda x: x["l"]))
    result = F.struct(
        F.transform("rows", lambda x: x["ts"]).alias("timestamp"),
        F.struct(F.array(F.struct(
            F.transform("rows", lambda x: F.round(x["o"] + 0.003, 3)).alias("open"),
            F.transform("rows", lambda x: x["h"]).alias("high"), low.alias("low"),
            F.transform("rows", lambda x: F.when(minute(x) % 7 != 0, x["c"])).alias("close"),
            F.slice(volume, F.lit(1), F.greatest(F.size("rows") - 1, F.lit(0))).alias("volume"))).alias("quote")).alias("indicators"))
    body = F.to_json(F.struct(F.struct(F.array(result).alias("result")).alias("chart")), {"ignoreNullFields": "false"})
    return p.select("symbol", "interval", "fetched", "landed_at", body.alias("payload"))


def typed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads with values of another type than they should have, by day of
    month modulo 7: 1 a text for the first open, 2 a fraction of a second in
    the first timestamp, 3 one number for all lows, 4 no result, 5 no symbol,
    6 a boolean for the first volume."""
    p = payloads(spark, sf_dir)
    kind, text = F.dayofmonth("fetched") % 7, F.col("payload")
    body = (F.when(kind == 1, F.regexp_replace(text, r'"open":\[[^,\]]*', '"open":["n/a"'))
            .when(kind == 2, F.regexp_replace(text, r'"timestamp":\[(\d+)', r'"timestamp":[$1.5'))
            .when(kind == 3, F.regexp_replace(text, r'"low":\[[^\]]*\]', '"low":1.5'))
            .when(kind == 4, F.lit('{"chart":{"result":null,"error":{"code":"Not Found"}}}'))
            .when(kind == 6, F.regexp_replace(text, r'"volume":\[[^,\]]*', '"volume":[true')).otherwise(text))
    return p.withColumns({"payload": body, "symbol": F.when(kind != 5, F.col("symbol"))})


def closing_bars(spark: SparkSession, sf_dir: str, interval: str) -> DataFrame:
    """Bars of the symbol-sessions that trade at or after 15:00 with prices
    above zero throughout: an archive of them passes every gate."""
    from barkeep.functions.timecols import minute_of_day
    from barkeep.schema import REACH_BY_M

    b = bars(spark, sf_dir, interval)
    good = b.groupBy("symbol", "date").agg(F.max(minute_of_day("ts")).alias("m"), F.min("l").alias("l"))
    return b.join(good.where((F.col("m") >= REACH_BY_M) & (good["l"] > 0)).select("symbol", "date"), ["symbol", "date"], "left_semi")
