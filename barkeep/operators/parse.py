"""Payload parsing (P1-P5, S3, Y13, Y15): landed chart JSON -> bar rows,
corporate-action rows, and the names of everything that is neither.

A response is read once, by `from_json` with an explicit schema and a
corrupt-record column. Where that column is set although the text is JSON, a
value has another type than the schema's: such a response is read again as a
variant, value by value, so one wrong value costs its own bar and no other.
Arrays are taken by position with `posexplode` + `get` (never `arr[i]`, which
raises under ANSI when an array is short). One payload is one symbol-fetch: a
few thousand bars at most, exploded inside the task that read it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barkeep.functions.timecols import in_session, session_date
from barkeep.schema import EVENTS, PAYLOAD

# --- fixed values: subject prefixes of actions read from payload events ---
SPLIT_SUBJECT = "yahoo split "
DIVIDEND_SUBJECT = "yahoo dividend "
# --- end of fixed values ---

# --- reasons of the quarantine (S3) ---
NO_SYMBOL, NO_INTERVAL, ODD_INTERVAL, NO_FETCH_DATE = "no symbol", "no interval", "unknown interval", "no fetch date"
BLANK, NO_CHART, NO_RESULT, ODD_EVENT = "empty", "not a chart payload", "no result", "unreadable event"

#: Interval names this archive can hold: whole minutes.
GRAIN = r"^[1-9][0-9]{0,3}m$"
#: Last epoch second of the year 9999: what lies beyond is no session.
LAST_SECOND = 253402300799

_VALUES = ("open", "high", "low", "close", "volume")
_NUMBER = r"^(BIGINT|DOUBLE|FLOAT|DECIMAL)"
_CORRUPT = "_corrupt"
_CHECKED = T.StructType([*PAYLOAD.fields, T.StructField(_CORRUPT, T.StringType())])
_RESULT = "$.chart.result[0]"


def _part(path: str, kind: str) -> Column:
    return F.try_variant_get(F.col("_v"), _RESULT + path, kind)


def _kind(value: Column) -> Column:
    """VOID, BIGINT, STRING, .. of a variant; null where there is none."""
    return F.schema_of_variant(value)


def _quote(name: str) -> str:
    return ".indicators.quote[0]." + name


def _number(e: Column) -> Column:
    return F.when(_kind(e).rlike(_NUMBER), F.try_variant_get(e, "$", "double"))


def _seconds(e: Column) -> Column:
    """Epoch seconds: a fraction is cut off, what is no number or no date of
    this calendar is null."""
    n = _number(e)
    return F.when(n.between(-LAST_SECOND, LAST_SECOND), n.cast("long"))


def _volume(e: Column) -> Column:
    """A number or an integer's text; null where the value is null, NaN (no
    volume: the bar goes) where it is anything else."""
    text = F.when(_kind(e) == "STRING", F.try_variant_get(e, "$", "string"))
    return F.when(F.is_variant_null(e), F.lit(None).cast("double")).otherwise(F.coalesce(
        _number(e), F.when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.trim(text).try_cast("double")), F.lit(float("nan"))))


def read_responses(bronze: DataFrame) -> DataFrame:
    """`bronze` with what was read of each payload: `_p` (by schema), `_v`
    (a variant, only where a value deviates from the schema), and `_fault`,
    why the whole response cannot be used, or null."""
    r = bronze.withColumn("_p", F.from_json("payload", _CHECKED, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}))
    stamps = F.get(F.col("_p.chart.result"), 0)["timestamp"]
    odd = F.col("_p")[_CORRUPT].isNotNull() | F.exists(stamps, lambda t: ~t.between(-LAST_SECOND, LAST_SECOND))
    r = r.withColumn("_v", F.when(odd, F.try_parse_json("payload")))
    chart = F.when(F.col("_v").isNull(), F.col("_p.chart").isNotNull() & F.col("_p")[_CORRUPT].isNull()).otherwise(
        F.coalesce(_kind(F.try_variant_get("_v", "$.chart", "variant")).startswith("OBJECT"), F.lit(False)))
    node = F.when(F.col("_v").isNull(), F.get(F.col("_p.chart.result"), 0).isNotNull()).otherwise(
        F.coalesce(_kind(F.try_variant_get("_v", _RESULT, "variant")).startswith("OBJECT"), F.lit(False)))
    blank = lambda c: F.col(c).isNull() | (F.trim(F.col(c).cast("string")) == "")
    fault = F.when(blank("symbol"), F.lit(NO_SYMBOL))
    if "interval" in bronze.columns:
        fault = fault.when(blank("interval"), F.lit(NO_INTERVAL)).when(~F.col("interval").rlike(GRAIN), F.lit(ODD_INTERVAL))
    if "fetched" in bronze.columns:
        fault = fault.when(F.col("fetched").isNull(), F.lit(NO_FETCH_DATE))
    fault = fault.when(blank("payload"), F.lit(BLANK)).when(~F.coalesce(chart, F.lit(False)), F.lit(NO_CHART)).when(~node, F.lit(NO_RESULT))
    return r.withColumn("_fault", fault)


def parse_payload(bronze: DataFrame, keep=("interval", "fetched", "landed_at")) -> DataFrame:
    """One row per kept bar: symbol, ts, o, h, l, c, v, date, plus
    the `keep` columns present on the input (provenance for merging).

    A bar is kept when its timestamp, open, high, low and close are present
    numbers, it lies inside the session (P2), and the volume array reaches its
    position (a null volume inside the array counts as 0). Prices are rounded
    to 2 places, timestamp and volume truncated to integers. A response with a
    fault gives no bar; `bronze_quarantine` names it and every wrong value.
    """
    return bars_of(read_responses(bronze), keep)


def bars_of(r: DataFrame, keep=("interval", "fetched", "landed_at")) -> DataFrame:
    """P1-P4 over read responses."""
    carry = [c for c in keep if c in r.columns]
    node = F.get(F.col("_p.chart.result"), 0)
    quote = F.get(node["indicators"]["quote"], 0)
    plain = F.struct(node["timestamp"].alias("ts"), *[quote[n].alias(n) for n in _VALUES])
    each = lambda path, read: F.transform(_part(path, "array<variant>"), read)
    by_value = F.struct(each(".timestamp", _seconds).alias("ts"), *[each(_quote(n), _number).alias(n) for n in _VALUES[:4]],
                        each(_quote("volume"), _volume).alias("volume"))
    arrays = F.when(F.col("_fault").isNull(), F.when(F.col("_v").isNull(), plain).otherwise(by_value))
    x = r.select(F.upper("symbol").alias("symbol"), *carry, arrays.alias("_a"))
    x = x.select("symbol", *carry, "_a", F.posexplode(F.col("_a.ts")).alias("_pos", "ts"))

    def at(name):
        return F.get(F.col("_a")[name], F.col("_pos"))

    volumes = F.col("_a")["volume"]
    rows = x.select(
        "symbol", *carry, "ts",
        at("open").alias("o"), at("high").alias("h"), at("low").alias("l"),
        at("close").alias("c"),
        F.coalesce(at("volume"), F.lit(0.0)).alias("v"),
        (F.col("_pos") < F.size(volumes)).alias("_has_v"),
    ).where(F.col("ts").isNotNull() & F.col("c").isNotNull()
            & F.col("o").isNotNull() & F.col("h").isNotNull()
            & F.col("l").isNotNull() & volumes.isNotNull()
            & F.col("_has_v") & ~F.isnan("v") & in_session("ts"))
    return rows.select(
        "symbol", "ts",
        *[F.round(p, 2).alias(p) for p in ("o", "h", "l", "c")],
        F.col("v").cast("long").alias("v"),
        session_date("ts").alias("date"), *carry)


def _event_date(date: Column) -> Column:
    """Epoch seconds of an event's date, a number or its text."""
    n = date.try_cast("double")
    return F.when((n != 0) & n.between(-LAST_SECOND, LAST_SECOND), n.cast("long"))


def _events() -> Column:
    """The events of a usable response."""
    plain = F.get(F.col("_p.chart.result"), 0)["events"]
    again = F.from_json(F.to_json(_part(".events", "variant")), EVENTS)
    return F.when(F.col("_fault").isNull(), F.when(F.col("_v").isNull(), plain).otherwise(again))


def parse_events(bronze: DataFrame) -> DataFrame:
    """P5: split and dividend events in payloads -> action rows (symbol,
    ex_date, kind, factor, subject).

    A split with numerator n and denominator d ("n:d" = n shares where
    there was d) rebases earlier prices by round(d / n, 8); it is skipped
    when n, d or its date is missing or zero. A dividend is recorded with
    a NULL factor (never applied) when it has a date.
    """
    ev = read_responses(bronze).select(F.upper("symbol").alias("symbol"), _events().alias("_e"))
    s = ev.select("symbol", F.explode(F.map_values("_e.splits")).alias("e"))
    num = F.col("e.numerator").try_cast("double")
    den = F.col("e.denominator").try_cast("double")
    ratio = F.coalesce(F.nullif(F.col("e.splitRatio"), F.lit("")),
                       F.concat_ws(":", "e.numerator", "e.denominator"))
    day = _event_date(F.col("e.date"))
    splits = s.where((num > 0) & (den > 0) & day.isNotNull()).select(
        "symbol", session_date(day).alias("ex_date"),
        F.lit("split").alias("kind"), F.round(den / num, 8).alias("factor"),
        F.concat(F.lit(SPLIT_SUBJECT), ratio).alias("subject"))
    d = ev.select("symbol", F.explode(F.map_values("_e.dividends")).alias("e"))
    divs = d.where(day.isNotNull()).select(
        "symbol", session_date(day).alias("ex_date"),
        F.lit("dividend").alias("kind"), F.lit(None).cast("double").alias("factor"),
        F.concat(F.lit(DIVIDEND_SUBJECT),
                 F.coalesce(F.col("e.amount"), F.lit("None"))).alias("subject"))
    return splits.unionByName(divs)


# ------------------------------------------------------------ what was not used

def _wrong_values(path: str, name: str, wrong) -> Column:
    """Names of the values of one array that are not what they should be."""
    whole, values = _part(path, "variant"), _part(path, "array<variant>")
    kind = _kind(whole)
    each = F.transform(values, lambda e, i: F.when(wrong(e), F.concat(
        F.lit(name + "["), i.cast("string"), F.lit("] is "), F.lower(F.regexp_extract(_kind(e), "^[A-Z]+", 0)))))
    return F.when(kind.isNull() | (kind == "VOID"), F.array().cast("array<string>")).when(
        ~kind.startswith("ARRAY"), F.array(F.concat(F.lit(name + " is no array but "), F.lower(F.regexp_extract(kind, "^[A-Z]+", 0))))
    ).otherwise(F.array_compact(each))


def _named() -> Column:
    """Every reason to name a response: its fault, or its wrong values."""
    present = lambda e: ~F.is_variant_null(e)
    wrong = [_wrong_values(".timestamp", "timestamp", lambda e: present(e) & (
        _seconds(e).isNull() | (_number(e) != _seconds(e).cast("double"))))]
    wrong += [_wrong_values(_quote(n), n, lambda e: present(e) & _number(e).isNull()) for n in _VALUES[:4]]
    wrong += [_wrong_values(_quote("volume"), "volume", lambda e: F.isnan(_volume(e)))]
    for name in ("events", "events.splits", "events.dividends"):
        kind = _kind(_part("." + name, "variant"))
        wrong.append(F.when(~(kind.startswith("OBJECT") | (kind == "VOID")), F.array(F.lit(name + " is no object")))
                     .otherwise(F.array().cast("array<string>")))
    nothing = F.array().cast("array<string>")
    by_value = F.when(F.col("_v").isNull(), nothing).otherwise(F.concat(*[F.coalesce(w, nothing) for w in wrong]))
    unreadable = lambda c, read: c.isNotNull() & (F.trim(c) != "") & read(c).isNull()
    as_number = lambda c: c.try_cast("double")
    odd = F.exists(F.map_values("_e.splits"), lambda e: unreadable(e["date"], as_number) | unreadable(e["numerator"], as_number)
                   | unreadable(e["denominator"], as_number))
    odd = F.coalesce(odd, F.lit(False)) | F.coalesce(F.exists(F.map_values("_e.dividends"), lambda e: unreadable(e["date"], as_number)), F.lit(False))
    return F.when(F.col("_fault").isNotNull(), F.array("_fault")).otherwise(
        F.concat(by_value, F.when(odd, F.array(F.lit(ODD_EVENT))).otherwise(nothing)))


def reasons_of(r: DataFrame, cols) -> DataFrame:
    """`cols` and `reason` of read responses: a row per fault, per value of a
    wrong type (its place and what it is) and per response with an event that
    cannot be read."""
    return r.withColumn("_e", _events()).select(*cols, F.explode(_named()).alias("reason"))


def tallies() -> list[Column]:
    """Row accounting over read responses, as aggregates for an Observation:
    every response read is parsed, without content, or quarantined."""
    fault = F.col("_fault")
    empty = fault.isin(BLANK, NO_RESULT)
    return [F.count(F.lit(1)).alias("read"), F.count_if(fault.isNull()).alias("parsed"),
            F.count_if(empty).alias("empty"), F.count_if(fault.isNotNull() & ~empty).alias("quarantined")]
