import datetime as dt
import json

from conftest import epoch
from pyspark.sql import functions as F

from barkeep.functions.timecols import in_session, minute_of_day, session_date
from barkeep.operators.parse import parse_events, parse_payload


def _payload(ts, o=None, h=None, lo=None, c=None, v=None, events=None, quote=True):
    q = {}
    for k, arr in (("open", o), ("high", h), ("low", lo), ("close", c), ("volume", v)):
        if arr is not None:
            q[k] = arr
    node = {"timestamp": ts}
    if quote:
        node["indicators"] = {"quote": [q]}
    if events is not None:
        node["events"] = events
    return json.dumps({"chart": {"result": [node]}})


def _bronze(spark, rows):
    return spark.createDataFrame(
        [(s, "1m", dt.date(2026, 8, 18), p) for s, p in rows],
        "symbol string, interval string, fetched date, payload string")


def test_session_arithmetic(spark):
    day = "2026-08-18"
    stamps = [epoch(day, t) for t in ("09:14", "09:15", "15:30", "15:31")]
    df = spark.createDataFrame([(t,) for t in stamps], "ts long")
    got = df.select(minute_of_day("ts").alias("m"), in_session("ts").alias("ok"),
                    session_date("ts").alias("d")).collect()
    assert [r.m for r in got] == [554, 555, 930, 931]
    assert [r.ok for r in got] == [False, True, True, False]
    assert {r.d for r in got} == {dt.date(2026, 8, 18)}


def test_session_date_independent_of_session_timezone(spark):
    ts = epoch("2026-08-18", "00:10")  # 18:40 UTC on the 17th
    df = spark.createDataFrame([(ts,)], "ts long")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
        a = df.select(session_date("ts"), minute_of_day("ts")).first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    b = df.select(session_date("ts"), minute_of_day("ts")).first()
    assert tuple(a) == tuple(b) == (dt.date(2026, 8, 18), 10)


def test_parse_payload_cases(spark):
    day = "2026-08-18"
    t = [epoch(day, x) for x in ("09:14", "09:15", "09:16", "09:17", "09:18", "15:30", "15:31")]
    p = _payload(
        t,
        o=[1.0, 10.004, None, 12.0, 13.0, 14.0, 15.0],
        h=[1.0, 10.5, 11.5, 12.5, 13.5, 14.5, 15.5],
        lo=[1.0, 9.5, 10.5, 11.5, 12.5, 13.5, 14.5],
        c=[1.0, 10.2, 11.2, None, 13.2, 14.2, 15.2],
        v=[5, 100, 200, 300, None, 600.7],  # short: the 15:31 bar has no volume slot
    )
    rows = parse_payload(_bronze(spark, [("tcs", p)])).orderBy("ts").collect()
    # 09:14 out of session; 09:16 null open; 09:17 null close; 15:31 out of session
    assert [r.ts for r in rows] == [t[1], t[4], t[5]]
    assert {r.symbol for r in rows} == {"TCS"}
    assert rows[0].o == 10.0 and rows[0].v == 100
    assert rows[1].v == 0                      # null volume kept as 0
    assert rows[2].v == 600                    # truncated to an integer
    assert {r.date for r in rows} == {dt.date(2026, 8, 18)}


def test_parse_short_volume_array_drops_bar(spark):
    t = [epoch("2026-08-18", x) for x in ("10:00", "10:01")]
    p = _payload(t, o=[1.0, 2.0], h=[1.0, 2.0], lo=[1.0, 2.0], c=[1.0, 2.0], v=[7])
    rows = parse_payload(_bronze(spark, [("A", p)])).collect()
    assert [(r.ts, r.v) for r in rows] == [(t[0], 7)]


def test_parse_empty_and_missing(spark):
    empty = json.dumps({"chart": {"result": []}})
    noquote = _payload([epoch("2026-08-18", "10:00")], quote=False)
    nochart = json.dumps({"error": "x"})
    rows = parse_payload(_bronze(spark, [("A", empty), ("B", noquote), ("C", nochart),
                                         ("D", "not json")])).collect()
    assert rows == []


def test_parse_events_cases(spark):
    d0 = epoch("2026-08-18", "09:15")
    ev = {
        "splits": {
            "a": {"date": d0, "numerator": 5, "denominator": 1, "splitRatio": "5:1"},
            "b": {"date": d0 + 86400, "numerator": 5, "denominator": 1},
            "c": {"date": d0, "numerator": 1, "denominator": 0},
            "d": {"numerator": 2, "denominator": 1},
        },
        "dividends": {
            "x": {"date": d0, "amount": 2.5},
            "y": {"amount": 1.0},
        },
    }
    p1 = _payload([d0], o=[1.0], h=[1.0], lo=[1.0], c=[1.0], v=[1], events=ev)
    p2 = _payload([d0], o=[1.0], h=[1.0], lo=[1.0], c=[1.0], v=[1])  # no events key
    rows = parse_events(_bronze(spark, [("infy", p1), ("tcs", p2)])) \
        .orderBy("kind", "ex_date").collect()
    got = [(r.symbol, r.ex_date.isoformat(), r.kind, r.factor, r.subject) for r in rows]
    assert got == [
        ("INFY", "2026-08-18", "dividend", None, "yahoo dividend 2.5"),
        ("INFY", "2026-08-18", "split", 0.2, "yahoo split 5:1"),
        ("INFY", "2026-08-19", "split", 0.2, "yahoo split 5:1"),
    ]


def test_minute_filter_pushes_into_plan(spark):
    df = spark.range(10).select((F.col("id") * 60 + 1755500000).alias("ts"))
    assert df.where(in_session("ts")).count() >= 0
