import datetime as dt

import pytest

from barkeep.functions.actions import classify, parse_feed_date
from barkeep.operators.actions import (action_conflicts, action_counts, action_factors,
                                       adjust_bars, merge_actions, new_actions,
                                       normalise_actions)
from barkeep.schema import ACTION


@pytest.mark.parametrize("subject,kind,factor", [
    ("Bonus 1:1", "bonus", 0.5),
    ("Bonus issue 3:5", "bonus", 0.625),
    ("Split From Rs 10/- To Rs 2/-", "split", 0.2),
    ("Face Value Sub-Division From Re 1/- To Re 0.50", "split", 0.5),
    ("Split From Rs 2/- To Rs 10/-", "split", None),          # reverse: no factor
    ("Dividend Rs 5", "dividend", None),
    ("", "unknown", None),
    ("   ", "unknown", None),
    (None, "unknown", None),
    ("Split From Rs 1.2.3/- To Rs 1/-", "split", None),       # unparseable number
    ("Bonus 1:1 And Dividend Rs 2", "bonus", 0.5),             # bonus wins
    ("Annual General Meeting", "other", None),
    ("Bonus 0:5", "bonus", None),
    ("stock split", "split", None),
])
def test_classify(spark, subject, kind, factor):
    df = spark.createDataFrame([(subject,)], "s string")
    r = df.select(classify("s").alias("k")).first().k
    assert r.kind == kind
    assert r.factor == (pytest.approx(factor) if factor is not None else None)


@pytest.mark.parametrize("raw,want", [
    ("18-Aug-2026", dt.date(2026, 8, 18)),
    ("18-AUG-2026", dt.date(2026, 8, 18)),
    ("2026-08-18", dt.date(2026, 8, 18)),
    ("18-08-2026", dt.date(2026, 8, 18)),
    (" 8-Aug-2026 ", dt.date(2026, 8, 8)),
    ("", None),
    ("soon", None),
    (None, None),
])
def test_feed_dates(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "s string")
    assert df.select(parse_feed_date("s").alias("d")).first().d == want


def test_normalise_vintages(spark):
    rows = [
        (" tcs ", "18-Aug-2026", None, None, "Bonus 1:1", None),
        ("infy", None, "2026-08-19", None, None, "Split From Rs 10/- To Rs 2/-"),
        ("wipro", None, None, "20-08-2026", "Dividend Rs 5", None),
        ("", "18-Aug-2026", None, None, "Bonus 1:1", None),          # no symbol
        ("hdfc", "junk", None, None, "Bonus 1:1", None),             # no date
        ("sbin", "", "2026-08-21", None, "", "AGM"),                 # empty -> next field
    ]
    feed = spark.createDataFrame(rows, "symbol string, exDate string, ex_dt string, "
                                       "exdate string, subject string, purpose string")
    got = {(r.symbol, r.ex_date.isoformat(), r.kind, r.factor, r.subject)
           for r in normalise_actions(feed).collect()}
    assert got == {
        ("TCS", "2026-08-18", "bonus", 0.5, "Bonus 1:1"),
        ("INFY", "2026-08-19", "split", 0.2, "Split From Rs 10/- To Rs 2/-"),
        ("WIPRO", "2026-08-20", "dividend", None, "Dividend Rs 5"),
        ("SBIN", "2026-08-21", "other", None, "AGM"),
    }


def _acts(spark, rows):
    return spark.createDataFrame(
        [(s, dt.date.fromisoformat(d), k, f, subj) for s, d, k, f, subj in rows], ACTION)


def test_merge_actions_and_new(spark):
    store = _acts(spark, [("TCS", "2026-01-05", "split", 0.2, "old"),
                          ("INFY", "2025-06-01", "bonus", 0.5, "kept")])
    incoming = _acts(spark, [("TCS", "2026-01-05", "split", 0.5, "new"),
                             ("WIPRO", "2026-02-01", "dividend", None, "d"),
                             ("WIPRO", "2026-02-01", "dividend", None, "d")])
    merged = {(r.symbol, r.kind, r.factor, r.subject) for r in merge_actions(incoming, store).collect()}
    assert merged == {("TCS", "split", 0.5, "new"), ("INFY", "bonus", 0.5, "kept"),
                      ("WIPRO", "dividend", None, "d")}
    assert new_actions(incoming, store).count() == 2   # a repeated new key counts per row
    counts = {r.kind: (r.n, r.adjusting, r.unparsed) for r in action_counts(incoming).collect()}
    assert counts == {"split": (1, 1, 0), "dividend": (2, 0, 0)}


def test_conflicts(spark):
    acts = _acts(spark, [("A", "2026-01-05", "bonus", 0.5, "b"),
                         ("A", "2026-01-05", "split", 0.5, "s"),
                         ("B", "2026-01-05", "split", 0.2, "s")])
    rows = action_conflicts(acts).collect()
    assert [(r.symbol, r.n_factors, r.kinds, r.combined) for r in rows] == [("A", 2, "bonus,split", 0.25)]


def test_adjust_range_and_composition(spark, make_bars):
    bars = make_bars([
        ("TCS", "2026-08-17", "10:00", 100, 110, 90, 105, 1000),
        ("TCS", "2026-08-18", "10:00", 20, 22, 18, 21, 5000),
        ("TCS", "2026-08-19", "10:00", 10, 11, 9, 10.5, 9000),
        ("INFY", "2026-08-17", "10:00", 50, 55, 45, 52, 7),
    ])
    acts = _acts(spark, [
        ("TCS", "2026-08-18", "split", 0.2, "s"),     # > 17th, <= upto: applies to the 17th only
        ("TCS", "2026-08-19", "bonus", 0.5, "b"),     # = upto: applies to the 17th and 18th
        ("TCS", "2026-08-20", "bonus", 0.5, "late"),  # after upto: never
        ("TCS", "2026-08-18", "dividend", None, "d"),  # NULL factor ignored
    ])
    got = {(r.symbol, r.date.isoformat()): r for r in adjust_bars(bars, acts, "2026-08-19").collect()}
    a = got[("TCS", "2026-08-17")]
    assert (a.o, a.h, a.l, a.c, a.v) == (10.0, 11.0, 9.0, 10.5, 10000)
    b = got[("TCS", "2026-08-18")]
    assert (b.o, b.c, b.v) == (10.0, 10.5, 10000)
    c = got[("TCS", "2026-08-19")]
    assert (c.o, c.v) == (10.0, 9000)                     # ex_date = bar date: not applied
    d = got[("INFY", "2026-08-17")]
    assert (d.o, d.v) == (50.0, 7)                        # no actions: untouched
    f = {(r.symbol, r.date.isoformat()): r.factor for r in action_factors(
        bars.select("symbol", "date").distinct(), acts, dt.date(2026, 8, 19)).collect()}
    assert f[("TCS", "2026-08-17")] == pytest.approx(0.1)
    assert f[("INFY", "2026-08-17")] == 1.0


def test_adjust_rounds_half_up_in_decimal(spark, make_bars):
    bars = make_bars([("A", "2026-08-17", "10:00", 0.09, 0.09, 0.09, 0.09, 3)])
    acts = _acts(spark, [("A", "2026-08-18", "bonus", 0.625, "Bonus 3:5")])
    r = adjust_bars(bars, acts, "2026-08-18").first()
    assert r.o == 0.0563            # 0.05625 exactly -> half-up
    assert r.v == 5                 # 3 / 0.625 = 4.8 -> 5
