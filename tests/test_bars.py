import datetime as dt

import pytest
from pyspark.sql import functions as F

from barkeep.operators.candles import fold_bars, resample
from barkeep.operators.sessions import last_sessions, latest_bars, source_fallback
from barkeep.plans.board import board, board_spec
from barkeep.schema import ACTION


def _minutes(day, start_h, start_m, n, sym="A", price=10.0):
    rows = []
    for i in range(n):
        m = start_h * 60 + start_m + i
        rows.append((sym, day, "%02d:%02d" % (m // 60, m % 60), price + i, price + i + 1,
                     price + i - 1, price + i + 0.5, 10 + i))
    return rows


def test_fold_factor_one_is_identity(make_bars):
    b = make_bars(_minutes("2026-08-18", 9, 15, 7))
    assert fold_bars(b, 1) is b


def test_fold_not_divisible_and_two_sessions(make_bars):
    b = make_bars(_minutes("2026-08-18", 9, 15, 7) + _minutes("2026-08-19", 9, 15, 3))
    out = fold_bars(b, 3).orderBy("ts").collect()
    assert len(out) == 4                     # 3+3+1 on the 18th, 3 on the 19th
    first = out[0]
    assert (first.o, first.h, first.l, first.c, first.v) == (10.0, 13.0, 9.0, 12.5, 33)
    assert out[2].v == 16                   # the short last candle of the session
    assert out[3].date == dt.date(2026, 8, 19)


def test_fold_gap_is_positional(make_bars):
    rows = _minutes("2026-08-18", 9, 15, 2) + _minutes("2026-08-18", 10, 0, 2, price=50)
    out = fold_bars(make_bars(rows), 3).orderBy("ts").collect()
    assert [r.v for r in out] == [10 + 11 + 10, 11]


def test_fold_conserves_session_totals(make_bars):
    b = make_bars(_minutes("2026-08-18", 9, 15, 40) + _minutes("2026-08-19", 11, 0, 17))
    f = fold_bars(b, 7)
    agg = [F.sum("v"), F.max("h"), F.min("l")]
    assert sorted(b.groupBy("date").agg(*agg).collect()) == sorted(f.groupBy("date").agg(*agg).collect())


def test_resample_clock_buckets(make_bars):
    b = make_bars(_minutes("2026-08-18", 9, 15, 10))
    rows = resample(b, 300).orderBy("bucket").collect()
    assert len(rows) == 2 and rows[0].vol == sum(range(10, 15))


def test_last_sessions_weekend_and_fewer(make_bars):
    rows = []
    for d in ("2026-08-13", "2026-08-14", "2026-08-17", "2026-08-18"):   # Thu Fri Mon Tue
        rows += _minutes(d, 9, 15, 2)
    rows += _minutes("2026-08-18", 9, 15, 1, sym="B")
    got = {(r.symbol, r.date.isoformat()) for r in last_sessions(make_bars(rows), 3).collect()}
    assert got == {("A", "2026-08-14"), ("A", "2026-08-17"), ("A", "2026-08-18"), ("B", "2026-08-18")}
    lb = latest_bars(make_bars(rows), 3).collect()
    assert sorted((r.symbol, r.date.isoformat()) for r in lb) == [
        ("A", "2026-08-17"), ("A", "2026-08-18"), ("A", "2026-08-18"), ("B", "2026-08-18")]


def test_source_fallback(make_bars):
    one = make_bars(_minutes("2026-08-18", 9, 15, 3, sym="A"))
    five = make_bars(_minutes("2026-08-18", 9, 15, 2, sym="A") + _minutes("2026-08-18", 9, 15, 2, sym="B"))
    got = sorted((r.symbol, r.src_minutes) for r in source_fallback(one, five).collect())
    assert got == [("A", 1)] * 3 + [("B", 5)] * 2


def test_board_spec():
    assert board_spec(1)[2] == "1m" and board_spec(7)[2] == "1m"
    assert board_spec(8)[2] == "5m" and board_spec(100) == board_spec(44)


@pytest.mark.parametrize("days", [1, 3, 7, 8, 20, 44, 100])
def test_board_days(spark, make_bars, days):
    rows1, rows5 = [], []
    start = dt.date(2026, 8, 3)
    for i in range(30):
        d = (start + dt.timedelta(days=i)).isoformat()
        if (start + dt.timedelta(days=i)).weekday() >= 5:
            continue
        rows1 += _minutes(d, 9, 15, 30, sym="A")
        rows5 += _minutes(d, 9, 15, 12, sym="A") + _minutes(d, 9, 15, 12, sym="B")
    acts = spark.createDataFrame([], ACTION)
    out = board(make_bars(rows1), make_bars(rows5), acts, days).collect()
    syms = {r.symbol for r in out}
    spec_src = board_spec(days)[2]
    assert syms == {"A", "B"}
    a_days = {r.date for r in out if r.symbol == "A"}
    assert len(a_days) == min(days, 22)
    if spec_src == "1m":
        assert {r.minutes for r in out if r.symbol == "B"} >= {5}   # B has no 1m: 5m fallback


def test_board_neither_source(spark, make_bars):
    empty = make_bars([])
    acts = spark.createDataFrame([], ACTION)
    assert board(empty, empty, acts, 7).count() == 0


def test_board_step_and_adjust_before_fold(spark, make_bars):
    rows = _minutes("2026-08-17", 9, 15, 240) + _minutes("2026-08-18", 9, 15, 240, price=2.0)
    acts = spark.createDataFrame([("A", dt.date(2026, 8, 18), "split", 0.2, "s")], ACTION)
    out = board(make_bars(rows), make_bars([]), acts, 3, upto="2026-08-18").orderBy("ts").collect()
    assert {r.minutes for r in out} == {4}                  # 480 bars / 120 -> step 4
    assert len(out) == 120
    assert out[0].o == pytest.approx(2.0)                   # 10.0 x 0.2, scaled before folding
