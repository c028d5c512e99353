import datetime as dt
import gzip
import json
import os

from conftest import bar_rows, BAR_DDL, epoch
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barkeep.operators.candles import fold_bars
from barkeep.operators.merge import merge_bars
from barkeep.operators.parse import parse_payload
from barkeep.plans.board import board
from barkeep.schema import ACTION
from barkeep.sources.actions import read_action_feed
from barkeep.sources.bronze import read_bronze_files, readable_bronze


def _payload(day, times, base):
    ts = [epoch(day, t) for t in times]
    n = len(ts)
    return {"chart": {"result": [{"timestamp": ts, "indicators": {"quote": [{
        "open": [base] * n, "high": [base + 1] * n, "low": [base - 1] * n,
        "close": [base + 0.5] * n, "volume": [10] * n}]}}]}}


def test_one_file_per_response_layout(spark, scratch):
    root = os.path.join(scratch, "bronze")
    d = os.path.join(root, "interval=1m", "fetched=2026-08-18")
    os.makedirs(d)
    for sym, base in (("TCS", 10), ("INFY", 20)):
        with gzip.open(os.path.join(d, "%s.json.gz" % sym), "wt") as f:
            json.dump(_payload("2026-08-18", ["10:00", "10:01"], base), f)
    with open(os.path.join(d, "BAD.json.gz"), "wb") as f:          # truncated transfer
        f.write(gzip.compress(b'{"chart": {"result": []}}' * 50)[:20])
    files = read_bronze_files(spark, root, "1m", fetched_from="2026-08-18")
    plan = files._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "fetched" in plan
    landed, damaged = readable_bronze(spark, root, "1m", fetched_from="2026-08-18")
    assert sorted(r.symbol for r in landed.collect()) == ["INFY", "TCS"]
    bars = parse_payload(landed)
    assert sorted((r.symbol, r.o) for r in bars.collect()) == [
        ("INFY", 20.0), ("INFY", 20.0), ("TCS", 10.0), ("TCS", 10.0)]
    bad = [r.path for r in damaged.collect()]
    assert len(bad) == 1 and bad[0].endswith("BAD.json.gz")


def test_feed_vintages_differ_by_case(spark, scratch):
    p = os.path.join(scratch, "feed.json")
    rows = [{"symbol": "tcs", "exDate": "18-Aug-2026", "subject": "Bonus 1:1"},
            {"symbol": "infy", "exdate": "19-08-2026", "purpose": "Split From Rs 10/- To Rs 2/-"},
            {"symbol": "sbin", "ex_dt": "2026-08-20", "subject": "Dividend Rs 5"}]
    with open(p, "w") as f:
        json.dump(rows, f)
    feed = read_action_feed(spark, p)
    from barkeep.operators.actions import normalise_actions
    got = sorted((r.symbol, r.ex_date.isoformat(), r.kind) for r in normalise_actions(feed).collect())
    assert got == [("INFY", "2026-08-19", "split"), ("SBIN", "2026-08-20", "dividend"),
                   ("TCS", "2026-08-18", "bonus")]


def test_board_one_symbol(spark, make_bars):
    rows = [(s, "2026-08-18", "10:%02d" % m, 1, 1, 1, 1, 1) for s in ("A", "B") for m in range(10)]
    acts = spark.createDataFrame([], ACTION)
    out = board(make_bars(rows), make_bars([]), acts, 1, symbol="a").collect()
    assert {r.symbol for r in out} == {"A"} and sum(r.v for r in out) == 10


bar = st.tuples(st.sampled_from(["A", "B"]), st.sampled_from(["2026-08-17", "2026-08-18"]),
                st.sampled_from(["09:15", "09:16", "10:00", "15:30"]),
                st.integers(1, 50), st.integers(0, 3))


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(bar, min_size=1, max_size=12), st.integers(1, 4))
def test_merge_is_batching_invariant(spark, rows, cut):
    """Merging fetch batches one at a time gives the same archive as
    merging them all at once (the newest fetch wins either way)."""
    data = []
    for i, (sym, day, hhmm, price, fetch) in enumerate(rows):
        data.append((sym, epoch(day, hhmm), float(price), float(price + 1), float(price - 1),
                     float(price), 1, dt.date.fromisoformat(day),
                     dt.date(2026, 8, 20) + dt.timedelta(days=fetch), i))
    ddl = BAR_DDL + ", fetched date, seq long"
    df = spark.createDataFrame(data, ddl)
    # a fetch never carries two versions of one bar
    df = df.dropDuplicates(["symbol", "ts", "fetched"])
    early = df.where(F.col("fetched") <= F.lit(dt.date(2026, 8, 20) + dt.timedelta(days=cut - 1)))
    late = df.where(F.col("fetched") > F.lit(dt.date(2026, 8, 20) + dt.timedelta(days=cut - 1)))
    keep = {"provenance": True}
    at_once = merge_bars(df.drop("seq"), **keep)
    stepwise = merge_bars(late.drop("seq"), merge_bars(early.drop("seq"), **keep), **keep)
    other = merge_bars(early.drop("seq"), merge_bars(late.drop("seq"), **keep), **keep)
    assert sorted(map(tuple, at_once.collect()), key=str) == sorted(map(tuple, other.collect()), key=str)
    assert sorted(map(tuple, at_once.collect()), key=str) == sorted(map(tuple, stepwise.collect()), key=str)
    again = merge_bars(late.drop("seq"), stepwise, **keep)
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, stepwise.collect()), key=str)
    assert at_once.count() == at_once.select("symbol", "ts").distinct().count()


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(555, 930),
                          st.integers(1, 99), st.integers(0, 9)), min_size=1, max_size=40,
                unique_by=lambda t: (t[0], t[1])),
       st.integers(1, 7))
def test_fold_conserves_totals(spark, rows, factor):
    data = [(s, "2026-08-18", "%02d:%02d" % (m // 60, m % 60), p, p + 2, p - 1, p + 1, v)
            for s, m, p, v in rows]
    b = spark.createDataFrame(bar_rows(data), BAR_DDL)
    f = fold_bars(b, factor)
    agg = [F.sum("v"), F.max("h"), F.min("l"), F.min("ts")]
    assert sorted(b.groupBy("symbol").agg(*agg).collect()) == sorted(f.groupBy("symbol").agg(*agg).collect())
    per = {r.symbol: r.n for r in b.groupBy("symbol").agg(F.count("*").alias("n")).collect()}
    got = {r.symbol: r.n for r in f.groupBy("symbol").agg(F.count("*").alias("n")).collect()}
    assert got == {s: -(-n // factor) for s, n in per.items()}


def test_symbol_list_csv(spark, scratch):
    from barkeep.sources.actions import listed_symbols, read_symbol_list
    p = os.path.join(scratch, "EQUITY_L.csv")
    with open(p, "w") as f:
        f.write("SYMBOL,NAME OF COMPANY, SERIES,DATE OF LISTING\n")
        f.write("TCS,Tata,EQ,25-AUG-2004\nINFY,Infosys,BE,08-FEB-1995\nTCS,Tata,EQ,x\n,Blank,EQ,x\n")
    assert [r.symbol for r in listed_symbols(read_symbol_list(spark, p)).collect()] == ["TCS"]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 12),
                          st.sampled_from([0.5, 0.2, 0.75, None]),
                          st.sampled_from(["split", "bonus", "dividend"])), max_size=10),
       st.lists(st.tuples(st.sampled_from(["A", "B", "C"]), st.integers(0, 12)), min_size=1, max_size=12),
       st.integers(0, 12))
def test_action_factors_match_brute_force(spark, acts, days, upto):
    """The as-of window lookup equals the definition: product of known
    factors with day < ex_date <= upto, per symbol."""
    from barkeep.operators.actions import action_factors
    base = dt.date(2026, 1, 1)
    arows = [(s, base + dt.timedelta(days=d), k, f, "x") for s, d, f, k in acts]
    adf = spark.createDataFrame(arows, ACTION)
    drows = sorted({(s, base + dt.timedelta(days=d)) for s, d in days})
    ddf = spark.createDataFrame(drows, "symbol string, date date")
    end = base + dt.timedelta(days=upto)
    got = {(r.symbol, r.date): r.factor for r in action_factors(ddf, adf, end).collect()}
    assert set(got) == set(drows)
    for sym, day in drows:
        want = 1.0
        for s, ex, _k, f, _ in arows:
            if s == sym and f is not None and day < ex <= end:
                want *= f
        assert abs(got[(sym, day)] - want) < 1e-12, (sym, day, got[(sym, day)], want)
