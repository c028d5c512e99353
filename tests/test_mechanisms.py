"""The plan mechanisms: fixed-width gates, footer counts, the kept day table,
the catalogued archive, and the symbol index of the files."""
import datetime as dt
import os
import re
import shutil

import pytest
from conftest import epoch
from pyspark.sql import functions as F

from barkeep.operators.checks import check_summary, run_checks, session_gaps
from barkeep.operators.actions import normalise_actions
from barkeep.plans.board import board, board_of_archive
from barkeep.sources import driver as D
from barkeep.sources.silver import (add_partitions, archive_counts, archive_table, available, load_bars, merge_into_silver,
                                    refresh_check_summary, table_sessions, write_silver)

SF = "/root/testdata/sf0.001"
DAY = "2026-08-18"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _final(df) -> str:
    df.write.format("noop").mode("overwrite").save()
    return _plan(df)


def _silver(spark, scratch):
    root = os.path.join(scratch, "silver")
    for iv in ("1m", "5m"):
        write_silver(D.bars(spark, SF, iv), root, iv)
    return root


# --- gates: fixed-width folds, one scan, named rows ------------------------------

def test_gates_are_one_scan_of_hash_aggregates(spark, scratch):
    root = _silver(spark, scratch)
    plan = _plan(run_checks(load_bars(spark, root, "1m"), "1m", as_of="2024-02-04"))
    assert plan.count("FileScan parquet") == 1 and "ObjectHashAggregate" not in plan and "collect_set" not in plan
    summary = _plan(check_summary(load_bars(spark, root, "1m")))
    assert "HashAggregate" in summary and "SortAggregate" not in summary and "ObjectHashAggregate" not in summary


def _odd_bars(spark):
    """(symbol, ts, date, v): whole minutes, odd seconds, hours outside the
    session, another date's timestamps; some many times."""
    base = epoch(DAY, "09:15")
    stamps = [base, base, base, base + 60, base + 27, base + 27, base + 28, base + 3600 * 8, base + 3600 * 8 + 27,
              base + 86400, base + 86400, base - 3600 * 9, base + 375 * 60, base + 300]
    rows = [("A", t, dt.date.fromisoformat(DAY)) for t in stamps] + [("B", base + 60 * i, dt.date.fromisoformat(DAY)) for i in (0, 2, 3)]
    rows += [("C", -3541 + i, dt.date(1969, 12, 31)) for i in (0, 0, 1)]
    return spark.createDataFrame(rows, "symbol string, ts long, date date").select(
        "symbol", "ts", *[F.lit(1.0).alias(c) for c in "ohlc"], F.lit(2).cast("long").alias("v"), "date"), rows


def test_distinct_timestamps_are_exact_in_every_lane(spark):
    bars, rows = _odd_bars(spark)
    got = {(r.symbol, r.date): (r.n, r.n_ts) for r in check_summary(bars).collect()}
    want = {}
    for s, t, d in rows:
        n, ts = want.get((s, d), (0, set()))
        want[(s, d)] = (n + 1, ts | {t})
    assert got == {k: (n, len(ts)) for k, (n, ts) in want.items()}


def test_session_gaps_against_brute_force(spark):
    bars, rows = _odd_bars(spark)
    for interval, step in (("1m", 1), ("5m", 5)):
        got = {r.symbol: tuple(r)[2:] for r in session_gaps(bars, interval).collect()}
        for s in ("A", "B"):
            on = [(t + 19800) % 86400 // 60 for x, t, d in rows if x == s and t % 60 == 0 and str(dt.date(1970, 1, 1) + dt.timedelta((t + 19800) // 86400)) == DAY
                  and 540 <= (t + 19800) % 86400 // 60 < 960]
            slots = [m for m in range(555, 931, step)]
            held = sorted({m for m in on if m in slots})
            inside = [m for m in slots if held[0] < m < held[-1] and m not in held]
            assert got[s] == (len(held), len(slots) - len(held), len(on) - len(set(on)), held[0], held[-1], min(inside, default=None)), (s, interval)
        assert "C" not in got


def test_failing_verdicts_name_up_to_five_rows(make_bars):
    rows = [("S%d" % s, "2026-08-%d" % d, "15:%02d" % m, 1, 1, 1, 1, 1) for s in range(3) for d in (17, 18) for m in range(4)]
    bad = [(s, d, t, 5, 1, 1, 1, 1) if d.endswith("18") and s != "S1" and t != "15:03" else (s, d, t, 1, 1, 1, 1, 1) for s, d, t, *_ in rows]
    detail = {r.check: r.detail for r in run_checks(make_bars(bad), "1m", as_of="2026-08-18").collect()}
    named = ["%s@%d" % (s, epoch("2026-08-18", "15:%02d" % m)) for s in ("S0", "S2") for m in range(3)]
    assert detail["candles well formed"] == "6 malformed bar(s); first: " + ", ".join(named[:5])
    zero = [(*r[:3], 0, 1, 0, 1, 1) if r[0] == "S2" and r[2] == "15:01" else r for r in rows]
    detail = {r.check: r.detail for r in run_checks(make_bars(zero), "1m", as_of="2026-08-18").collect()}
    assert detail["prices positive"] == "2 bar(s) with price <= 0 or volume < 0; first: " + ", ".join(
        "S2@%d" % epoch("2026-08-%d" % d, "15:01") for d in (17, 18))


# --- counts from footers ----------------------------------------------------------

def test_counts_come_from_footers_and_leave_the_session_alone(spark, scratch):
    root = _silver(spark, scratch)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    counts = archive_counts(spark, root)
    plan = _plan(counts)
    assert re.search(r"PushedAggregation: \[COUNT\(\*\), MIN\(ts\), MAX\(ts\)\]", plan) and "PushedGroupBy: [interval, date]" in plan
    assert "symbol" not in plan and spark.conf.get("spark.sql.sources.useV1SourceList") == before
    plain = load_bars(spark, root, "1m").unionByName(load_bars(spark, root, "5m")).groupBy("interval", "date").agg(
        F.count("*"), F.min("ts"), F.max("ts"))
    assert sorted(map(tuple, counts.collect())) == sorted(map(tuple, plain.collect()))
    assert archive_counts(spark, os.path.join(scratch, "nothing")).collect() == []


# --- the kept day table -------------------------------------------------------------

@pytest.mark.parametrize("days", [1, 7, 20])
def test_board_of_an_archive_equals_the_board_of_its_bars(spark, scratch, days):
    root, summary = _silver(spark, scratch), os.path.join(scratch, "summary")
    store = normalise_actions(D.weekly_feed(spark, SF))
    b1, b5 = load_bars(spark, root, "1m"), load_bars(spark, root, "5m")
    kept = board_of_archive(spark, root, summary, store, days)
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, board(b1, b5, store, days).collect()))
    one = board_of_archive(spark, root, summary, store, days, upto="2024-01-20", symbol="click")
    assert sorted(map(tuple, one.collect())) == sorted(map(tuple, board(b1, b5, store, days, "2024-01-20", "click").collect()))


def test_board_of_an_archive_scans_each_grain_once(spark, scratch):
    root, summary = _silver(spark, scratch), os.path.join(scratch, "summary")
    store = normalise_actions(D.weekly_feed(spark, SF))
    plan = _plan(board_of_archive(spark, root, summary, store, 7))
    assert len(re.findall(r"FileScan parquet \[symbol#\d+,ts#\d+L,o#", plan)) == 2
    others = re.findall(r"FileScan parquet \[[^\]]*\].*", plan)
    assert all("silver" not in x or "o#" in x for x in others)        # else only the decided rows are read
    assert len(re.findall(r"Exchange", plan)) <= 7


def test_kept_day_table_follows_the_archive(spark, make_bars, scratch):
    root, summary = os.path.join(scratch, "silver"), os.path.join(scratch, "summary")
    actions = normalise_actions(D.weekly_feed(spark, SF)).limit(0)
    write_silver(make_bars([("A", DAY, "10:00", 1, 1, 1, 1, 1)]), root, "5m")
    assert board_of_archive(spark, root, summary, actions, 7).count() == 1
    merge_into_silver(make_bars([("A", DAY, "10:05", 1, 1, 1, 1, 1), ("B", "2026-08-19", "10:00", 1, 1, 1, 1, 1)]), root, "5m")
    assert sorted(r.symbol for r in board_of_archive(spark, root, summary, actions, 7).collect()) == ["A", "A", "B"]
    assert board_of_archive(spark, os.path.join(scratch, "none"), summary, actions, 7).count() == 0


# --- the catalogued archive -----------------------------------------------------------

def test_catalogued_archive(spark, make_bars, scratch):
    root = os.path.join(scratch, "silver")
    bar = lambda day, t="10:00", price=1: ("A", day, t, price, price, price, price, 1)
    write_silver(make_bars([bar("2026-08-17"), bar("2026-08-18")]), root, "1m")
    base = os.path.join(root, "interval=1m")
    shutil.copytree(os.path.join(base, "date=2026-08-18"), os.path.join(base, "date=junk"))
    archive_table(spark, root, "1m", "archive_1m")
    try:
        days = lambda: [str(r.date) for r in table_sessions(spark, "archive_1m").collect()]
        assert days() == ["2026-08-17", "2026-08-18"] and spark.table("archive_1m").count() == 2
        merge_into_silver(make_bars([bar("2026-08-18", price=2), bar("2026-08-19")]), root, "1m", table="archive_1m")
        assert days() == ["2026-08-17", "2026-08-18", "2026-08-19"]
        assert sorted((str(r.date), r.o) for r in spark.table("archive_1m").collect()) == [
            ("2026-08-17", 1.0), ("2026-08-18", 2.0), ("2026-08-19", 1.0)]
        one = spark.table("archive_1m").where("date = DATE '2026-08-18' AND symbol = 'A'")
        plan = _final(one)
        assert "CatalogFileIndex" in _plan(spark.table("archive_1m")) or "PartitionFilters: [isnotnull(date" in plan
        assert "EqualTo(symbol,A)" in plan
        add_partitions(spark, "archive_1m", available(spark, root, "1m"))                  # once more changes nothing
        assert len(days()) == 3
    finally:
        spark.sql("DROP TABLE archive_1m")
    assert load_bars(spark, root, "1m").count() == 3


# --- the symbol index of the files ------------------------------------------------------

def test_an_absent_symbol_reads_no_row_group(spark, scratch):
    root = os.path.join(scratch, "silver")
    n = 400_000
    rows = spark.range(n).select(
        F.format_string("S%06d", (F.col("id") % 50_000) * 2).alias("symbol"), F.col("id").alias("ts"),
        *[F.rand(i).alias(c) for i, c in enumerate("ohlc")], F.col("id").alias("v"), F.lit(DAY).cast("date").alias("date"))
    write_silver(rows, root, "1m")

    def read(symbol):
        df = load_bars(spark, root, "1m", symbol=symbol, since=DAY, upto=DAY)
        q = df._jdf.queryExecution()
        df2 = spark.createDataFrame([], "x int")  # keeps the session active
        assert df2.columns == ["x"]
        out = len(df.collect())
        scans = [p for p in _leaves(df._jdf.queryExecution().executedPlan()) if p.nodeName().startswith("Scan parquet")]
        assert q is not None and scans
        return out, sum(p.metrics().apply("numOutputRows").value() for p in scans)

    held, scanned = read("S000100")
    assert held == 8 and 0 < scanned < n
    assert read("S000101") == (0, 0)              # within every file's range, in none of them


def _leaves(plan):
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _leaves(plan.executedPlan())
    children = plan.children()
    if not children.size():
        return [plan]
    return [x for i in range(children.size()) for x in _leaves(children.apply(i))]


def test_gates_from_a_summary_kept_before_examples_were(spark, make_bars, scratch):
    from barkeep.plans.ingest import check_archive
    root, summary = os.path.join(scratch, "silver"), os.path.join(scratch, "summary")
    write_silver(make_bars([("A", DAY, "15:00", 5, 1, 1, 1, 1)]), root, "1m")
    refresh_check_summary(spark, root, summary, "1m", [dt.date.fromisoformat(DAY)])
    got = {r.check: r.detail for r in check_archive(spark, root, as_of=DAY, intervals=("1m",), summary_root=summary).collect()}
    assert got["candles well formed"] == "1 malformed bar(s); first: A@%d" % epoch(DAY, "15:00")
