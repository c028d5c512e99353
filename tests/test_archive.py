import datetime as dt
import json
import os

import pyarrow.parquet as pq
import pytest
from conftest import epoch
from pyspark.sql import functions as F

from barkeep.operators.merge import merge_bars
from barkeep.plans.ingest import ingest, publish_if_passed, rebuild_archive, rebuild_silver
from barkeep.operators.checks import ChecksFailed
from barkeep.sources.actions import (listed_symbols, read_actions, save_actions)
from barkeep.operators.parse import parse_payload
from barkeep.sources.bronze import bronze_quarantine, land_bronze, read_bronze
from barkeep.sources.silver import (archive_bytes, archive_stats, available, load_bars, merge_into_silver,
                                    read_bars_csv, register_views, session_bars, write_silver)
from barkeep.operators.sessions import sessions
from barkeep.schema import ACTION
from barkeep.streaming.merge_stream import stream_merge


def _payload(day, times, base, events=None):
    ts = [epoch(day, t) for t in times]
    n = len(ts)
    node = {"timestamp": ts, "indicators": {"quote": [{
        "open": [base + i for i in range(n)], "high": [base + i + 1 for i in range(n)],
        "low": [base + i - 1 for i in range(n)], "close": [base + i + 0.5 for i in range(n)],
        "volume": [100 + i for i in range(n)]}]}}
    if events:
        node["events"] = events
    return json.dumps({"chart": {"result": [node]}})


def _bronze_df(spark, rows):
    return spark.createDataFrame(
        [(s, iv, dt.date.fromisoformat(f), p) for s, iv, f, p in rows],
        "symbol string, interval string, fetched date, payload string")


def test_merge_newest_wins_and_idempotent(spark, make_bars):
    noon = make_bars([("A", "2026-08-18", "10:00", 1, 1, 1, 1, 5),
                      ("A", "2026-08-18", "10:01", 1, 1, 1, 1, 5)])
    six = make_bars([("A", "2026-08-18", "10:01", 2, 2, 2, 2, 9),
                     ("A", "2026-08-18", "10:02", 2, 2, 2, 2, 9)])
    once = merge_bars(six, noon)
    got = sorted((r.ts, r.o, r.v) for r in once.collect())
    t0 = epoch("2026-08-18", "10:00")
    assert got == [(t0, 1.0, 5), (t0 + 60, 2.0, 9), (t0 + 120, 2.0, 9)]
    twice = merge_bars(six, once)
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_two_fetches_in_one_batch(spark, make_bars):
    a = make_bars([("A", "2026-08-18", "10:00", 1, 1, 1, 1, 5)]).withColumn("fetched", F.lit("2026-08-18").cast("date"))
    b = make_bars([("A", "2026-08-18", "10:00", 3, 3, 3, 3, 7)]).withColumn("fetched", F.lit("2026-08-19").cast("date"))
    r = merge_bars(a.unionByName(b)).collect()
    assert [(x.o, x.v) for x in r] == [(3.0, 7)]


def test_silver_roundtrip_sorted_and_pruned(spark, make_bars, scratch):
    root = os.path.join(scratch, "silver")
    rows = []
    for sym in ("ZED", "ACC", "MID"):
        for m in range(5):
            rows.append((sym, "2026-08-18", "10:%02d" % (4 - m), 1, 1, 1, 1, 1))
    rows.append(("ACC", "2026-08-19", "10:00", 1, 1, 1, 1, 1))
    write_silver(make_bars(rows), root, "1m")
    day_dir = os.path.join(root, "interval=1m", "date=2026-08-18")
    files = sorted(f for f in os.listdir(day_dir) if f.endswith(".parquet"))
    assert len(files) == 1                        # a small day is one file
    keys = []
    for f in files:
        t = pq.read_table(os.path.join(day_dir, f), columns=["symbol", "ts"]).to_pylist()
        k = [(r["symbol"], r["ts"]) for r in t]
        assert k == sorted(k)                     # each file sorted by (symbol, ts)
        keys += k
    assert len(keys) == 15
    one = load_bars(spark, root, "1m", symbol="acc", since="2026-08-19", upto="2026-08-19")
    assert one.count() == 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PushedFilters" in plan and "symbol" in plan
    assert session_bars(spark, root, dt.date(2026, 8, 18), "1m").count() == 15
    assert [r.date.isoformat() for r in sessions(load_bars(spark, root, "1m")).orderBy("date").collect()] == \
        ["2026-08-18", "2026-08-19"]
    st = archive_stats(load_bars(spark, root, "1m")).first()
    assert (st.days, st.bars, st.symbols) == (2, 16, 3)
    assert archive_bytes(spark, root).first().files >= 2
    register_views(spark, root)
    assert spark.sql("SELECT count(*) FROM bars1").first()[0] == 16


def test_merge_into_silver_rewrites_only_touched_days(spark, make_bars, scratch):
    root = os.path.join(scratch, "silver")
    write_silver(make_bars([("A", "2026-08-17", "10:00", 1, 1, 1, 1, 1),
                            ("A", "2026-08-18", "10:00", 1, 1, 1, 1, 1)]), root, "1m")
    days, n = merge_into_silver(make_bars([("A", "2026-08-18", "10:00", 5, 5, 5, 5, 5),
                                           ("A", "2026-08-18", "10:01", 5, 5, 5, 5, 5),
                                           ("B", "2026-08-19", "10:00", 5, 5, 5, 5, 5)]), root, "1m")
    assert (days, n) == (2, 3)
    got = sorted((r.symbol, r.date.isoformat(), r.o) for r in load_bars(spark, root, "1m").collect())
    assert got == [("A", "2026-08-17", 1.0), ("A", "2026-08-18", 5.0), ("A", "2026-08-18", 5.0),
                   ("B", "2026-08-19", 5.0)]
    again = merge_into_silver(make_bars([("A", "2026-08-18", "10:00", 5, 5, 5, 5, 5)]), root, "1m")
    assert again == (1, 2)
    assert load_bars(spark, root, "1m").count() == 4


def test_csv_spool(spark, scratch):
    p = os.path.join(scratch, "spool.csv")
    with open(p, "w") as f:
        f.write("TCS,1755488700,1.0,2.0,0.5,1.5,10,2026-08-18\n")
    r = read_bars_csv(spark, p).first()
    assert (r.symbol, r.v, r.date) == ("TCS", 10, dt.date(2026, 8, 18))


def test_ingest_rebuild_stream(spark, scratch):
    bronze = os.path.join(scratch, "bronze")
    silver = os.path.join(scratch, "silver")
    store = os.path.join(scratch, "actions")
    ev = {"splits": {"x": {"date": epoch("2026-08-18", "09:15"), "numerator": 5, "denominator": 1}}}
    noon = _bronze_df(spark, [("tcs", "1m", "2026-08-18", _payload("2026-08-18", ["10:00", "10:01"], 10, ev)),
                              ("infy", "1m", "2026-08-18", _payload("2026-08-18", ["10:00"], 20))])
    dry = ingest(spark, noon, os.path.join(scratch, "bronze-dry"), os.path.join(scratch, "none"), store, dry=True)
    assert dry == {"1m": 3, "events": 1}
    assert not os.path.exists(os.path.join(scratch, "none"))
    out = ingest(spark, noon, bronze, silver, store)
    assert out["1m"] == (1, 3)
    assert out["actions"] == (1, 1)
    assert read_actions(spark, store).first().factor == 0.2
    six = _bronze_df(spark, [("tcs", "1m", "2026-08-19", _payload("2026-08-18", ["10:01", "10:02"], 50))])
    ingest(spark, six, bronze, silver)
    got = sorted((r.symbol, r.o) for r in load_bars(spark, silver, "1m").collect())
    assert got == [("INFY", 20.0), ("TCS", 10.0), ("TCS", 50.0), ("TCS", 51.0)]
    # a rebuild from bronze alone gives the same archive
    silver2 = os.path.join(scratch, "silver2")
    dry = rebuild_silver(spark, bronze, silver2, "1m", dry=True)
    assert (dry.days, dry.bars, dry.quarantine.count()) == (1, 5, 0)
    assert rebuild_archive(spark, bronze, silver2, intervals=("1m",), dry=True)["1m"].bars == 5
    rebuild_silver(spark, bronze, silver2, "1m")
    same = sorted((r.symbol, r.ts, r.o) for r in load_bars(spark, silver2, "1m").collect())
    assert same == sorted((r.symbol, r.ts, r.o) for r in load_bars(spark, silver, "1m").collect())
    # ... and so does the incremental stream, run twice (idempotent replay)
    silver3 = os.path.join(scratch, "silver3")
    summary3 = os.path.join(scratch, "summary3")
    for _ in range(2):
        q = stream_merge(spark, bronze, silver3, checkpoint=os.path.join(scratch, "ck"),
                         summary_root=summary3)
        q.awaitTermination(120)
    s3 = sorted((r.symbol, r.ts, r.o) for r in load_bars(spark, silver3, "1m").collect())
    assert s3 == same
    from barkeep.plans.ingest import check_archive
    kept = check_archive(spark, silver3, as_of="2026-08-19", intervals=("1m",), summary_root=summary3)
    full = check_archive(spark, silver3, as_of="2026-08-19", intervals=("1m",))
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, full.collect()))


def test_quarantine(spark):
    df = _bronze_df(spark, [("A", "1m", "2026-08-18", "{not json"), ("B", "1m", "2026-08-18", ""),
                            ("C", "1m", "2026-08-18", _payload("2026-08-18", ["10:00"], 1))])
    got = sorted((r.symbol, r.reason) for r in bronze_quarantine(df).collect())
    assert got == [("A", "not a chart payload"), ("B", "empty")]


def test_action_store_save(spark, scratch):
    store = os.path.join(scratch, "store")
    assert read_actions(spark, store).count() == 0
    a = spark.createDataFrame([("TCS", dt.date(2026, 1, 5), "split", 0.2, "s")], ACTION)
    assert save_actions(spark, a, store) == (1, 1)
    b = spark.createDataFrame([("TCS", dt.date(2026, 1, 5), "split", 0.5, "t"),
                               ("INFY", dt.date(2026, 1, 6), "bonus", 0.5, "b")], ACTION)
    assert save_actions(spark, b, store) == (2, 1)
    assert sorted(r.factor for r in read_actions(spark, store).collect()) == [0.5, 0.5]


def test_listed_symbols(spark):
    old = spark.createDataFrame([("TCS ", " EQ"), ("INFY", "BE"), ("TCS", "EQ"), (" ", "EQ")],
                                "SYMBOL string, ` SERIES` string")
    new = spark.createDataFrame([("TCS", "EQ"), ("SBIN", "EQ")], "SYMBOL string, SERIES string")
    assert [r.symbol for r in listed_symbols(old).collect()] == ["TCS"]
    assert sorted(r.symbol for r in listed_symbols(old, ("EQ", "BE")).collect()) == ["INFY", "TCS"]
    assert sorted(r.symbol for r in listed_symbols(new, ()).collect()) == ["SBIN", "TCS"]
    assert [r.symbol for r in listed_symbols(new, limit=1).collect()] == ["SBIN"]


def test_publish_gate(spark, make_bars, scratch):
    src = os.path.join(scratch, "silver")
    dest = os.path.join(scratch, "replica")
    rows = [(s, "2026-08-18", "15:%02d" % m, 1, 1, 1, 1, 1) for s in ("A", "B") for m in (0, 1)]
    write_silver(make_bars(rows), src, "1m")
    with pytest.raises(ChecksFailed):
        publish_if_passed(spark, src, dest, as_of="2026-08-19")     # no 5m partitions yet
    write_silver(make_bars([(s, "2026-08-18", "15:00", 1, 1, 1, 1, 1) for s in ("A", "B")]), src, "5m")
    with pytest.raises(ChecksFailed):
        publish_if_passed(spark, src, dest, as_of="2026-08-30")     # stale: nothing copied
    assert not os.path.exists(dest)
    res = publish_if_passed(spark, src, dest, as_of="2026-08-19")
    assert all(r.ok for r in res.collect()) and res.count() == 16
    assert load_bars(spark, dest, "1m").count() == 4
    assert load_bars(spark, dest, "5m").count() == 0                  # only 1m is published


def test_missing_archive_reads_empty(spark, scratch):
    assert load_bars(spark, os.path.join(scratch, "nothing-yet"), "1m").count() == 0


def test_unparseable_partition_dir_is_skipped(spark, make_bars, scratch):
    import shutil
    root = os.path.join(scratch, "silver")
    write_silver(make_bars([("A", "2026-08-18", "10:00", 1, 1, 1, 1, 1)]), root, "1m")
    base = os.path.join(root, "interval=1m")
    shutil.copytree(os.path.join(base, "date=2026-08-18"), os.path.join(base, "date=junk"))
    df = load_bars(spark, root, "1m")
    assert df.count() == 1
    assert available(spark, root, "1m") == [dt.date(2026, 8, 18)]
    assert available(spark, root, "5m") == []
    assert [r.date for r in sessions(df).collect()] == [dt.date(2026, 8, 18)]


def test_reland_same_key_and_partial_rebuild(spark, scratch):
    import datetime as _dt
    bronze = os.path.join(scratch, "bronze")
    silver = os.path.join(scratch, "silver")

    def landed(sym, fetched, base, at):
        return spark.createDataFrame(
            [(sym, "1m", _dt.date.fromisoformat(fetched), _dt.datetime.fromisoformat(at),
              _payload("2026-08-18", ["10:00"], base))],
            "symbol string, interval string, fetched date, landed_at timestamp, payload string")

    land_bronze(landed("tcs", "2026-08-18", 10, "2026-08-18 12:00:00"), bronze)
    # the same key landed again later the same day: it replaces the first
    land_bronze(landed("tcs", "2026-08-18", 20, "2026-08-18 18:00:00"), bronze)
    # and a later fetch of the same session
    land_bronze(landed("tcs", "2026-08-19", 30, "2026-08-19 18:00:00"), bronze)
    rebuild_silver(spark, bronze, silver, "1m")                 # everything landed
    assert [r.o for r in load_bars(spark, silver, "1m").collect()] == [30.0]
    # partial rebuild from the older fetch date: every later fetch is read too
    silver2 = os.path.join(scratch, "silver2")
    rebuild_silver(spark, bronze, silver2, "1m", fetched_from="2026-08-18")
    assert [r.o for r in load_bars(spark, silver2, "1m").collect()] == [30.0]
    # only the re-landed pair: the later landing wins
    silver3 = os.path.join(scratch, "silver3")
    only18 = read_bronze(spark, bronze, "1m").where(F.col("fetched") == F.lit("2026-08-18").cast("date"))
    merge_into_silver(parse_payload(only18), silver3, "1m")
    assert [r.o for r in load_bars(spark, silver3, "1m").collect()] == [20.0]


def test_large_day_splits_small_day_is_one_file(spark, make_bars, scratch):
    """One code path: adaptive execution sizes the files of a date."""
    root = os.path.join(scratch, "silver")
    big = spark.range(200_000).select(
        F.concat(F.lit("S"), (F.col("id") % 997).cast("string")).alias("symbol"),
        F.col("id").alias("ts"), *[F.rand(i).alias(c) for i, c in enumerate("ohlc")],
        F.col("id").alias("v"), F.lit("2026-08-18").cast("date").alias("date"))
    small = make_bars([("A", "2026-08-19", "10:00", 1, 1, 1, 1, 1)])
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "512k")
    try:
        write_silver(big.repartition(8).unionByName(small), root, "1m")
    finally:
        spark.conf.set(key, before)
    files = lambda d: [f for f in os.listdir(os.path.join(root, "interval=1m", "date=" + d)) if f.endswith(".parquet")]
    assert len(files("2026-08-18")) > 1 and len(files("2026-08-19")) == 1
    for f in files("2026-08-18"):
        t = pq.read_table(os.path.join(root, "interval=1m", "date=2026-08-18", f), columns=["symbol", "ts"]).to_pylist()
        k = [(r["symbol"], r["ts"]) for r in t]
        assert k == sorted(k)


def test_truncated_landed_file_is_named_and_left_out_whole(spark, scratch):
    bronze, silver = os.path.join(scratch, "bronze"), os.path.join(scratch, "silver")
    for day in ("2026-08-18", "2026-08-19"):
        rows = [("S%03d" % i, "1m", day, _payload(day, ["10:00", "10:01"], i)) for i in range(300)]
        land_bronze(_bronze_df(spark, rows), bronze)
    folder = os.path.join(bronze, "interval=1m", "fetched=2026-08-19")
    name = next(f for f in os.listdir(folder) if f.endswith(".json.gz"))
    path = os.path.join(folder, name)
    with open(path, "rb") as f:
        whole = f.read()
    with open(path, "wb") as f:
        f.write(whole[:len(whole) // 2])
    for side in os.listdir(folder):
        if side.endswith(".crc"):
            os.unlink(os.path.join(folder, side))
    with pytest.raises(Exception):
        read_bronze(spark, bronze, "1m").select(F.length("payload")).collect()       # strict reads fail
    done = rebuild_silver(spark, bronze, silver, "1m")
    bad = done.quarantine.collect()
    assert len(bad) == 1 and bad[0].path.endswith(name) and bad[0].fetched == dt.date(2026, 8, 19)
    assert {r.date.isoformat() for r in load_bars(spark, silver, "1m").select("date").distinct().collect()} == {"2026-08-18"}
    assert load_bars(spark, silver, "1m").count() == done.bars == 600
    assert done.responses.read == done.responses.parsed == 300
    from barkeep.sources.bronze import read_quarantine
    silver2 = os.path.join(scratch, "s2")
    stream_merge(spark, bronze, silver2, name="damaged", checkpoint=os.path.join(scratch, "ck-damaged")).awaitTermination(120)
    aside = read_quarantine(spark, os.path.join(silver2, "_quarantine")).collect()
    assert [(r.path, r.reason) for r in aside] == [(bad[0].path, bad[0].reason)]     # the stream sets it aside too
    assert load_bars(spark, silver2, "1m").count() == 600


def test_rebuild_reads_single_files_and_fails_when_nothing_is_read(spark, scratch):
    import gzip
    bronze = os.path.join(scratch, "bronze")
    folder = os.path.join(bronze, "interval=1m", "fetched=2026-08-18")
    os.makedirs(folder)
    for sym in ("TCS", "PARTY", "part"):          # names that look like bulk files
        with gzip.open(os.path.join(folder, sym + ".json.gz"), "wt") as f:
            f.write(_payload("2026-08-18", ["10:00"], 10))
    with open(os.path.join(folder, "BAD.json.gz"), "wb") as f:
        f.write(gzip.compress(b"x" * 500)[:12])
    done = rebuild_silver(spark, bronze, os.path.join(scratch, "silver"), "1m")
    assert (done.days, done.bars) == (1, 3)
    assert [r.path.rsplit("/", 1)[1] for r in done.quarantine.collect()] == ["BAD.json.gz"]


def test_stream_and_ingest_name_what_they_cannot_parse(spark, scratch):
    import gzip
    from barkeep.sources.bronze import read_quarantine
    bronze, silver = os.path.join(scratch, "bronze"), os.path.join(scratch, "silver")
    ingest(spark, _bronze_df(spark, [("tcs", "1m", "2026-08-18", _payload("2026-08-18", ["10:00"], 10)),
                                     ("bad", "1m", "2026-08-18", "{not json")]), bronze, silver)
    folder = os.path.join(bronze, "interval=1m", "fetched=2026-08-18")
    for sym, text in (("infy", _payload("2026-08-18", ["10:00"], 20)), ("party", "<html>")):
        with gzip.open(os.path.join(folder, sym + ".json.gz"), "wt") as f:
            f.write(text)
    named = read_quarantine(spark, os.path.join(silver, "_quarantine")).collect()
    assert [(r.symbol, r.interval, r.fetched, r.reason) for r in named] == [
        ("bad", "1m", dt.date(2026, 8, 18), "not a chart payload")] and "/part-" in named[0].path
    silver2 = os.path.join(scratch, "silver2")
    for ck in ("a", "b"):                         # a replay names nothing twice
        stream_merge(spark, bronze, silver2, name="both" + ck, checkpoint=os.path.join(scratch, ck)).awaitTermination(120)
    assert sorted((r.symbol, r.o) for r in load_bars(spark, silver2, "1m").collect()) == [("INFY", 20.0), ("TCS", 10.0)]
    named = read_quarantine(spark, os.path.join(silver2, "_quarantine")).collect()
    assert sorted((r.symbol, r.path.rsplit("/", 1)[1][:5]) for r in named) == [("bad", "part-"), ("party", "party")]


def test_newest_fetch_wins_in_every_order(spark, make_bars, scratch):
    import itertools
    base = make_bars([("A", "2026-08-18", "10:00", 1, 1, 1, 1, 5), ("B", "2026-08-18", "10:00", 1, 1, 1, 1, 5)])
    def fetch(day, price, at="12:00:00"):
        return base.select("symbol", "ts", *[F.lit(float(price)).alias(c) for c in "ohlc"], "v", "date",
                           F.lit(day).cast("date").alias("fetched"),
                           F.lit("%s %s" % (day, at)).cast("timestamp").alias("landed_at"))
    batches = [fetch("2026-08-18", 10), fetch("2026-08-19", 20), fetch("2026-08-19", 30, "18:00:00")]
    for i, order in enumerate(itertools.permutations(batches)):
        root = os.path.join(scratch, "silver%d" % i)
        for b in order:
            merge_into_silver(b, root, "1m")
        assert {(r.symbol, r.o) for r in load_bars(spark, root, "1m").collect()} == {("A", 30.0), ("B", 30.0)}
        assert "fetched" not in load_bars(spark, root, "1m").columns


def test_stream_answer_does_not_depend_on_batching(spark, scratch):
    bronze = os.path.join(scratch, "bronze")
    for i, (fetched, base) in enumerate((("2026-08-20", 30), ("2026-08-18", 10), ("2026-08-19", 20))):
        for iv in ("1m", "15m"):                  # any interval, not only the two stored ones
            land_bronze(_bronze_df(spark, [("tcs", iv, fetched, _payload("2026-08-18", ["10:00"], base))]), bronze)
    got = []
    for n in (1, None):
        silver = os.path.join(scratch, "silver%s" % n)
        stream_merge(spark, bronze, silver, name="by%s" % n, checkpoint=os.path.join(scratch, "ck%s" % n),
                     max_files_per_trigger=n).awaitTermination(180)
        got.append({iv: [r.o for r in load_bars(spark, silver, iv).collect()] for iv in ("1m", "15m")})
    assert got[0] == got[1] == {"1m": [30.0], "15m": [30.0]}


def test_gates_never_trust_a_stale_or_partial_summary(spark, make_bars, scratch):
    from barkeep.sources.silver import refresh_check_summary
    silver, summary, dest = (os.path.join(scratch, n) for n in ("silver", "summary", "dest"))
    rows = [(s, d, "15:%02d" % m, 1, 1, 1, 1, 1) for s in ("A", "B") for d in ("2026-08-17", "2026-08-18") for m in (0, 1)]
    for iv in ("1m", "5m"):
        write_silver(make_bars(rows), silver, iv)
    refresh_check_summary(spark, silver, summary, "1m", [dt.date(2026, 8, 17)])      # partial
    res = publish_if_passed(spark, silver, dest, as_of="2026-08-19", summary_root=summary)
    assert all(r.ok for r in res.collect()) and load_bars(spark, dest, "1m").count() == 8
    stamp = lambda d: sorted(os.listdir(os.path.join(dest, "interval=1m", "date=" + d)))
    before = stamp("2026-08-17"), stamp("2026-08-18")
    write_silver(make_bars([("A", "2026-08-18", "15:00", 2, 2, 2, 2, 1), ("B", "2026-08-18", "15:00", 2, 2, 2, 2, 1)]), silver, "1m")
    publish_if_passed(spark, silver, dest, as_of="2026-08-19", summary_root=summary)
    after = stamp("2026-08-17"), stamp("2026-08-18")
    assert before[0] == after[0] and before[1] != after[1]                           # changed dates only
    assert load_bars(spark, dest, "1m").count() == 6
    write_silver(make_bars([("A", "2026-08-18", "15:00", -2, 2, -2, 2, 1), ("B", "2026-08-18", "15:00", 2, 2, 2, 2, 1)]), silver, "1m")
    with pytest.raises(ChecksFailed):                                                # stale
        publish_if_passed(spark, silver, dest, as_of="2026-08-19", summary_root=summary)


def test_rebuild_leaves_no_stale_summary(spark, scratch):
    from barkeep.plans.ingest import check_archive
    bronze, silver, summary = (os.path.join(scratch, n) for n in ("bronze", "silver", "summary"))
    land_bronze(_bronze_df(spark, [("tcs", "1m", "2026-08-18", _payload("2026-08-18", ["15:00"], 10))]), bronze)
    rebuild_silver(spark, bronze, silver, "1m", summary_root=summary)
    land_bronze(_bronze_df(spark, [("tcs", "1m", "2026-08-19", _payload("2026-08-18", ["15:00"], -10))]), bronze)
    rebuild_silver(spark, bronze, silver, "1m")                                      # without the summary
    got = {r.check: r.ok for r in check_archive(spark, silver, intervals=("1m",), summary_root=summary).collect()}
    assert got["prices positive"] is False


def _typed_rows():
    """(symbol, interval, fetched, payload, reasons, bars kept) of responses
    with wrong values, missing keys or no content."""
    day = "2026-08-18"
    t = [epoch(day, x) for x in ("10:00", "10:01", "10:02")]

    def body(events=None, **other):
        quote = {n: [1.0, 2.0, 3.0] for n in ("open", "high", "low", "close", "volume")}
        quote.update({k: v for k, v in other.items() if k in quote})
        node = {"timestamp": other.get("timestamp", t), "indicators": {"quote": [quote]}}
        if events is not None:
            node["events"] = events
        return json.dumps({"chart": {"result": [node]}})

    split = {"date": t[0], "numerator": 5, "denominator": 1}
    return [
        ("TEXT", "1m", day, body(open=["x", 2.0, 3.0]), ["open[0] is string"], 2),
        ("DIGITS", "1m", day, body(high=["9", 9, 9], low=[0, 0, 0]), ["high[0] is string"], 2),
        ("FRACTION", "1m", day, body(timestamp=[t[0] + 0.5, t[1], t[2]]), ["timestamp[0] is decimal"], 3),
        ("WHOLE", "1m", day, body(timestamp=[float(x) for x in t]), [], 3),
        ("SCALAR", "1m", day, body(low=5), ["low is no array but bigint"], 0),
        ("NESTED", "1m", day, body(close=[[1], {"a": 1}, 3.0]), ["close[0] is array", "close[1] is object"], 1),
        ("VOLUME", "1m", day, body(volume=["7", True, None]), ["volume[1] is boolean"], 2),
        ("FAR", "1m", day, body(timestamp=[10 ** 18, t[1], 10 ** 30]), ["timestamp[0] is bigint", "timestamp[2] is decimal"], 1),
        ("NULLS", "1m", day, body(open=[None, 2.0, 3.0], timestamp=[t[0], None, t[2]]), [], 1),
        ("NORESULT", "1m", day, json.dumps({"chart": {"result": None, "error": "x"}}), ["no result"], 0),
        ("NONE", "1m", day, json.dumps({"chart": {"result": []}}), ["no result"], 0),
        ("CHART", "1m", day, json.dumps({"chart": 5}), ["not a chart payload"], 0),
        ("BROKEN", "1m", day, body()[:40], ["not a chart payload"], 0),
        ("BLANK", "1m", day, "  ", ["empty"], 0),
        (None, "1m", day, body(), ["no symbol"], 0),
        ("NOGRAIN", None, day, body(), ["no interval"], 0),
        ("ODD", "1h", day, body(), ["unknown interval"], 0),
        ("NODATE", "1m", None, body(), ["no fetch date"], 0),
        ("EVENT", "1m", day, body(open=["x", 2.0, 3.0], events={"splits": {"a": split}}), ["open[0] is string"], 2),
        ("ODDEVENT", "1m", day, body(events={"splits": {"a": {**split, "numerator": "abc"}}}), ["unreadable event"], 3),
        ("LIST", "1m", day, body(events=[1]), ["events is no object"], 3),
        ("GOOD", "1m", day, body(), [], 3)]


def _typed(spark, rows):
    return spark.createDataFrame([(s, iv, f and dt.date.fromisoformat(f), p) for s, iv, f, p, *_ in rows],
                                 "symbol string, interval string, fetched date, payload string")


def test_wrong_values_are_named_and_cost_their_own_bar_only(spark):
    from barkeep.operators.parse import parse_events
    rows = _typed_rows()
    b = _typed(spark, rows)
    named, kept = {}, {}
    for r in bronze_quarantine(b).collect():
        named.setdefault(r.symbol, []).append(r.reason)
    for r in parse_payload(b).collect():
        kept[r.symbol] = kept.get(r.symbol, 0) + 1
    assert {s: sorted(v) for s, v in named.items()} == {r[0]: sorted(r[4]) for r in rows if r[4]}
    assert kept == {r[0]: r[5] for r in rows if r[5]}
    assert [(r.symbol, r.factor) for r in parse_events(b).collect()] == [("EVENT", 0.2)]
    first = parse_payload(b).where("symbol = 'FRACTION'").orderBy("ts").first()
    assert first.ts == epoch("2026-08-18", "10:00")


@pytest.mark.parametrize("rows", [_typed_rows(), [r for r in _typed_rows() if r[0] == "NOGRAIN"]])
def test_ingest_rebuild_and_stream_account_for_every_response(spark, scratch, rows):
    from barkeep.sources.bronze import read_quarantine
    bronze, silver = os.path.join(scratch, "bronze"), os.path.join(scratch, "silver")
    want = sorted((str(r[0]), str(r[1]), str(r[2]), x) for r in rows for x in r[4])
    bars = sum(r[5] for r in rows)
    names = lambda df: sorted((str(r.symbol), str(r.interval), str(r.fetched), r.reason) for r in df.collect())

    done = ingest(spark, _typed(spark, rows), bronze, silver, os.path.join(scratch, "actions"))
    t = done["responses"]
    assert t.read == len(rows) == t.parsed + t.empty + t.quarantined
    assert t.empty == sum(r[4] in (["no result"], ["empty"]) for r in rows)
    assert names(read_quarantine(spark, os.path.join(silver, "_quarantine"))) == want
    assert load_bars(spark, silver, "1m").count() == bars
    again = os.path.join(scratch, "again")
    stream_merge(spark, bronze, again, name="typed%d" % len(rows), checkpoint=os.path.join(scratch, "ck")).awaitTermination(180)
    assert names(read_quarantine(spark, os.path.join(again, "_quarantine"))) == want
    assert load_bars(spark, again, "1m").count() == bars
    assert not os.path.exists(os.path.join(again, "interval=None"))
    rebuilt = rebuild_silver(spark, bronze, os.path.join(scratch, "rebuilt"), "1m")
    assert rebuilt.bars == bars and names(rebuilt.quarantine) == [w for w in want if w[1] == "1m"]
    assert rebuilt.responses.read == sum(r[1] == "1m" for r in rows)


def test_fewer_responses_read_than_landed_is_an_error(spark, scratch, monkeypatch):
    from barkeep.plans import ingest as I
    rows = [r for r in _typed_rows() if r[0] in ("GOOD", "TEXT")]
    monkeypatch.setattr(I, "read_bronze", lambda *a: read_bronze(*a).where("symbol = 'GOOD'"))
    with pytest.raises(RuntimeError, match="2 responses were landed, 1 read back"):
        ingest(spark, _typed(spark, rows), os.path.join(scratch, "bronze"), os.path.join(scratch, "silver"))
    assert not os.path.exists(os.path.join(scratch, "silver", "interval=1m"))


def test_inflating_is_whole_linear_and_strict():
    import gzip
    import time
    import zlib

    from barkeep.sources.bronze import inflated
    text = b"".join(b"%d," % (i * i) for i in range(200_000))
    whole = gzip.compress(text)
    assert b"".join(inflated(whole)) == text
    assert b"".join(inflated(whole + gzip.compress(b"more"), slice_bytes=7, piece=5)) == text + b"more"
    assert b"".join(inflated(memoryview(gzip.compress(b"")))) == b""
    for bad in (b"", whole[:-1], whole[:len(whole) // 2], b"x" + whole, whole + b"tail", whole[:200] + b"\0\0" + whole[202:]):
        with pytest.raises((EOFError, zlib.error)):
            for _ in inflated(bad):
                pass
    took = []
    for n in (8, 32):
        big = gzip.compress(os.urandom(n << 20), 1)
        start = time.perf_counter()
        assert sum(map(len, inflated(big))) == n << 20
        took.append(time.perf_counter() - start)
    assert took[1] < 12 * took[0]                 # four times the bytes; quadratic would be sixteen times


def test_single_file_landing_replaces_and_refuses_keyless_rows(spark, scratch):
    from barkeep.sources.bronze import land_responses, read_bronze_files
    root = os.path.join(scratch, "bronze")
    day = "2026-08-18"
    assert land_responses(_bronze_df(spark, [("tcs", "1m", day, _payload(day, ["10:00"], 1)), ("m&m", "1m", day, _payload(day, ["10:00"], 2))]), root) == 2
    assert land_responses(_bronze_df(spark, [("tcs", "1m", day, _payload(day, ["10:00"], 3))]), root) == 1
    assert sorted(f for f in os.listdir(os.path.join(root, "interval=1m", "fetched=" + day)) if not f.startswith(".")) == ["M&M.json.gz", "TCS.json.gz"]
    assert sorted((r.symbol, r.o) for r in parse_payload(read_bronze_files(spark, root)).collect()) == [("M&M", 2.0), ("TCS", 3.0)]
    for bad in ([(None, "1m", day, "{}")], [("a", "1m", day, "{}"), ("A", "1m", day, "{}")]):
        with pytest.raises(ValueError, match="per symbol"):
            land_responses(_bronze_df(spark, bad), root)


# --- S15 / C4: one snapshot ---------------------------------------------------

def _gated(spark, make_bars, scratch):
    silver, dest = os.path.join(scratch, "silver"), os.path.join(scratch, "dest")
    rows = [(s, d, "15:%02d" % m, 1, 1, 1, 1, 1) for s in ("A", "B") for d in ("2026-08-17", "2026-08-18") for m in (0, 1)]
    for iv in ("1m", "5m"):
        write_silver(make_bars(rows), silver, iv)
    return silver, dest, rows


def test_publishing_into_a_destination_without_a_record(spark, make_bars, scratch):
    silver, dest, rows = _gated(spark, make_bars, scratch)
    write_silver(make_bars([("OLD", "2026-08-10", "10:00", 1, 1, 1, 1, 1), ("OLD", "2026-08-17", "10:00", 1, 1, 1, 1, 1)]), dest, "1m")
    publish_if_passed(spark, silver, dest, as_of="2026-08-19")
    got = sorted((r.symbol, r.date.isoformat()) for r in load_bars(spark, dest, "1m").collect())
    assert got == sorted([("OLD", "2026-08-10")] + [(r[0], r[1]) for r in rows])


def test_a_rewrite_between_gate_and_copy_is_refused(spark, make_bars, scratch, monkeypatch):
    from barkeep.plans import ingest as I
    silver, dest, rows = _gated(spark, make_bars, scratch)
    bad = make_bars([("A", "2026-08-18", "15:00", -1, 1, -1, 1, 1), ("B", "2026-08-18", "15:00", 1, 1, 1, 1, 1)])
    real, calls = I.assert_passed, []

    def passed_then_rewritten(results):
        real(results)
        if not calls:
            calls.append(1)
            write_silver(bad, silver, "1m")

    monkeypatch.setattr(I, "assert_passed", passed_then_rewritten)
    with pytest.raises(ChecksFailed):             # the second attempt gates what is there now
        publish_if_passed(spark, silver, dest, as_of="2026-08-19")
    assert load_bars(spark, dest, "1m").count() == 0


def test_a_rewrite_during_the_gates_is_gated_again(spark, make_bars, scratch, monkeypatch):
    from barkeep.plans import ingest as I
    silver, dest, rows = _gated(spark, make_bars, scratch)
    real, runs = I.check_archive, []

    def checked(*a, **k):
        out = real(*a, **k)
        runs.append(1)
        if len(runs) < keep_on:
            out = spark.createDataFrame(out.collect(), out.schema)
            write_silver(make_bars([(s, "2026-08-18", "15:00", 2, 2, 2, 2, len(runs)) for s in ("A", "B")]), silver, "1m")
        return out

    monkeypatch.setattr(I, "check_archive", checked)
    keep_on = 3
    publish_if_passed(spark, silver, dest, as_of="2026-08-19")
    assert len(runs) == 3 and sorted(r.v for r in load_bars(spark, dest, "1m").where("date = '2026-08-18'").collect()) == [2, 2]
    runs, keep_on = [], 9
    with pytest.raises(I.ArchiveChanged):
        publish_if_passed(spark, silver, os.path.join(scratch, "dest2"), as_of="2026-08-19")
    assert len(runs) == 3


# --- S10 / G2: compare and swap -------------------------------------------------

def _action(sym, day, factor=0.5):
    return (sym, dt.date(2026, 1, day), "split", factor, sym)


def test_interleaved_saves_keep_both_additions(spark, scratch, monkeypatch):
    from barkeep.sources import actions as S
    store = os.path.join(scratch, "store")
    make = lambda *rows: spark.createDataFrame(list(rows), ACTION)
    save_actions(spark, make(_action("OLD", 1)), store)
    real, first = S._claim, []

    def late(spark_, store_, n, data):
        if not first:                              # while the outer save holds its merge, another one commits
            first.append(n)
            assert save_actions(spark, make(_action("INNER", 2), _action("BOTH", 3, 0.25)), store) == (3, 2)
        return real(spark_, store_, n, data)

    monkeypatch.setattr(S, "_claim", late)
    assert save_actions(spark, make(_action("OUTER", 4), _action("BOTH", 3, 0.75)), store) == (4, 1)
    assert sorted((r.symbol, r.factor) for r in read_actions(spark, store).collect()) == [
        ("BOTH", 0.75), ("INNER", 0.5), ("OLD", 0.5), ("OUTER", 0.5)]
    assert len([n for n in os.listdir(store) if n.startswith("data-")]) == 3       # the loser's merge is gone


def test_threads_saving_at_once_lose_nothing(spark, scratch):
    from concurrent.futures import ThreadPoolExecutor
    store = os.path.join(scratch, "store")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda i: save_actions(spark, spark.createDataFrame([_action("S%d" % i, i)], ACTION), store), range(1, 7)))
    assert sorted(r.symbol for r in read_actions(spark, store).collect()) == ["S%d" % i for i in range(1, 7)]


def test_old_versions_go_and_cut_off_claims_are_passed_over(spark, scratch, monkeypatch):
    from barkeep.sources import actions as S
    store = os.path.join(scratch, "store")
    for i in range(1, 7):
        save_actions(spark, spark.createDataFrame([_action("S%d" % i, i)], ACTION), store)
    names = os.listdir(store)
    assert sorted(n for n in names if n.startswith("version-")) == ["version-%012d" % n for n in (4, 5, 6)]
    assert len([n for n in names if n.startswith("data-")]) == 3
    open(os.path.join(store, "version-%012d" % 7), "w").close()                    # a writer died here
    monkeypatch.setattr(S, "GIVEN_UP", -1)
    assert read_actions(spark, store).count() == 6
    assert save_actions(spark, spark.createDataFrame([_action("S7", 7)], ACTION), store) == (7, 1)
    assert S._claims(spark, store)[0] == 8


def test_two_reads_share_no_setting(spark, make_bars, scratch):
    root = os.path.join(scratch, "silver")
    write_silver(make_bars([("A", "2026-08-18", "10:00", 1, 1, 1, 1, 1)]), root, "1m")
    key = "spark.sql.sources.validatePartitionColumns"
    before = spark.conf.get(key)
    from barkeep.sources import silver as S
    import inspect
    assert key not in inspect.getsource(S.read_silver) and load_bars(spark, root, "1m").count() == 1
    assert spark.conf.get(key) == before
