"""Benchmark: the archive's access patterns on a silver archive built from
the driver's tables, on local[$BENCH_CPUS], printing ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py
    BENCH_EVENT_LOG=/tmp/some-dir ...   also write Spark's event log there

Startup and a warm-up of the session (a small write and read of unrelated
rows) are reported apart. Stages that read are run three times: `queries`
has the median, `cold_sec` the first run. Stages that write run once.
`reference_set_sec` sums the medians of scan + point + resample, the
reference's own three queries, and `reference_set_cold_sec` their first runs:
    build_silver   events -> 1m and 5m bars (event types + one symbol per
                   user) -> date-partitioned, symbol-sorted zstd parquet;
                   the weekly action feed -> the action store
    scan           every symbol over 5m: count, mean volume (SQL, as the
                   reference's benchmark)
    point          one symbol, one day over 5m (partition + row-group pruned)
    resample       one symbol's 1m bars into 5-minute clock buckets
    board_7d       7-session boards for every symbol (fallback, adjust, fold)
    board_20d      20-session boards for every symbol from 5m
    checks         all eight gates over the 1m archive, one scan
    merge          merge a re-fetched day into the archive (newest wins)
    summary_build  the gates' per-(symbol, date) summary for every date, kept
    checks_kept    all eight gates from the kept summary (no bar read)
    land_bronze    land every symbol-day payload of both grains (gzip JSON)
    rebuild_silver re-parse bronze into a fresh silver archive, both grains
    csv_load       bulk-load the headerless CSV spool into silver
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))


def _sf_label(path: str) -> str:
    b = os.path.basename(path.rstrip("/"))
    return b[2:] if b.startswith("sf") else b


def main() -> None:
    t0 = time.perf_counter()
    from barkeep.session import build_session, scratch_path
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):       # stage / task times, read offline
        extra = {"spark.eventLog.enabled": "true",
                 "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = build_session("local[%d]" % CPUS, app="barkeep-bench",
                          shuffle_partitions=max(8, CPUS * 2), extra=extra)
    startup = time.perf_counter() - t0

    from pyspark.sql import functions as F

    from barkeep.operators.checks import run_checks
    from barkeep.operators.actions import normalise_actions
    from barkeep.plans.board import board, board_of_archive
    from barkeep.sources import driver as D
    from barkeep.plans.ingest import check_archive, rebuild_archive
    from barkeep.sources.actions import read_actions, save_actions
    from barkeep.sources.bronze import land_bronze
    from barkeep.sources.silver import (archive_counts, available, load_bars, merge_into_silver, read_bars_csv,
                                        refresh_check_summary, register_views, write_silver)

    root = scratch_path(spark, "bench-silver")
    times: dict[str, float] = {}
    cold: dict[str, float] = {}

    def timed(name, fn, repeats=1):
        spark.sparkContext.setJobDescription(name)      # names the stages in the event log
        runs = []
        for _ in range(repeats):
            s = time.perf_counter()
            out = fn()
            runs.append(time.perf_counter() - s)
        cold[name], times[name] = round(runs[0], 3), round(median(runs), 3)
        spark.sparkContext.setJobDescription(None)
        return out

    s0 = time.perf_counter()
    warm = scratch_path(spark, "bench-warm-up")
    spark.range(100_000).selectExpr("id % 97 AS k", "id AS v").groupBy("k").sum("v").write.parquet(warm)
    spark.read.parquet(warm).orderBy("k").count()
    warm_up = time.perf_counter() - s0

    store_root = scratch_path(spark, "bench-actions")

    def build():
        for iv in ("1m", "5m"):
            b = D.bars(spark, SF_DIR, iv).unionByName(D.bars(spark, SF_DIR, iv, key="user_id"))
            write_silver(b, root, iv)
        # the action store, as a reader finds it: a small parquet table
        save_actions(spark, normalise_actions(D.weekly_feed(spark, SF_DIR)), store_root)
    timed("build_silver", build)

    register_views(spark, root)
    b1 = load_bars(spark, root, "1m")
    b5 = load_bars(spark, root, "5m")
    # the probe, chosen from the data (deterministically), as the reference does
    probe = b5.select("symbol", "date").orderBy("symbol", "date").first()
    sym, day = probe["symbol"], probe["date"].isoformat()
    # the busiest symbol for resample
    busy = "VIEW"

    q = {
        "scan": "SELECT symbol, count(*) AS bars, avg(v) AS avg_vol FROM bars5 "
                "GROUP BY symbol ORDER BY bars DESC",
        "point": "SELECT count(*), min(l), max(h) FROM bars5 "
                 "WHERE symbol = '%s' AND date = DATE '%s'" % (sym, day),
        "resample": "SELECT symbol, ts - (ts %% 300) AS bucket, min(l) AS lo, max(h) AS hi, "
                    "sum(v) AS vol FROM bars1 WHERE symbol = '%s' GROUP BY 1, 2" % busy,
    }
    rows = {}
    for name, sql in q.items():
        rows[name] = timed(name, lambda sql=sql: len(spark.sql(sql).collect()), 3)

    store = read_actions(spark, store_root)
    # a board's end date from the directory listing (no scan), as a reader
    # that owns the archive root does
    rows["board_7d"] = timed("board_7d", lambda: board(
        b1, b5, store, 7, upto=max(available(spark, root, "1m")[-1], available(spark, root, "5m")[-1])).count(), 3)
    rows["board_20d"] = timed("board_20d", lambda: board(
        b1, b5, store, 20, upto=available(spark, root, "5m")[-1]).count(), 3)
    rows["checks"] = timed("checks", lambda: len(run_checks(b1, "1m", as_of="2024-02-04").collect()), 3)

    def merge():
        # the newest day re-fetched at six with revised closes
        newest = b1.agg(F.max("date")).first()[0]
        batch = b1.where(F.col("date") == F.lit(newest)).withColumn("c", F.col("c") + 0.01) \
                  .withColumn("fetched", F.date_add("date", 1))
        return merge_into_silver(batch, root, "1m")
    rows["merge"] = timed("merge", merge)

    # the gates from a kept per-(symbol, date) summary: built once for every
    # date, then verdicts read only the summary (what a nightly run pays
    # after a merge has refreshed the dates it touched)
    summary = scratch_path(spark, "bench-summary")
    timed("summary_build", lambda: refresh_check_summary(
        spark, root, summary, "1m", available(spark, root, "1m")))
    rows["checks_kept"] = timed("checks_kept", lambda: len(check_archive(
        spark, root, as_of="2024-02-04", intervals=("1m",), summary_root=summary).collect()), 3)

    # boards from the archive with the kept day table
    rows["board_7d_kept"] = timed("board_7d_kept", lambda: board_of_archive(spark, root, summary, store, 7).count(), 3)
    rows["archive_counts"] = timed("archive_counts", lambda: archive_counts(spark, root).count(), 3)

    # write paths, as the reference's load numbers: land the upstream
    # payloads (every symbol-day, both grains), rebuild silver from bronze
    # (re-parse, no re-fetch), and bulk-load the headerless CSV spool
    bronze = scratch_path(spark, "bench-bronze")
    pay = D.payloads(spark, SF_DIR, "1m").unionByName(D.payloads(spark, SF_DIR, "5m"))
    timed("land_bronze", lambda: land_bronze(pay, bronze))
    rebuilt = scratch_path(spark, "bench-rebuilt")
    rb = timed("rebuild_silver", lambda: rebuild_archive(spark, bronze, rebuilt))
    rows["rebuild_silver"] = {iv: [v.days, v.bars] for iv, v in rb.items()}
    spool = scratch_path(spark, "bench-spool")
    fresh = load_bars(spark, root, "1m")            # re-listed: the merge rewrote a day
    fresh.select("symbol", "ts", "o", "h", "l", "c", "v", "date").write.csv(spool)   # setup, untimed
    csv_root = scratch_path(spark, "bench-csv")
    timed("csv_load", lambda: write_silver(read_bars_csv(spark, spool), csv_root, "1m"))
    n_csv = load_bars(spark, csv_root, "1m").count()
    rows["csv_load"] = n_csv
    rates = {"rebuild_rows_per_sec": round(sum(v.bars for v in rb.values()) / times["rebuild_silver"]),
             "csv_load_rows_per_sec": round(n_csv / times["csv_load"])}

    total = round(sum(v for k, v in times.items()), 3)
    out = {
        "metric": "total_query_sec",
        "value": total,
        "unit": "sec",
        "queries": times,
        "startup_sec": round(startup, 3),
        "reference_set_sec": round(sum(times[k] for k in q), 3),
        "reference_set_cold_sec": round(sum(cold[k] for k in q), 3),
        "cold_sec": cold,
        "warm_up_sec": round(warm_up, 3),
        "load_rates": rates,
        "sf": _sf_label(SF_DIR),
        "cpus": CPUS,
        "rows": {k: (list(v) if isinstance(v, tuple) else v) for k, v in rows.items()},
        "archive_bars": {iv: load_bars(spark, root, iv).count() for iv in ("1m", "5m")},
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()
