"""Registered queries of the reading and writing paths: each writes an
archive from the driver's tables under the shared scratch folder, through the
library's own sinks, and returns what is read back."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barkeep.operators import actions as A
from barkeep.operators import checks as K
from barkeep.operators.parse import parse_events, parse_payload
from barkeep.operators.sessions import in_time_order
from barkeep.plans.board import board, board_of_archive
from barkeep.operators.checks import ChecksFailed
from barkeep.plans.ingest import check_archive, ingest, publish_if_passed, rebuild_archive, rebuild_silver
from barkeep.schema import BAR_COLS
from barkeep.session import scratch_path
from barkeep.sources import driver as D
from barkeep.sources.actions import explicit_symbols, read_action_feed, read_actions, save_actions
from barkeep.sources.bronze import QUARANTINE, land_bronze, land_responses, read_bronze, read_bronze_files, read_quarantine
from barkeep.sources.silver import (archive_bytes, archive_counts, archive_table, available, load_bars, merge_into_silver, read_bars_csv,
                                    refresh_check_summary, register_views, session_bars,
                                    table_sessions, write_silver)
from barkeep.streaming.merge_stream import stream_merge

# --- fixed parameters of the registered queries ---
LOAD_SYMBOL = "purchase"          # lower case on purpose: matched upper-cased
LOAD_SINCE, LOAD_UPTO = "2024-01-08", "2024-01-21"
SESSION_DAY = "2024-01-10"
AS_OF = "2024-02-04"
REFETCHED = "2024-01-15"           # a partial rebuild starts here
FINE_SYMBOL, FINE_UPTO = "CLICK", "2024-01-20"  # the only symbol with 1m bars, and until when
# --- end of fixed parameters ---


def _bars(spark, sf, interval):
    return D.bars(spark, sf, interval)


def _archive(spark, sf, *intervals) -> str:
    root = scratch_path(spark, "silver")
    for iv in intervals:
        write_silver(_bars(spark, sf, iv), root, iv)
    return root


def _landed(spark, payloads) -> str:
    root = scratch_path(spark, "bronze")
    land_bronze(payloads, root)
    return root


def q_load_bars(spark, sf) -> DataFrame:
    """S4, P6-P8 on an archive, in time order (L1)."""
    b = load_bars(spark, _archive(spark, sf, "1m"), "1m", symbol=LOAD_SYMBOL, since=LOAD_SINCE, upto=LOAD_UPTO)
    return in_time_order(b).select("ts", "o", "h", "l", "c", "v")


def q_session_bars(spark, sf) -> DataFrame:
    """S5 on an archive."""
    return session_bars(spark, _archive(spark, sf, "5m"), SESSION_DAY, "5m").select("symbol", "ts", "o", "h", "l", "c", "v")


def q_silver_roundtrip(spark, sf) -> DataFrame:
    """S8 then S4, both grains."""
    root = _archive(spark, sf, "1m", "5m")
    return load_bars(spark, root, "1m").unionByName(load_bars(spark, root, "5m"))


def q_csv_spool(spark, sf) -> DataFrame:
    """The headerless spool, written and read."""
    path = scratch_path(spark, "spool")
    _bars(spark, sf, "1m").select(*BAR_COLS, "date").write.option("header", "false").csv(path)
    return read_bars_csv(spark, path)


def q_bronze_roundtrip(spark, sf) -> DataFrame:
    """Responses landed, read back and parsed."""
    return parse_payload(read_bronze(spark, _landed(spark, D.payloads(spark, sf))), keep=("interval", "fetched"))


def q_rebuild_silver(spark, sf) -> DataFrame:
    """Silver from bronze alone."""
    silver = scratch_path(spark, "silver")
    rebuild_silver(spark, _landed(spark, D.payloads(spark, sf)), silver, "1m")
    return load_bars(spark, silver, "1m")


def q_rebuild_quarantine(spark, sf) -> DataFrame:
    """What a rebuild sets aside."""
    done = rebuild_silver(spark, _landed(spark, D.damaged_payloads(spark, sf)), scratch_path(spark, "silver"), "1m")
    return done.quarantine.select("symbol", "interval", "fetched", "reason")


def q_stream_merge(spark, sf) -> DataFrame:
    """The stream over both grains, a few files at a time."""
    bronze = _landed(spark, D.payloads(spark, sf, "1m"))
    land_bronze(D.payloads(spark, sf, "5m"), bronze)
    silver = scratch_path(spark, "silver")
    stream_merge(spark, bronze, silver, name="registered", checkpoint=scratch_path(spark, "stream"),
                 max_files_per_trigger=40).awaitTermination()
    return load_bars(spark, silver, "1m").unionByName(load_bars(spark, silver, "5m"))


def _ingested(spark, sf):
    silver, store = scratch_path(spark, "silver"), scratch_path(spark, "actions")
    ingest(spark, D.payloads(spark, sf), scratch_path(spark, "bronze"), silver, store)
    return silver, store


def q_ingest(spark, sf) -> DataFrame:
    """The bars."""
    return load_bars(spark, _ingested(spark, sf)[0], "1m")


def q_ingest_actions(spark, sf) -> DataFrame:
    """The actions."""
    return read_actions(spark, _ingested(spark, sf)[1])


def q_action_store(spark, sf) -> DataFrame:
    """The weekly store, then the feed saved over it."""
    store = scratch_path(spark, "actions")
    save_actions(spark, A.normalise_actions(D.weekly_feed(spark, sf)), store)
    save_actions(spark, A.normalise_actions(D.action_feed(spark, sf)), store)
    return A.in_store_order(read_actions(spark, store))


def q_new_splits(spark, sf) -> DataFrame:
    """Splits among the events of the landed responses."""
    return A.splits(parse_events(D.payloads(spark, sf)))


def q_explicit_symbols(spark, sf) -> DataFrame:
    """5m bars of the symbols a user lists."""
    wanted = explicit_symbols(spark, " click, PURCHASE ,,nosuch")
    return _bars(spark, sf, "5m").join(wanted, "symbol", "left_semi").select(*BAR_COLS)


def q_archive_views(spark, sf) -> DataFrame:
    """SQL over the views."""
    register_views(spark, _archive(spark, sf, "1m", "5m"))
    return spark.sql("SELECT f.symbol, f.date, f.n AS fine, c.n AS coarse FROM "
                     "(SELECT symbol, date, count(*) AS n FROM bars1 GROUP BY symbol, date) f JOIN "
                     "(SELECT symbol, date, count(*) AS n FROM bars5 GROUP BY symbol, date) c USING (symbol, date)")


def q_merge_out_of_order(spark, sf) -> DataFrame:
    """G1 in silver: the newest of three fetches arrives first, the oldest
    last; the newest stays."""
    silver, b = scratch_path(spark, "silver"), _bars(spark, sf, "1m")
    for late, more in ((2, 0.0), (1, 1.0), (0, 2.0)):
        batch = b.select("symbol", "ts", *[(F.col(p) + more).alias(p) for p in "ohlc"], "v", "date",
                         F.date_add("date", late).alias("fetched"))
        merge_into_silver(batch, silver, "1m")
    return load_bars(spark, silver, "1m")


def q_check_kept_summary(spark, sf) -> DataFrame:
    """C2-C4 from a kept summary made before the archive was changed: the
    gates see the change."""
    silver, summary = _archive(spark, sf, "1m", "5m"), scratch_path(spark, "summary")
    for iv in ("1m", "5m"):
        days = [r[0] for r in load_bars(spark, silver, iv).select("date").distinct().collect()]
        refresh_check_summary(spark, silver, summary, iv, days)
    write_silver(D.faulty_bars(_bars(spark, sf, "1m"), "1m"), silver, "1m")
    return check_archive(spark, silver, as_of=AS_OF, summary_root=summary)


def q_board_7d_fallback(spark, sf) -> DataFrame:
    """One symbol has 1m bars, and only up to a date; all others, and
    the newest date, are held at 5m alone."""
    fine = _bars(spark, sf, "1m").where((F.col("symbol") == FINE_SYMBOL) & (F.col("date") <= F.lit(FINE_UPTO).cast("date")))
    return board(fine, _bars(spark, sf, "5m"), A.normalise_actions(D.weekly_feed(spark, sf)), 7)


def _faulty(spark, sf):
    return D.faulty_bars(_bars(spark, sf, "1m"), "1m")


def q_top_oversize(spark, sf) -> DataFrame:
    return K.top_offenders(K.check_oversize(_faulty(spark, sf), "1m"), [F.col("n").desc(), "symbol", "date"])


def q_top_malformed(spark, sf) -> DataFrame:
    return K.top_offenders(K.check_malformed(_faulty(spark, sf)), ["symbol", "ts"])


def q_top_nonpositive(spark, sf) -> DataFrame:
    return K.top_offenders(K.check_nonpositive(_faulty(spark, sf)), ["symbol", "ts"])


def q_top_no_volume(spark, sf) -> DataFrame:
    return K.top_offenders(K.check_no_volume(_faulty(spark, sf)), ["date"])


def q_parse_dirty_payload(spark, sf) -> DataFrame:
    """Nulls, short and missing arrays, prices of three decimals."""
    return parse_payload(D.dirty_payloads(spark, sf)).select(*BAR_COLS, "date")


_NAMED = ["symbol", "interval", "fetched", "reason"]


def _typed(spark, sf) -> str:
    silver = scratch_path(spark, "silver")
    ingest(spark, D.typed_payloads(spark, sf), scratch_path(spark, "bronze"), silver)
    return silver


def q_quarantine_typed(spark, sf) -> DataFrame:
    """Values of the wrong type and missing keys, each named."""
    return read_quarantine(spark, os.path.join(_typed(spark, sf), QUARANTINE)).select(*_NAMED)


def q_ingest_typed(spark, sf) -> DataFrame:
    """What such responses still give, all but the wrong values."""
    return load_bars(spark, _typed(spark, sf), "1m")


def _cut(spark, folder: str) -> None:
    """Cuts the landed files of a folder in half, as a broken transfer would."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for st in fs.globStatus(path(os.path.join(folder, "*.json.gz"))) or []:
        stream = fs.open(st.getPath())
        half = bytearray(stream.readNBytes(st.getLen() // 2))
        stream.close()
        out = fs.create(st.getPath(), True)
        out.write(half)
        out.close()


def _damaged_stream(spark, sf) -> str:
    """Good files, the files of one fetch date cut in half, and one symbol's
    responses without a grain, all streamed."""
    p = D.payloads(spark, sf)
    bronze = _landed(spark, p.where(F.col("symbol") != FINE_SYMBOL))
    _cut(spark, os.path.join(bronze, "interval=1m", "fetched=" + SESSION_DAY))
    land_bronze(p.where(F.col("symbol") == FINE_SYMBOL).withColumn("interval", F.lit(None).cast("string")), bronze)
    silver = scratch_path(spark, "silver")
    stream_merge(spark, bronze, silver, name="damaged-" + os.path.basename(silver), checkpoint=scratch_path(spark, "stream"),
                 max_files_per_trigger=40).awaitTermination()
    return silver


def q_stream_quarantine(spark, sf) -> DataFrame:
    """The dead letters of a stream that went on."""
    named = read_quarantine(spark, os.path.join(_damaged_stream(spark, sf), QUARANTINE))
    return named.select(*_NAMED).distinct()


def q_stream_damaged(spark, sf) -> DataFrame:
    """The bars of the good files among damaged ones."""
    return load_bars(spark, _damaged_stream(spark, sf), "1m")


def q_bronze_single_files(spark, sf) -> DataFrame:
    """One `SYMBOL.json.gz` per response, read back and parsed."""
    root = scratch_path(spark, "bronze")
    land_responses(D.payloads(spark, sf), root)
    return parse_payload(read_bronze_files(spark, root), keep=("interval", "fetched"))


def q_rebuild_partial(spark, sf) -> DataFrame:
    """Bars a dry rebuild would parse and the days it would touch,
    of everything and from a fetch date on; then what the partial one writes."""
    root, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    land_responses(D.payloads(spark, sf), root)
    whole = rebuild_archive(spark, root, silver, ("1m",), dry=True)["1m"]
    part = rebuild_silver(spark, root, silver, "1m", fetched_from=REFETCHED)
    held = load_bars(spark, silver, "1m").agg(F.count("*").alias("bars"), F.count_distinct("date").cast("int").alias("days"))
    dry = spark.createDataFrame([("dry", whole.bars, whole.days, whole.responses.read), ("partial", part.bars, part.days, part.responses.read)],
                                "run string, bars long, days int, responses long")
    return dry.unionByName(held.withColumns({"run": F.lit("held"), "responses": F.lit(None).cast("long")}))


def q_action_feed_files(spark, sf) -> DataFrame:
    """The exchange's JSON array files, read and normalised."""
    path = scratch_path(spark, "feed")
    D.feed_files(spark, sf).write.option("maxRecordsPerFile", 1).text(path)
    return A.normalise_actions(read_action_feed(spark, path))


def q_publish_gate(spark, sf) -> DataFrame:
    """An archive that fails its gates is not published; mended, it
    is, also to a destination that held a date without a record."""
    silver, dest = _archive(spark, sf), scratch_path(spark, "published")
    for iv in ("1m", "5m"):
        write_silver(D.closing_bars(spark, sf, iv), silver, iv)
    days = available(spark, silver, "1m")
    if not days:
        return load_bars(spark, silver, "1m")
    faulty = D.closing_bars(spark, sf, "1m").where(F.col("date") == F.lit(days[-1]))
    write_silver(faulty.withColumn("o", F.lit(-1.0)), silver, "1m")
    write_silver(faulty, dest, "1m")
    try:
        publish_if_passed(spark, silver, dest, as_of=days[-1])
        raise AssertionError("published although a gate failed")
    except ChecksFailed:
        pass
    write_silver(faulty, silver, "1m")
    publish_if_passed(spark, silver, dest, as_of=days[-1])
    return load_bars(spark, dest, "1m")


def q_archive_bytes(spark, sf) -> DataFrame:
    """Files and bytes by listing; every date of a small archive is one
    file of some bytes."""
    root = _archive(spark, sf, "5m")
    found = archive_bytes(spark, os.path.join(root, "interval=5m"))
    return found.select((F.col("bytes") > 0).alias("some_bytes"), (F.col("files") >= len(available(spark, root, "5m"))).alias("file_per_day"),
                        F.lit(len(available(spark, root, "5m"))).cast("long").alias("days"))


def q_board_7d_kept(spark, sf) -> DataFrame:
    """C1 from an archive whose day table is kept."""
    silver = _archive(spark, sf, "1m", "5m")
    return board_of_archive(spark, silver, scratch_path(spark, "summary"), A.normalise_actions(D.weekly_feed(spark, sf)), 7)


def q_archive_counts(spark, sf) -> DataFrame:
    """S14, A13 from Parquet footers."""
    return archive_counts(spark, _archive(spark, sf, "1m", "5m"))


def q_catalog_sessions(spark, sf) -> DataFrame:
    """Dates and bars of a catalogued archive; the second half of the
    dates arrives by a merge that adds its partitions."""
    b, root = _bars(spark, sf, "1m"), scratch_path(spark, "silver")
    early = F.col("date") < F.lit(REFETCHED).cast("date")
    write_silver(b.where(early), root, "1m")
    name = "bars_" + os.path.basename(root).replace("-", "_")
    archive_table(spark, root, "1m", name)
    merge_into_silver(b.where(~early), root, "1m", table=name)
    n = spark.table(name).groupBy("date").agg(F.count("*").alias("bars"))
    return table_sessions(spark, name).join(n, "date")


IO_QUERIES = {f.__name__[2:]: f for f in (
    q_load_bars, q_session_bars, q_silver_roundtrip, q_csv_spool, q_bronze_roundtrip, q_rebuild_silver,
    q_rebuild_quarantine, q_stream_merge, q_ingest, q_ingest_actions, q_action_store, q_new_splits,
    q_explicit_symbols, q_archive_views, q_merge_out_of_order, q_check_kept_summary, q_board_7d_fallback,
    q_top_oversize, q_top_malformed, q_top_nonpositive, q_top_no_volume, q_parse_dirty_payload,
    q_quarantine_typed, q_ingest_typed, q_stream_quarantine, q_stream_damaged, q_bronze_single_files, q_rebuild_partial,
    q_action_feed_files, q_publish_gate, q_archive_bytes, q_board_7d_kept, q_archive_counts, q_catalog_sessions)}
