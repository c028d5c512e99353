"""Registered queries: one per operator, each reading the driver's tables
(through `sources.driver`) in full, keyed as in SURVEY §7.4. The matching
DuckDB SQL lives in `plans.oracles` under the same key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barkeep.operators import actions as A
from barkeep.operators import checks as K
from barkeep.operators.candles import fold_bars
from barkeep.operators.merge import merge_bars
from barkeep.operators.parse import parse_events, parse_payload
from barkeep.operators.sessions import (bars_by_symbol_day, last_sessions, latest_bars,
                                        sessions, source_fallback)
from barkeep.plans import bench as B
from barkeep.plans.board import board
from barkeep.plans.registry_io import IO_QUERIES
from barkeep.sources import driver as D
from barkeep.sources.actions import listed_symbols
from barkeep.sources.bronze import bronze_quarantine
from barkeep.sources.silver import archive_stats

# --- fixed parameters of the registered queries ---
POINT_SYMBOL = "VIEW"
POINT_DAY = "2024-01-15"
RESAMPLE_SYMBOL = "CLICK"
ADJUST_UPTO = "2024-01-31"
AS_OF = "2024-02-04"
MORNING_END_M = 750               # a "noon" fetch holds bars before 12:30
# --- end of fixed parameters ---


def _b1(spark, sf):
    return D.bars(spark, sf, "1m")


def _b5(spark, sf):
    return D.bars(spark, sf, "5m")


def _store(spark, sf):
    return A.normalise_actions(D.weekly_feed(spark, sf))


def _feed(spark, sf):
    return A.normalise_actions(D.action_feed(spark, sf))


def q_bars_from_ticks(spark, sf):
    return _b1(spark, sf)


def q_bench_scan(spark, sf):
    return B.bench_scan(_b5(spark, sf))


def q_bench_point(spark, sf):
    return B.bench_point(_b5(spark, sf), POINT_SYMBOL, POINT_DAY)


def q_bench_resample(spark, sf):
    return B.bench_resample(_b1(spark, sf), RESAMPLE_SYMBOL)


def q_resample_all(spark, sf):
    """A4 over every symbol: 300-second clock buckets of all minute bars."""
    from barkeep.operators.candles import resample
    return resample(_b1(spark, sf), 300)


def q_sample_symbol_day(spark, sf):
    return B.sample_symbol_day(_b5(spark, sf))


def q_sessions(spark, sf):
    return sessions(_b1(spark, sf).unionByName(_b5(spark, sf)))


def q_fold_bars_5(spark, sf):
    return fold_bars(_b1(spark, sf).drop("interval"), 5)


def q_last_sessions_3(spark, sf):
    return last_sessions(_b1(spark, sf), 3)


def q_latest_bars(spark, sf):
    return latest_bars(_b1(spark, sf), 6)


def q_adjust_bars(spark, sf):
    return A.adjust_bars(_b1(spark, sf), _store(spark, sf), ADJUST_UPTO)


def q_action_factors(spark, sf):
    days = _b1(spark, sf).select("symbol", "date").distinct()
    return A.action_factors(days, _store(spark, sf), ADJUST_UPTO)


def _board(days):
    def q(spark, sf):
        return board(_b1(spark, sf), _b5(spark, sf), _store(spark, sf), days)
    return q


def q_board_7d_wide(spark, sf):
    """7-session boards over the wide universe (one symbol per user)."""
    return board(D.bars(spark, sf, "1m", key="user_id"), D.bars(spark, sf, "5m", key="user_id"),
                 _store(spark, sf), 7)


def q_run_checks_wide(spark, sf):
    return K.run_checks(D.bars(spark, sf, "1m", key="user_id"), "1m", as_of=AS_OF)


def q_source_fallback(spark, sf):
    fine = _b1(spark, sf)
    coarse = _b5(spark, sf).unionByName(D.bars(spark, sf, "5m", key="user_id"))
    return source_fallback(fine, coarse)


def _incoming_existing(spark, sf):
    """Newest-wins fixture: the archive holds an older version of every
    bar (prices + 1.0, fetched the session day); the batch holds the
    morning bars twice - fetched the next day with the true prices, and
    fetched the session day with prices + 2.0."""
    from barkeep.functions.timecols import minute_of_day
    b = _b1(spark, sf)
    existing = b.select("symbol", "ts", *[(F.col(p) + 1.0).alias(p) for p in "ohlc"], "v", "date")
    morning = b.where(minute_of_day("ts") < MORNING_END_M)
    new = morning.withColumn("fetched", F.date_add("date", 1))
    old = morning.select("symbol", "ts", *[(F.col(p) + 2.0).alias(p) for p in "ohlc"], "v", "date") \
                 .withColumn("fetched", F.col("date"))
    return new.unionByName(old, allowMissingColumns=True), existing


def q_merge_newest_wins(spark, sf):
    incoming, existing = _incoming_existing(spark, sf)
    return merge_bars(incoming, existing)


def q_merge_actions(spark, sf):
    return A.merge_actions(_feed(spark, sf), _store(spark, sf))


def q_new_actions(spark, sf):
    return A.new_actions(_feed(spark, sf), _store(spark, sf))


def q_classify_actions(spark, sf):
    feed = D.action_feed(spark, sf)
    subj = F.coalesce(F.col("subject"), F.col("purpose")).alias("subject")
    return A.classify_actions(feed.select(subj))


def q_unparsed_actions(spark, sf):
    return A.unparsed(_feed(spark, sf))


def q_action_counts(spark, sf):
    return A.action_counts(_feed(spark, sf))


def q_normalise_actions(spark, sf):
    return _feed(spark, sf)


def q_action_conflicts(spark, sf):
    return A.action_conflicts(A.merge_actions(_feed(spark, sf), _store(spark, sf)))


def q_parse_payload(spark, sf):
    return parse_payload(D.payloads(spark, sf), keep=("interval", "fetched"))


def q_parse_events(spark, sf):
    return parse_events(D.payloads(spark, sf))


def q_bronze_quarantine(spark, sf):
    return bronze_quarantine(D.damaged_payloads(spark, sf))


def q_bars_by_symbol_day(spark, sf):
    nested = bars_by_symbol_day(_b5(spark, sf))
    # one row per session: its bar count, first and last bar
    return nested.select("symbol", "date", F.size("bars").cast("long").alias("n"),
                         F.col("bars")[0]["ts"].alias("first_ts"),
                         F.element_at("bars", -1)["c"].alias("last_c"))


def q_listed_symbols(spark, sf):
    return listed_symbols(D.symbol_list(spark, sf), ("EQ",))


def q_archive_stats(spark, sf):
    return archive_stats(_b1(spark, sf).unionByName(_b5(spark, sf)))


def _faulty(spark, sf):
    return D.faulty_bars(_b1(spark, sf), "1m")


def q_check_duplicates(spark, sf):
    return K.check_duplicates(_faulty(spark, sf))


def q_top_duplicates(spark, sf):
    """L4: the five most-copied bars, ties broken by symbol then ts."""
    return K.top_offenders(K.check_duplicates(_faulty(spark, sf)),
                           [F.col("n").desc(), "symbol", "ts"])


def q_check_malformed(spark, sf):
    return K.check_malformed(_faulty(spark, sf))


def q_check_nonpositive(spark, sf):
    return K.check_nonpositive(_faulty(spark, sf))


def q_check_oversize(spark, sf):
    return K.check_oversize(_faulty(spark, sf), "1m")


def q_check_no_volume(spark, sf):
    return K.check_no_volume(_faulty(spark, sf))


def q_check_reach(spark, sf):
    return K.check_reach(_faulty(spark, sf))


def q_check_fresh(spark, sf):
    return K.check_fresh(_b1(spark, sf), AS_OF)


def q_session_gaps(spark, sf):
    return K.session_gaps(_faulty(spark, sf), "1m")


def q_run_checks(spark, sf):
    faulty = K.run_checks(_faulty(spark, sf), "1m", as_of=AS_OF)
    clean5 = K.run_checks(_b5(spark, sf), "5m", as_of=AS_OF)
    return faulty.unionByName(clean5)


def q_run_checks_day(spark, sf):
    return K.run_checks(_faulty(spark, sf), "1m", only=POINT_DAY)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bars_from_ticks": q_bars_from_ticks,
    "bench_scan": q_bench_scan,
    "bench_point": q_bench_point,
    "bench_resample": q_bench_resample,
    "resample_all": q_resample_all,
    "sample_symbol_day": q_sample_symbol_day,
    "sessions": q_sessions,
    "fold_bars_5": q_fold_bars_5,
    "last_sessions_3": q_last_sessions_3,
    "latest_bars": q_latest_bars,
    "adjust_bars": q_adjust_bars,
    "action_factors": q_action_factors,
    "board_1d": _board(1),
    "board_3d": _board(3),
    "board_7d": _board(7),
    "board_20d": _board(20),
    "board_44d": _board(44),
    "board_7d_wide": q_board_7d_wide,
    "source_fallback": q_source_fallback,
    "merge_newest_wins": q_merge_newest_wins,
    "merge_actions": q_merge_actions,
    "new_actions": q_new_actions,
    "classify_actions": q_classify_actions,
    "action_counts": q_action_counts,
    "unparsed_actions": q_unparsed_actions,
    "normalise_actions": q_normalise_actions,
    "action_conflicts": q_action_conflicts,
    "parse_payload": q_parse_payload,
    "parse_events": q_parse_events,
    "bronze_quarantine": q_bronze_quarantine,
    "bars_by_symbol_day": q_bars_by_symbol_day,
    "listed_symbols": q_listed_symbols,
    "archive_stats": q_archive_stats,
    "check_duplicates": q_check_duplicates,
    "top_duplicates": q_top_duplicates,
    "check_malformed": q_check_malformed,
    "check_nonpositive": q_check_nonpositive,
    "check_oversize": q_check_oversize,
    "check_no_volume": q_check_no_volume,
    "check_reach": q_check_reach,
    "check_fresh": q_check_fresh,
    "session_gaps": q_session_gaps,
    "run_checks": q_run_checks,
    "run_checks_day": q_run_checks_day,
    "run_checks_wide": q_run_checks_wide,
} | IO_QUERIES
