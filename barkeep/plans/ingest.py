"""Write paths: ingest (C5), rebuild from bronze (S16), gated publish.

    ingest:   land bronze -> parse bars -> merge into silver (per interval)
              -> parse events -> merge into the action store
    rebuild:  read bronze (optionally from a fetch date on) -> parse -> merge
    publish:  run the gates over the archive; only on a pass copy the dates
              that changed to the destination, never deleting there

A landed response is never lost unnamed: everything is landed, what cannot be
used is written to the quarantine before anything is merged, and every
response read is accounted for. What was just landed is read strictly (a
damaged file fails the run); a rebuild sets damaged files aside, whole, and
returns their names.
"""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barkeep.operators.checks import assert_passed, run_checks, verdicts
from barkeep.operators.parse import GRAIN, bars_of, parse_events, parse_payload, read_responses, tallies
from barkeep.schema import CHECK_RESULT, INTERVALS
from barkeep.session import observed, scratch_path
from barkeep.sources.actions import save_actions
from barkeep.sources.bronze import (QUARANTINE, Tally, bronze_quarantine, damaged, keep_quarantine, land_bronze, landed_files,
                                    read_bronze, staged)
from barkeep.sources.silver import (archive_versions, available, current_check_summary, exists, load_bars,
                                    merge_into_silver, read_silver, write_silver)


def ingest(spark: SparkSession, payloads: DataFrame, bronze_root: str,
           silver_root: str, action_store: str | None = None, dry: bool = False,
           summary_root: str | None = None, quarantine_root: str | None = None) -> dict:
    """Land first, then derive. `payloads` carries (symbol, interval,
    fetched, payload). Bars are parsed from what was LANDED (read back from
    bronze, the durable copy), for the batch's (interval, fetched) keys
    only - literal partition filters. Returns (days, bars) per interval,
    (total, added) for actions, and the `Tally` of the responses read under
    "responses". `dry` lands bronze and returns the parsed counts (rows per
    interval, events) without touching silver or the action store. With
    `summary_root`, the gates' kept summary is refreshed for the dates each
    merge touched. What cannot be used - responses without a symbol, grain or
    fetch date or without a chart, and single values - is named in
    `quarantine_root` (`_quarantine` under silver) before any merge, not on a
    dry run. Fewer responses read back than were landed is an error."""
    keyed = Observation()
    land_bronze(payloads.observe(keyed, F.collect_set(F.struct("interval", "fetched")).alias("keys"),
                                 F.count(F.lit(1)).alias("landed")), bronze_root)
    got = observed(keyed)
    # (interval, fetched) of this batch: a few grains x a few fetch days
    keys = [(k[0] or None, k[1]) for k in got.get("keys", [])]
    if not keys:
        return {}
    batch = read_bronze(spark, bronze_root).where(_any_of(keys))
    out: dict = {}
    if not dry:
        out["responses"] = tally = keep_quarantine(batch, quarantine_root or os.path.join(silver_root, QUARANTINE))
        if tally.read < got["landed"]:
            raise RuntimeError("%d responses were landed, %d read back" % (got["landed"], tally.read))
    for iv in sorted({iv for iv, _ in keys if iv and re.match(GRAIN, iv)}):
        days = sorted({day for k, day in keys if k == iv and day})
        if days:
            bars = parse_payload(read_bronze(spark, bronze_root, iv).where(F.col("fetched").isin(days)))
            out[iv] = bars.count() if dry else merge_into_silver(bars, silver_root, iv, summary_root=summary_root)
    events = parse_events(batch)
    if dry:
        out["events"] = events.count()
    elif action_store:
        out["actions"] = save_actions(spark, events, action_store)
    return out


def _any_of(keys):
    """Partition filters for (interval, fetched) keys, null parts included."""
    out = F.lit(False)
    for iv in {k[0] for k in keys}:
        days = [d for k, d in keys if k == iv]
        named = F.col("fetched").isin([d for d in days if d]) if any(days) else F.lit(False)
        here = F.col("interval").isNull() if iv is None else F.col("interval") == iv
        out = out | (here & (named | F.col("fetched").isNull() if None in days else named))
    return out


@dataclass(frozen=True)
class Rebuilt:
    """What a rebuild did: days rewritten and bars now in them (on a dry run
    bars parsed and their days), the accounting of the responses read, and the
    quarantine, a table of (path, response, symbol, interval, fetched, reason):
    damaged files, unusable responses and wrong values."""

    days: int
    bars: int
    quarantine: DataFrame
    responses: Tally


def rebuild_silver(spark: SparkSession, bronze_root: str, silver_root: str,
                   interval: str, fetched_from=None, dry: bool = False,
                   summary_root: str | None = None) -> Rebuilt:
    """Re-derive silver from bronze (both layouts), no network. With
    `fetched_from`, responses from that fetch date AND every later one are
    parsed, so the newest fetch still wins (a partial rebuild is still a
    merge, X6). `dry` parses only. Every landed file is read once, inflated to
    its end and staged in the shared folder. Files that give no response at
    all, and are not in the quarantine, are an error. With `summary_root`, the
    gates' kept summary is refreshed."""
    files = landed_files(spark, bronze_root, interval, fetched_from)
    rows = staged(files, scratch_path(spark, "bronze-responses"))
    whole = rows.where("damage is null").drop("damage")
    quarantine = damaged(rows).unionByName(bronze_quarantine(whole))
    seen = Observation()
    bars = bars_of(read_responses(whole).observe(seen, *tallies()))
    if dry:
        days = bars.groupBy("date").agg(F.count("*").alias("n"))
        got = days.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    else:
        got = merge_into_silver(bars, silver_root, interval, summary_root=summary_root)
    responses = Tally.of(seen)
    if not responses.read and rows.isEmpty() and not files.select("path").isEmpty():
        raise ValueError("files were landed under %s, but no response could be read" % bronze_root)
    return Rebuilt(int(got[0]), int(got[1]), quarantine, responses)


def rebuild_archive(spark: SparkSession, bronze_root: str, silver_root: str,
                    intervals=INTERVALS, fetched_from=None, dry: bool = False,
                    summary_root: str | None = None) -> dict[str, Rebuilt]:
    """S16 for every grain."""
    return {iv: rebuild_silver(spark, bronze_root, silver_root, iv, fetched_from, dry, summary_root)
            for iv in intervals}


def check_archive(spark: SparkSession, silver_root: str, as_of=None, only=None,
                  intervals=INTERVALS, summary_root: str | None = None) -> DataFrame:
    """C2 over the whole archive: every gate for every interval, one
    verdict table. Each interval is one scan of silver; with
    `summary_root` (kept by `refresh_check_summary`), the verdicts come from
    the per-(symbol, date) summary table instead, after a comparison with
    the archive's dates and versions: only dates that differ are read."""
    out = None
    for iv in intervals:
        if summary_root:
            r = verdicts(current_check_summary(spark, silver_root, summary_root, iv), iv, as_of=as_of, only=only)
        else:
            r = run_checks(load_bars(spark, silver_root, iv), iv, as_of=as_of, only=only)
        out = r if out is None else out.unionByName(r)
    return out


class ArchiveChanged(RuntimeError):
    """The archive was rewritten while it was being gated or copied."""


def manifest(spark: SparkSession, silver_root: str, intervals) -> dict[str, dict]:
    """The version of every session date held, by grain: one value per date,
    from the listing alone. File names are unique to a write, so two equal
    manifests mean that nothing was rewritten between them."""
    return {iv: {r["date"]: r["version"] for r in archive_versions(spark, silver_root, iv).collect()} for iv in intervals}


def publish_if_passed(spark: SparkSession, silver_root: str, dest_root: str,
                      as_of, interval: str = "1m", since=None,
                      gate_intervals=INTERVALS, summary_root: str | None = None, attempts: int = 3) -> DataFrame:
    """Gate, then copy what was gated. Runs every check over every
    interval in `gate_intervals` (the verify step checks the whole archive);
    raises `ChecksFailed` (nothing copied) on any failure. On a pass those
    dates of `interval` from `since` on that changed since they were last
    published (or are not there) are dynamic-overwritten at the destination,
    which records the version of each published date; other dates are left
    alone there (never deleted). A destination without that record, or with
    one that lacks dates, gets them again. With `summary_root` the gates read
    the kept summary, brought up to date first. Returns the verdict rows.

    One snapshot: the files to copy are listed between two equal manifests,
    as are the files the gates read. A rewrite before the gates end shows as a
    differing manifest; one after it removes a listed file, and the copy, which
    reads the listed files and no others, fails before it commits. Either way
    nothing unchecked is published; the whole step runs again, at most
    `attempts` times, then `ArchiveChanged` is raised."""
    grains = sorted({*gate_intervals, interval})
    for left in range(attempts, 0, -1):
        held = manifest(spark, silver_root, grains)
        source = read_silver(spark, silver_root)          # lists the files now
        verdict = check_archive(spark, silver_root, as_of=as_of, intervals=gate_intervals, summary_root=summary_root).collect()
        results = spark.createDataFrame(verdict, CHECK_RESULT)
        if manifest(spark, silver_root, grains) == held:
            assert_passed(results)
            try:
                _copy(spark, source, held[interval], dest_root, interval, since)
                return results
            except Exception:
                if manifest(spark, silver_root, [interval]) == {interval: held[interval]}:
                    raise                                 # not the archive's doing
    raise ArchiveChanged("%s was rewritten during each of %d attempts to publish it" % (silver_root, attempts))


def _copy(spark: SparkSession, source: DataFrame, held: dict, dest_root: str, interval: str, since) -> None:
    """Copies the dates that changed and records their versions."""
    record = os.path.join(dest_root, "_published", "interval=%s" % interval)
    there, done = set(available(spark, dest_root, interval)), {}
    if there and exists(spark, record):
        done = {r["date"]: r["version"] for r in spark.read.schema("version long, date date").parquet(record).collect()}
    first = str(since)[:10] if since else ""
    changed = {d: v for d, v in held.items() if str(d) >= first and (d not in there or done.get(d) != v)}
    if changed:
        these = F.col("date").isin([F.lit(d) for d in sorted(changed)])
        write_silver(source.where((F.col("interval") == interval) & these), dest_root, interval)
        rows = spark.createDataFrame([(v, d) for d, v in changed.items()], "version long, date date")
        (rows.coalesce(1).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("date").parquet(record))
