"""Silver archive I/O (S4-S8, S13, S14, S16 sink side).

Layout: `<root>/interval=<1m|5m>/date=<YYYY-MM-DD>/part-*.parquet`,
zstd, each file sorted by (symbol, ts) so parquet min/max statistics skip
row groups for a one-symbol read, and the date directory is pruned for a
date range (PartitionFilters).
"""

from __future__ import annotations

import datetime as dt
import os

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barkeep.operators.checks import check_summary
from barkeep.operators.merge import merge_bars
from barkeep.schema import BAR_COLS, BAR_CSV, PROVENANCE, SILVER
from barkeep.session import observed

# Parquet row-group size used on write: small enough that a day holding
# every symbol splits into many row groups the symbol filter can skip.
ROW_GROUP_BYTES = 8 * 1024 * 1024
# A row group whose symbols outgrow its dictionary carries a bloom filter of
# this many instead: either lets a point read skip it without reading it.
SYMBOLS_EXPECTED = 20_000
_DATE_FOLDER = "date=[0-9][0-9][0-9][0-9]-[0-1][0-9]-[0-3][0-9]"


def _d(x):
    if isinstance(x, (dt.date, dt.datetime)):
        return x.isoformat()[:10]
    return x


def read_silver(spark: SparkSession, root: str) -> DataFrame:
    """Every interval and date; partition columns typed by the schema.

    A missing archive reads as an empty table. Only folders named like a date
    are listed, so a stray one (`date=junk`) does no harm."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    days = path(os.path.join(root, "interval=*", _DATE_FOLDER))
    found = days.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(days)
    if not found:
        return spark.createDataFrame([], SILVER)      # not fetched yet: empty, not an error
    return spark.read.schema(SILVER).option("basePath", root).parquet(days.toString())


def load_bars(spark: SparkSession, root: str, interval: str,
              symbol: str | None = None, since=None, upto=None) -> DataFrame:
    """S4 + P6/P7: stored bars of one interval, optionally one symbol and a
    date range (inclusive). The symbol predicate is pushed to the parquet
    reader; the date predicates prune directories. No ORDER BY here: sort
    at the edge (`.orderBy("ts")`) only when a caller needs order."""
    df = read_silver(spark, root).drop(*PROVENANCE).where(F.col("interval") == interval)
    if symbol:
        df = df.where(F.col("symbol") == symbol.upper())
    if since:
        df = df.where(F.col("date") >= F.lit(_d(since)).cast("date"))
    if upto:
        df = df.where(F.col("date") <= F.lit(_d(upto)).cast("date"))
    return df


def session_bars(spark: SparkSession, root: str, day, interval: str = "5m") -> DataFrame:
    """Every symbol's bars for one session (one partition read)."""
    return load_bars(spark, root, interval, since=day, upto=day)


def read_bars_csv(spark: SparkSession, path: str) -> DataFrame:
    """The headerless typed CSV spool (seven bar columns + date `d`)."""
    return (spark.read.schema(BAR_CSV).option("header", "false")
                 .option("mode", "FAILFAST").csv(path)
                 .withColumnRenamed("d", "date"))


def register_views(spark: SparkSession, root: str) -> None:
    """`bars1` and `bars5` temp views for SQL users."""
    for iv in ("1m", "5m"):
        load_bars(spark, root, iv).createOrReplaceTempView("bars%s" % iv.rstrip("m"))


def write_silver(bars: DataFrame, root: str, interval: str) -> None:
    """S8 sink: write into `<root>/interval=<interval>/`, replacing only the
    dates present in `bars` (dynamic partition overwrite, which stages the
    new files and replaces the dates when the job commits).

    Rebalanced by date: adaptive execution puts small days into one file
    each and splits a large day over several, at the session's advisory
    partition size. Each file is sorted by (symbol, ts). Writing one
    interval at a time keeps the sort (H6). Dictionary or bloom filter of
    `symbol` answer for symbols a row group does not hold.
    """
    origin = [F.col(c) if c in bars.columns else F.lit(None).cast(SILVER[c].dataType).alias(c) for c in PROVENANCE]
    b = bars.select(*BAR_COLS, *origin, "date")
    (b.hint("rebalance", "date").sortWithinPartitions("date", "symbol", "ts")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .option("parquet.block.size", ROW_GROUP_BYTES)
        .option("parquet.bloom.filter.enabled#symbol", "true")
        .option("parquet.bloom.filter.expected.ndv#symbol", SYMBOLS_EXPECTED)
        .partitionBy("date")
        .parquet(os.path.join(root, "interval=%s" % interval)))


def available(spark: SparkSession, root: str, interval: str) -> list:
    """Session dates held for one interval, oldest first, read from the
    directory names only (one listing, no file opened); a name that is not
    a date is skipped."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(os.path.join(root, "interval=%s" % interval))
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("date="):
            try:
                out.append(dt.date.fromisoformat(name[5:]))
            except ValueError:
                continue
    return sorted(out)


def touched_dates(incoming: DataFrame) -> list:
    """Distinct session dates in a batch - one value per calendar day (a
    fetch covers days to weeks), used as a static partition filter."""
    return sorted(r[0] for r in incoming.select("date").distinct().collect())


def merge_into_silver(incoming: DataFrame, root: str, interval: str,
                      summary_root: str | None = None, table: str | None = None) -> tuple[int, int]:
    """G1 + S8: merge a batch of parsed bars into silver. Returns
    (days rewritten, bars now in those days).

    Existing rows are read only for the dates the batch touches, and one
    write replaces those dates when it commits: no task reads a replaced
    partition, and a lost executor's tasks read the old files again. When
    the grain holds nothing yet, the dates are not asked for beforehand.
    With `summary_root`, the gates' kept summary is refreshed for the
    touched dates afterwards; with `table`, the dates are made known to that
    table (`archive_table`).
    """
    spark = incoming.sparkSession
    existing = None
    if exists(spark, os.path.join(root, "interval=%s" % interval)):
        days = touched_dates(incoming)
        if not days:
            return 0, 0
        existing = read_silver(spark, root).where(
            (F.col("interval") == interval) & F.col("date").isin([F.lit(d) for d in days]))
    written = Observation()
    merged = merge_bars(incoming, existing, provenance=True).observe(
        written, F.count(F.lit(1)).alias("bars"), F.collect_set("date").alias("days"))
    write_silver(merged, root, interval)
    got = observed(written)
    if not got:
        return 0, 0
    if summary_root:
        refresh_check_summary(spark, root, summary_root, interval, sorted(got["days"]))
    if table:
        add_partitions(spark, table, sorted(got["days"]))
    return len(got["days"]), got["bars"]


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    jsc = spark.sparkContext._jsc
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(jsc.hadoopConfiguration()).exists(p)


def archive_stats(bars: DataFrame) -> DataFrame:
    """Per interval, day partitions and bars held."""
    # Counts per (interval, date, symbol) first: distinct counting would
    # send every bar through the shuffle once per counted column.
    cells = bars.groupBy("interval", "date", "symbol").agg(F.count("*").alias("n"))
    days = cells.groupBy("interval", "date").agg(F.sum("n").alias("n")).groupBy("interval").agg(
        F.count("*").alias("days"), F.sum("n").alias("bars"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    symbols = cells.groupBy("interval", "symbol").agg(F.lit(1)).groupBy("interval").agg(F.count("*").alias("symbols"))
    return days.join(symbols, "interval").select("interval", "days", "bars", "symbols", "first_date", "last_date")


def archive_counts(spark: SparkSession, root: str) -> DataFrame:
    """S14 / A13 from footers: bars, first and last epoch of every (interval,
    date) held. The counts are pushed into Parquet's footers, so no column of
    any bar is read; the reader that can do so is chosen in a session of its
    own, the caller's settings stay."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return read_silver(own, root).groupBy("interval", "date").agg(
        F.count("*").alias("bars"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


# ------------------------------------------------------------------- catalog

def archive_table(spark: SparkSession, root: str, interval: str, name: str) -> None:
    """An external table over one grain of the archive with every
    date it holds as a partition."""
    spark.sql("CREATE TABLE IF NOT EXISTS %s (symbol STRING, ts BIGINT, o DOUBLE, h DOUBLE, l DOUBLE, c DOUBLE, v BIGINT, "
              "fetched DATE, landed_at TIMESTAMP, date DATE) USING parquet PARTITIONED BY (date) LOCATION '%s'"
              % (name, os.path.join(root, "interval=%s" % interval)))
    add_partitions(spark, name, available(spark, root, interval))


def add_partitions(spark: SparkSession, name: str, dates) -> None:
    """Makes `dates` known to the table, as each merge does for its own."""
    dates = [str(d) for d in dates]
    for lo in range(0, len(dates), 500):
        spark.sql("ALTER TABLE %s ADD IF NOT EXISTS %s" % (
            name, " ".join("PARTITION (date = DATE '%s')" % d for d in dates[lo:lo + 500])))
    if dates:
        spark.catalog.refreshTable(name)


def table_sessions(spark: SparkSession, name: str) -> DataFrame:
    """S6 from the catalog: the table's session dates, oldest first; no
    folder is listed."""
    parts = spark.sql("SHOW PARTITIONS %s" % name)
    return parts.select(F.to_date(F.substring_index("partition", "=", -1)).alias("date")).orderBy("date")


def archive_bytes(spark: SparkSession, root: str) -> DataFrame:
    """Total bytes and file count under `root`, from file listing
    metadata only (binaryFile without reading content)."""
    files = (spark.read.format("binaryFile")
                  .option("recursiveFileLookup", "true").load(root)
                  .select("path", "length"))
    return files.agg(F.count("*").alias("files"), F.sum("length").alias("bytes"))


_SUMMARY = ("symbol string, n long, n_ts int, last_m int, vol long, bad long, nonpos long, "
            "misplaced long, bad_ts array<long>, nonpos_ts array<long>, version long, date date")


def archive_versions(spark: SparkSession, root: str, interval: str) -> DataFrame:
    """(date, version) of every session date held: a hash of its files'
    names and sizes, from the listing alone. A rewritten date has another
    version, as file names are unique to a write."""
    path = os.path.join(root, "interval=%s" % interval)
    if not exists(spark, path):
        return spark.createDataFrame([], "date date, version long")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
                  .option("recursiveFileLookup", "true").load(path).select("path", "length"))
    day = F.to_date(F.nullif(F.regexp_extract("path", r"/date=(\d{4}-\d{2}-\d{2})/", 1), F.lit("")))
    name = F.xxhash64(F.substring_index("path", "/", -1), "length")
    return files.select(day.alias("date"), name.alias("h")).where("date is not null").groupBy("date").agg(
        F.expr("bit_xor(h)").alias("version"))


def read_check_summary(spark: SparkSession, summary_root: str, interval: str) -> DataFrame:
    """The kept check summary of one interval (empty if never refreshed)."""
    path = os.path.join(summary_root, "interval=%s" % interval)
    if not exists(spark, path):
        return spark.createDataFrame([], _SUMMARY)
    return spark.read.schema(_SUMMARY).parquet(path)


def refresh_check_summary(spark: SparkSession, silver_root: str, summary_root: str,
                          interval: str, dates) -> None:
    """Recompute the check summary for `dates` from silver (only those
    partitions are read) and replace just those dates in the kept summary
    (dynamic overwrite), marked with the version of the date it was made
    from. Call it with the dates a merge touched: the nightly gates then
    cost the new data, not the archive."""
    if not dates:
        return
    versions = archive_versions(spark, silver_root, interval)
    bars = load_bars(spark, silver_root, interval).where(
        F.col("date").isin([F.lit(d) for d in dates]))
    (check_summary(bars).join(versions, "date").hint("rebalance", "date").write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("date")
        .parquet(os.path.join(summary_root, "interval=%s" % interval)))


def current_check_summary(spark: SparkSession, silver_root: str, summary_root: str,
                          interval: str) -> DataFrame:
    """The kept summary of exactly what the archive holds now: dates whose
    version differs, or that it lacks, are recomputed first, and dates the
    archive no longer holds are left out. So a gate that reads it never
    passes a bar it has not seen."""
    held = archive_versions(spark, silver_root, interval)
    kept = read_check_summary(spark, summary_root, interval)
    known = kept.groupBy("date").agg(F.max("version").alias("known"), F.min("version").alias("least"))
    stale = held.join(known, "date", "left").where(
        F.col("known").isNull() | (F.col("known") != F.col("version")) | (F.col("least") != F.col("version")))
    # one value per session date
    refresh_check_summary(spark, silver_root, summary_root, interval,
                          sorted(r[0] for r in stale.select("date").collect()))
    return read_check_summary(spark, summary_root, interval).join(held.select("date"), "date", "left_semi")
