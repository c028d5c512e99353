"""Bronze: the raw upstream responses, landed before anything parses them
(S1-S3, Y11).

Layout: `<root>/interval=<iv>/fetched=<YYYY-MM-DD>/<SYMBOL>.json.gz`
in the single-writer case, or Spark's own part files when landed in bulk
(`land_bronze`): gzip JSON-lines records with symbol and landing time.
`read_bronze` reads both. A damaged file fails a read; `readable_bronze`
sets damaged files aside, whole and by name, and reads the others. A response
without a symbol, grain or fetch date is landed like any other (a missing
folder value under Spark's name for it), so the raw text is kept; it gives no
bar and is named in the quarantine.
"""

from __future__ import annotations

import datetime as dt
import os
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from barkeep.operators.parse import read_responses, reasons_of, tallies
from barkeep.schema import LANDED
from barkeep.session import observed, scratch_path

#: Folder of the quarantine table beside the silver partitions.
QUARANTINE = "_quarantine"
_BULK = "part-*.json.gz"
#: Every name that does not begin with `part-`.
_SINGLE = "{[^p]*,p,p[^a]*,pa,pa[^r]*,par,par[^t]*,part,part[^-]*}.json.gz"


def land_bronze(payloads: DataFrame, root: str) -> None:
    """Append responses (symbol, interval, fetched, payload[, landed_at])
    as gzip JSON lines partitioned by interval and fetch date. Never
    rewritten; a re-landed key is a new row whose later `landed_at` wins
    when merged (the same last-write-wins as replacing the file). gzip is
    not splittable, so the files are sized by rebalancing: a small folder
    is one file, a large one several of the session's advisory size."""
    df = payloads
    if "landed_at" not in df.columns:
        df = df.withColumn("landed_at", F.current_timestamp())
    rows = df.select("symbol", "interval", "fetched", "landed_at", "payload")
    (rows.hint("rebalance", "interval", "fetched")
         .write.mode("append").option("compression", "gzip")
         .partitionBy("interval", "fetched").json(root))


def land_responses(payloads: DataFrame, root: str) -> int:
    """S1 in the one-file-per-response layout: (symbol, interval, fetched,
    payload) as `interval=/fetched=/<SYMBOL>.json.gz`, a response landed again
    replacing the earlier one. Spark writes the files, the driver then gives
    each its name (a rename per response, nothing of them is read). Returns the
    number of files; of rows with one key and rows without a key none is
    written, and the call fails."""
    spark = payloads.sparkSession
    stage = scratch_path(spark, "landing")
    key = ["interval", "fetched", "symbol"]
    rows = payloads.select(F.upper("symbol").alias("symbol"), "interval", "fetched", "payload")
    bad = rows.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1 or symbol is null or interval is null or fetched is null").limit(1).collect()
    if bad:
        raise ValueError("a response per symbol, interval and fetch date is needed: %s" % (bad[0],))
    rows.repartition(*key).write.option("compression", "gzip").partitionBy(*key).text(stage)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(stage).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, n = fs.globStatus(path(os.path.join(stage, "interval=*", "fetched=*", "symbol=*", "part-*.gz"))), 0
    for st in found or []:
        folder = st.getPath().getParent()
        day = os.path.join(root, folder.getParent().getParent().getName(), folder.getParent().getName())
        name = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(
            folder.getName()[len("symbol="):])
        target = path(day, name + ".json.gz")
        fs.mkdirs(target.getParent())
        if fs.exists(target):
            fs.delete(target, False)
        if not fs.rename(st.getPath(), target):
            raise OSError("could not name %s" % target)
        n += 1
    fs.delete(path(stage), True)
    return n


def _narrowed(df: DataFrame, interval: str | None, fetched_from) -> DataFrame:
    """`interval` and `fetched_from` (this fetch date and every later one, so
    a partial rebuild still lets the newest fetch win - X6) as partition
    filters."""
    if interval:
        df = df.where(F.col("interval") == interval)
    if fetched_from:
        d = fetched_from.isoformat() if isinstance(fetched_from, dt.date) else fetched_from
        df = df.where(F.col("fetched") >= F.lit(d).cast("date"))
    return df


def read_bronze(spark: SparkSession, root: str, interval: str | None = None,
                fetched_from=None) -> DataFrame:
    """Landed responses of both layouts with the `path` each came from.
    A damaged file fails the read."""
    bulk = (spark.read.schema(LANDED).option("basePath", root).option("pathGlobFilter", _BULK)
                 .option("ignoreCorruptFiles", "false").json(root))
    bulk = _narrowed(bulk, interval, fetched_from).select(
        "symbol", "landed_at", "payload", F.col("_metadata.file_path").alias("path"), "interval", "fetched")
    return bulk.unionByName(read_bronze_files(spark, root, interval, fetched_from))


def read_bronze_files(spark: SparkSession, root: str, interval: str | None = None,
                      fetched_from=None) -> DataFrame:
    """S2 for the one-file-per-response layout: each `<SYMBOL>.json.gz` is
    one record (whole-file text, gzip decoded by extension); `interval` and
    `fetched` come from the folder names, so their filters prune folders;
    the symbol is the file name (Y11), the landing time the file's."""
    df = (spark.read.schema("value string, interval string, fetched date").option("wholetext", "true")
               .option("basePath", root).option("pathGlobFilter", _SINGLE)
               .option("ignoreCorruptFiles", "false").text(root))
    return _responses(_narrowed(df, interval, fetched_from))


def _responses(files: DataFrame) -> DataFrame:
    """One response per whole file."""
    name = F.col("_metadata.file_name")
    return files.select(
        F.regexp_replace(name, r"\.json\.gz$", "").alias("symbol"),
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("value").alias("payload"), F.col("_metadata.file_path").alias("path"), "interval", "fetched")


def bronze_stream(spark: SparkSession, root: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """S2 as a stream of landed files (path, modificationTime, length,
    content), of both layouts; `decoded` makes responses of them. A
    micro-batch takes up to `max_files_per_trigger` files."""
    r = (spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary")
              .option("pathGlobFilter", "*.json.gz").option("recursiveFileLookup", "true"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(root)


def landed_files(spark: SparkSession, root: str, interval: str | None = None, fetched_from=None) -> DataFrame:
    """(path, interval, fetched) of every landed file, from the listing."""
    df = (spark.read.format("binaryFile").option("basePath", root).option("pathGlobFilter", "*.json.gz")
               .option("recursiveFileLookup", "false").load(root))
    return _narrowed(df.withColumns({"interval": F.col("interval").cast("string"), "fetched": F.col("fetched").cast("date")}),
                     interval, fetched_from)


def inflated(content, slice_bytes: int = 1 << 16, piece: int = 1 << 20):
    """The bytes of a gzip file in pieces of at most `piece`. `content` is
    fed in fixed slices through a memoryview, so nothing of it is copied
    twice and time is linear in both sizes; a file may hold several streams.
    Raises EOFError or zlib.error where it is no whole gzip file: each
    stream's own length and checksum vouch for every byte."""
    import zlib
    view, at = memoryview(content), 0
    if not len(view):
        raise EOFError("empty file")
    while at < len(view):
        z = zlib.decompressobj(31)
        while not z.eof:
            if at >= len(view):
                raise EOFError("file ends before its end")
            data = view[at:at + slice_bytes]
            at += len(data)
            while len(data) and not z.eof:
                out = z.decompress(data, piece)
                if out:
                    yield out
                data = z.unconsumed_tail
        at -= len(z.unused_data)


def decoded(files: DataFrame) -> DataFrame:
    """The responses of landed files (path, modificationTime,
    content): (symbol, landed_at, payload, path, interval, fetched, damage).
    A file is inflated to its end before any of it is given out: a damaged one
    is a single row with its `damage` and no payload, never a part of its
    responses. Grain and fetch date come from the folder names, in a bulk file
    (`part-`) symbol and landing time from its lines, else from the file."""
    def lines(batches):
        import zlib

        import pyarrow as pa
        names = ["path", "modificationTime", "line", "damage"]
        kinds = [pa.string(), pa.timestamp("us", tz="UTC"), pa.string(), pa.string()]

        def batch(rows):
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names)

        for b in batches:
            for path, when, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                raw = content.as_buffer() if content.is_valid else b""
                try:
                    for _ in inflated(raw):
                        pass
                except (zlib.error, EOFError) as e:
                    yield batch([(path, when, None, str(e))])
                    continue
                whole = not path.rsplit("/", 1)[1].startswith("part-")
                rows, size, rest = [], 0, []
                for out in inflated(raw):
                    *ended, last = [out] if whole else out.split(b"\n")
                    for x in ended:
                        rest.append(x)
                        text = b"".join(rest).decode("utf-8", "replace")
                        rest, size = [], size + len(text)
                        if text.strip():
                            rows.append((path, when, text, None))
                    rest.append(last)
                    if size > 1 << 23:
                        yield batch(rows)
                        rows, size = [], 0
                text = b"".join(rest).decode("utf-8", "replace")
                if whole or text.strip():
                    rows.append((path, when, text, None))
                if rows:
                    yield batch(rows)

    x = files.select("path", "modificationTime", "content").mapInArrow(
        lines, "path string, modificationTime timestamp, line string, damage string")
    name = F.substring_index("path", "/", -1)
    bulk = name.startswith("part-")
    x = x.withColumn("path", F.regexp_replace("path", "^file:/+", "file:///"))  # as readers of text name it
    x = x.withColumn("_r", F.when(bulk, F.from_json("line", "symbol string, landed_at timestamp, payload string")))
    grain = F.nullif(F.regexp_extract("path", r"/interval=([^/]*)/", 1), F.lit(""))
    return x.select(
        F.when(bulk, F.col("_r.symbol")).otherwise(F.regexp_replace(name, r"\.json\.gz$", "")).alias("symbol"),
        F.when(bulk, F.col("_r.landed_at")).otherwise(F.col("modificationTime")).alias("landed_at"),
        F.when(bulk, F.col("_r.payload")).otherwise(F.col("line")).alias("payload"), "path",
        F.when(grain != "__HIVE_DEFAULT_PARTITION__", grain).alias("interval"),
        F.try_to_date(F.nullif(F.regexp_extract("path", r"/fetched=(\d{4}-\d{2}-\d{2})/", 1), F.lit(""))).alias("fetched"), "damage")


RESPONSES = "symbol string, landed_at timestamp, payload string, path string, interval string, fetched date, damage string"


def staged(files: DataFrame, path: str) -> DataFrame:
    """`decoded(files)`, each file read and inflated once, as a table at
    `path` in the shared folder."""
    decoded(files).write.mode("overwrite").parquet(path)
    return files.sparkSession.read.schema(RESPONSES).parquet(path)


def readable_bronze(spark: SparkSession, root: str, interval: str | None = None,
                    fetched_from=None) -> tuple[DataFrame, DataFrame]:
    """(responses of whole files, quarantine rows of the damaged files). Every
    file is read once; rows of a damaged file are all left out."""
    rows = staged(landed_files(spark, root, interval, fetched_from), scratch_path(spark, "bronze-responses"))
    return rows.where("damage is null").drop("damage"), damaged(rows)


def damaged(rows: DataFrame) -> DataFrame:
    """The quarantine rows of damaged files among decoded ones."""
    return rows.where("damage is not null").select(
        "path", F.lit(None).cast("long").alias("response"), "symbol", "interval", "fetched", F.col("damage").alias("reason"))


_QUARANTINED = "path string, response long, symbol string, interval string, fetched date, reason string"


def bronze_quarantine(bronze: DataFrame) -> DataFrame:
    """S3: what of the landed responses could not be used - named, never
    silently dropped: (path, response = hash of the payload, symbol, interval,
    fetched, as far as given, and reason). A row per response without a key or
    without a chart result, per value of a wrong type in a response otherwise
    used, and per response with an unreadable event."""
    return _reasons(read_responses(bronze))


def _reasons(r: DataFrame) -> DataFrame:
    cols = [c for c in ("path", "symbol", "interval", "fetched") if c in r.columns]
    return reasons_of(r, [*cols[:1], F.xxhash64("payload").alias("response"), *cols[1:]] if cols[:1] == ["path"] else cols)


@dataclass(frozen=True)
class Tally:
    """Row accounting: every response read is parsed, empty (blank or without
    a result) or quarantined whole."""

    read: int = 0
    parsed: int = 0
    empty: int = 0
    quarantined: int = 0

    @classmethod
    def of(cls, seen: Observation) -> "Tally":
        t = cls(**{k: int(v) for k, v in observed(seen).items()})
        if t.read != t.parsed + t.empty + t.quarantined:
            raise RuntimeError("responses unaccounted for: %s" % (t,))
        return t


def keep_quarantine(bronze: DataFrame, root: str, files: DataFrame | None = None) -> Tally:
    """S3: append the quarantine of `bronze` (and rows of damaged `files`) to
    the table at `root`; a response met again is there again
    (`read_quarantine` gives it once)."""
    seen = Observation()
    rows = _reasons(read_responses(bronze).observe(seen, *tallies()))
    if files is not None:
        rows = rows.unionByName(files)
    rows.write.mode("append").parquet(root)
    return Tally.of(seen)


def read_quarantine(spark: SparkSession, root: str) -> DataFrame:
    """(path, response, symbol, interval, fetched, reason) of everything kept out."""
    return spark.read.schema(_QUARANTINED).parquet(root).distinct()
