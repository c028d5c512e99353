"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches. A batch's lines become keys (128-bit hashes of the
stripped, A-Z lower-cased line) with the number of the batch's documents that
hold them; the batch merge-anti-joins every live run, and what no run holds is
fresh: its holder is this batch's largest document. Then the batch adds its
own run (its keys, their documents, the holder of the fresh ones). FANOUT runs
of a level are compacted into one run of the next: documents added up, the one
holder kept. So the live runs stay few (FANOUT - 1 a level) and every key is
rewritten once a level. A run is bucketed and sorted by key: the joins read it
in place, only the new batch is shuffled.

`deduped` feeds the documents in descending order of id, so a key's holder is
the largest id that holds it, and drops the lines whose key is in at least
`min_docs` documents from all documents but the holder. Decisions go back to
a text by (doc_id, hash of the text). Hot keys (a line in a third of all
documents) are pre-aggregated inside a task, broadcast in the last join (at
most HOT of them) and never meet in one task; copies of one row are salted.

Edge cases: rows that share a doc_id are one document (a line counts once,
all its rows keep what it holds); rows without an id are one document less
than any id, which holds a line only where no other does; a null or empty
text is one empty line and never loses it; texts of any length are split
whole, inside their own task; equal ids need no tie rule; an empty table
gives no rows and no runs; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barkeep.llm.common import HOT, WHITE, spread_join, stored, table, text_bytes
from barkeep.session import scratch_path

MIN_CHARS, MIN_DOCS = 40, 5
BATCHES, FANOUT = 6, 3
#: Keys of one bucket of a run, and the most buckets the engine takes.
BUCKET_ROWS, MAX_BUCKETS = 1 << 20, 100_000
KEY = ["h1", "h2"]


def line_key(line: bytes) -> bytes:
    """A line stripped of white space at both ends, A-Z lower-cased."""
    return line.strip(WHITE).lower()


def _chars(key: bytes) -> int:
    return len(key) if key.isascii() else len(key.decode("utf-8", "replace"))


def _hash(key: bytes) -> bytes:
    import xxhash
    return xxhash.xxh3_128_digest(key)


def line_pairs(docs: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, th, h1, h2): each distinct key of at least `min_chars` code
    points of each row; th is the hash of the whole text."""
    def split(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            row, found = [], []
            for i, text in enumerate(text_bytes(b.column(2))):
                keys = {line_key(x) for x in (text or b"").split(b"\n") if len(x) >= min_chars}
                own = [_hash(k) for k in keys if len(k) >= min_chars and _chars(k) >= min_chars]
                row += [i] * len(own)
                found += own
            h = np.frombuffer(b"".join(found), np.int64).reshape(-1, 2)
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0).take(at), b.column(1).take(at), pa.array(h[:, 0]), pa.array(h[:, 1])],
                                             ["doc_id", "th", *KEY])

    return _rows(docs).mapInArrow(split, "doc_id long, th long, h1 long, h2 long")


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), F.col("text").cast("string").alias("text"))


class LineRuns:
    """Levelled sorted runs of (h1, h2, docs, n, holder) in the shared folder."""

    def __init__(self, spark: SparkSession, buckets: int, fanout: int = FANOUT):
        self.spark, self.buckets, self.fanout = spark, buckets, fanout
        self.levels: list[list[str]] = []
        self.paths: dict[str, str] = {}

    def _write(self, keys: DataFrame) -> str:
        name = "line_run_" + uuid.uuid4().hex
        self.paths[name] = scratch_path(self.spark, name)
        (keys.repartition(self.buckets, *KEY).sortWithinPartitions(*KEY).write.format("parquet")
             .option("path", self.paths[name]).bucketBy(self.buckets, *KEY).sortBy(*KEY).saveAsTable(name))
        return name

    def _read(self, runs: list[str]) -> DataFrame:
        return self.spark.read.schema("h1 long, h2 long, docs long, n long, holder long").parquet(*[self.paths[r] for r in runs])

    def live(self) -> list[str]:
        return [run for level in self.levels for run in level]

    def add(self, keys: DataFrame) -> DataFrame:
        """Adds a batch (h1, h2, docs, n, holder; one row per key) as a run and
        gives it back: holder is null where an earlier run holds the key."""
        held = []
        for i, run in enumerate(self.live()):
            held.append("__run%d" % i)
            keys = keys.join(self.spark.table(run).select(*KEY, F.lit(True).alias(held[-1])).hint("merge"), KEY, "left")
        fresh = F.lit(True)
        for c in held:
            fresh = fresh & F.col(c).isNull()
        run = self._write(keys.select(*KEY, "docs", "n", F.when(fresh, F.col("holder")).alias("holder")))
        self._push(0, run)
        return self._read([run])

    def _push(self, at: int, run: str) -> None:
        if at == len(self.levels):
            self.levels.append([])
        self.levels[at].append(run)
        if len(self.levels[at]) == self.fanout:
            old, self.levels[at] = self.levels[at], []
            self._push(at + 1, self._write(self.merged(old)))
            for run in old:
                self.spark.sql("DROP TABLE " + run)

    def merged(self, runs: list[str] | None = None) -> DataFrame:
        """One row per key over some (else all) runs. Their files are read
        plainly: a union of bucketed scans under one aggregate gave a key
        twice (its scans lost the buckets after the shuffle was left out)."""
        rows = self._read(self.live() if runs is None else runs)
        return rows.groupBy(*KEY).agg(F.sum("docs").alias("docs"), F.sum("n").alias("n"), F.max("holder").alias("holder"))

    def forget(self) -> None:
        """Takes the live runs out of the catalog; their files stay."""
        for run in self.live():
            self.spark.sql("DROP TABLE " + run)


def batch_keys(pairs: DataFrame) -> DataFrame:
    """(h1, h2, docs, n rows, holder) of a batch of pairs: distinct documents first,
    so the shuffle by key gets one pre-aggregated row per task of a hot key."""
    once = pairs.groupBy(*KEY, "doc_id").agg(F.count(F.lit(1)).alias("n"))
    return once.groupBy(*KEY).agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("n"), F.max("doc_id").alias("holder"))


def _batch(doc_id: Column, cuts: list[int]) -> Column:
    """0 for the largest ids; nulls in the last batch."""
    if not cuts:
        return F.lit(0)
    below = F.size(F.filter(F.array(*[F.lit(c).cast("long") for c in cuts]), lambda c: doc_id < c))
    return F.when(doc_id.isNull(), F.lit(len(cuts))).otherwise(below)


def deduped(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, batches: int = BATCHES,
            fanout: int = FANOUT) -> DataFrame:
    """doc_id, text (kept lines), n_lines, n_dropped, kept_sha256: one row per
    row of `docs` (doc_id, text)."""
    spark = docs.sparkSession
    cut_points = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), [i / batches for i in range(1, batches)], 1000)).first()[0]
    cuts = sorted(set(cut_points or []))
    path = scratch_path(spark, "line-pairs")
    (line_pairs(docs, min_chars).withColumn("batch", _batch(F.col("doc_id"), cuts))
        .write.option("compression", "zstd").partitionBy("batch").parquet(path))
    pairs = spark.read.schema("doc_id long, th long, h1 long, h2 long, batch int").parquet(path)
    rows = pairs.count()
    hits = None
    if rows:
        runs = LineRuns(spark, min(MAX_BUCKETS, max(8, -(-rows // BUCKET_ROWS))), fanout)
        for i in range(len(cuts) + 1):
            runs.add(batch_keys(pairs.where(F.col("batch") == i)))
        common = stored(runs.merged().where(F.col("docs") >= min_docs), "line-common")
        hits = spread_join(pairs.drop("batch"), common, KEY, "n").drop("n").where(
            ~F.col("doc_id").eqNullSafe(F.col("holder")))
        runs.forget()
    return _kept(_rows(docs), hits, min_chars)


def _kept(rows: DataFrame, hits: DataFrame | None, min_chars: int) -> DataFrame:
    """The texts without the lines of `hits` (doc_id, th, h1, h2)."""
    spark = rows.sparkSession
    out = "doc_id long, text string, n_lines long, n_dropped long, kept_sha256 string"

    def rebuild(batches):
        import numpy as np
        import pyarrow as pa
        for b in batches:
            texts, n_lines, n_dropped, digest = [], [], [], []
            drops = b.column(2).to_pylist() if b.num_columns > 2 else [None] * b.num_rows
            for text, drop in zip(text_bytes(b.column(1)), drops):
                lines = (text or b"").split(b"\n")
                kept = lines
                if drop:
                    gone = {np.array([d["h1"], d["h2"]], np.int64).tobytes() for d in drop}
                    kept = [x for x in lines if len(x) < min_chars or _hash(line_key(x)) not in gone]
                body = b"\n".join(kept)
                texts.append(body)
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(kept))
                digest.append(hashlib.sha256(body).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()),
                 pa.array(n_dropped, pa.int64()), pa.array(digest, pa.string())],
                ["doc_id", "text", "n_lines", "n_dropped", "kept_sha256"])

    if hits is None:
        return rows.select("doc_id", "text").mapInArrow(rebuild, out)
    # Every row of a text gives each of its keys once: count / keys = its rows.
    own = hits.groupBy("doc_id", "th").agg(F.collect_set(F.struct(*KEY)).alias("gone"), F.count(F.lit(1)).alias("n"))
    own = stored(own.withColumn("copies", (F.col("n") / F.size("gone")).cast("long")).drop("n"), "line-drops")
    total = own.agg(F.sum("copies")).first()[0] or 0
    # Rows with many equal copies, fewer than HOT: their number of salts travels, not their lines.
    hot = own.where(F.col("copies") * HOT > total).where("copies > 1000").select(
        "doc_id", "th", F.ceil(F.col("copies") / 1000).cast("int").alias("salts"))
    hot = F.broadcast(hot.select(F.col("doc_id").alias("__id"), F.col("th").alias("__th"), "salts"))
    salts = F.coalesce(F.col("salts"), F.lit(1))

    def spread(df: DataFrame, salt: Column) -> DataFrame:
        same = df["doc_id"].eqNullSafe(hot["__id"]) & (df["th"] == hot["__th"])
        return df.join(hot, same, "left").withColumn("salt", salt).drop("__id", "__th", "salts")

    left = spread(rows, F.pmod(F.xxhash64(F.monotonically_increasing_id()), salts).cast("int"))
    right = spread(own.drop("copies"), F.explode(F.sequence(F.lit(0), salts - 1))).select(
        F.col("doc_id").alias("__id"), F.col("th").alias("__th"), F.col("salt").alias("__salt"), "gone")
    same = left["doc_id"].eqNullSafe(right["__id"]) & (left["th"] == right["__th"]) & (left["salt"] == right["__salt"])
    return left.join(right, same, "left").select("doc_id", "text", "gone").mapInArrow(rebuild, out)


def op13_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of at least 40 code points in at least 5 documents stay only in
    the largest doc_id that holds them."""
    return deduped(table(spark, sf_dir, "documents")).select("doc_id", "n_lines", "n_dropped", "kept_sha256")


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, max(doc_id) AS holder FROM k WHERE length(key) >= 40 GROUP BY key
      HAVING count(DISTINCT doc_id) + max(CASE WHEN doc_id IS NULL THEN 1 ELSE 0 END) >= 5),
m AS (SELECT k.r, k.doc_id, k.line, k.pos, c.key IS NOT NULL AND k.doc_id IS DISTINCT FROM c.holder AS gone
      FROM k LEFT JOIN c ON k.key = c.key)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY r
"""
