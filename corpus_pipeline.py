"""The training-corpus pipeline: stages applied one after the other, each to
all that the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet in the cluster's shared folder and read again as the next one's
docs. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barkeep.llm import bpe, mixing, neardup, secrets
from barkeep.llm import toxicity as tox
from barkeep.llm.common import stored, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the factorization machine scores 0.5 or more go; a null
    or empty text has no term and stays."""
    machine = tox.fit(docs, table(spark, sf_dir, "labels"))
    return tox.scored(docs, machine, docs.columns, out="__score").where(F.col("__score") < 0.5).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five words, 0.8),
    the one with the least id. What is decided is a text of an id: rows that
    share an id but not the text are documents of their own (all but one of
    such an id count as larger than every id), of equal rows one stays.
    Documents without shingles or without an id stay, repeated ones too; an
    empty table gives none; texts of any length are compared whole, and columns
    of any name pass through."""
    own = F.xxhash64("text")

    def few(frame: DataFrame, name: str) -> DataFrame:
        """Broadcast behind a check of their number."""
        frame = stored(frame, name)
        return F.broadcast(frame) if frame.count() <= neardup.FEW_IDS else frame

    rows = docs.select(F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("id"), own.alias("hash"), "text")
    several = rows.where("id is not null").groupBy("id").agg(F.min("hash").alias("first"), F.max("hash").alias("last"))
    several = few(several.where(F.col("first") < F.col("last")).select("id", "first"), "pipeline-shared")
    rows = rows.join(several, "id", "left")
    other = F.col("first").isNotNull() & (F.col("first") != F.col("hash"))
    late = F.xxhash64("id", "hash").bitwiseAND(F.lit((1 << 62) - 1)).bitwiseOR(F.lit(1 << 62))
    rows = rows.withColumn("key", F.when(other, late).otherwise(F.col("id")))
    found = stored(neardup.near_duplicates(rows.select(F.col("key").alias("doc_id"), "text")), "pipeline-groups").where("doc_id is not null")
    gone = few(found.where(~F.col("kept")).select(F.col("doc_id").alias("key")).distinct(), "pipeline-gone")
    again = found.where("kept").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    again = few(again.select(F.col("doc_id").alias("key")), "pipeline-again")
    left = rows.select("doc", "key").join(gone, "key", "left_anti")
    # Rows of one key are equal in id and text, or have no shingles.
    order = F.row_number().over(Window.partitionBy("key").orderBy("doc.text"))
    once = left.join(again, "key", "left_semi").withColumn("row", order).where("row = 1")
    return left.join(again, "key", "left_anti").select("doc.*").unionByName(once.select("doc.*"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret span is replaced by a mark; other texts stay as they are,
    null and empty ones too. Repeated rows are treated alike; an empty table
    gives none; columns of any name pass through."""
    found = secrets.scanned(docs.select(F.struct(*docs.columns).alias("doc"), "text"))
    out = found.withColumn("new", secrets.redacted(F.col("text"), F.col("__spans"))).withColumn("found", F.size("__spans") > 0)
    columns = {"text": F.col("new")}
    if "n_chars" in docs.columns:
        columns["n_chars"] = F.when(F.col("found"), F.length("new").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("doc.n_chars"))
    return out.select(*[columns.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: none to three times. A null
    text and one without words are taken by no mix; repeated rows count each."""
    out = mixing.mixed(docs).select("doc", F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))))
    return out.select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of what is left: a row per row, null texts as
    empty ones; an empty table gives none."""
    return bpe.encoded(docs)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("secrets", secret_scan),
    ("mixing", mix),
    ("bpe", encode),
]

#: The models and the sketches cannot be written as SQL; tests/llm holds each
#: stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; the last one's rows."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, "pipeline-" + name)
    return docs
