"""Language identification by nearest centroid.

A text's vector counts its byte trigrams (A-Z lower-cased, everything in
ASCII that is no letter as a space) in hashed bins, as (1 + ln count) * idf,
scaled to length 1. Each language has several centroids, clustered by cosine
k-means over its fitted texts; a text takes the language of the centroid with
the largest cosine. A cosine below the centroid's radius (a low quantile of
its own members' cosines) marks the text as rejected: far from all that was
learned.

Inverse document frequencies count all training texts; the centroids are
fitted on about FIT_ROWS texts per language (seeded hash of the id).

Edge cases: a null text or one without a letter is `und` with score 0, and so
is every text if nothing was learned; equal cosines go to the first language
by code point; repeated rows are judged alike; texts count whole at any
length; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barkeep.llm.common import SEGMENT, groups_of, id_fold, mix, text_bytes

BINS, CENTROIDS, FIT_ROWS, ROUNDS, RADIUS_QUANTILE = 4096, 4, 400, 12, 0.005
MANY_LANGS = 10_000
#: Fewer texts make no cluster of their own.
MEMBERS = 3
_LETTERS = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256))


def counts(texts: list[bytes | None]) -> np.ndarray:
    """Trigram counts per text (rows) and bin."""
    out = np.zeros((len(texts), BINS), np.float32)
    for lo, hi in groups_of([len(t or b"") for t in texts], SEGMENT):
        # Three spaces around each text: no trigram spans two of them.
        parts = [b"  " + (t or b"").lower().translate(_LETTERS) + b"  " for t in texts[lo:hi]]
        a = np.frombuffer(b"".join(parts), np.uint8).astype(np.uint32)
        if len(a) < 3:
            continue
        code = (a[:-2] << 16) | (a[1:-1] << 8) | a[2:]
        cut = np.cumsum([0] + [len(p) for p in parts])
        place = (mix(code.astype(np.uint64)) & np.uint64(BINS - 1)).astype(np.int64)
        place[code == 0x202020] = -1
        for i in range(hi - lo):
            own = place[cut[i]:max(cut[i], cut[i + 1] - 2)]
            out[lo + i] = np.bincount(own[own >= 0], minlength=BINS)
    return out


def vectors(texts: list[bytes | None], idf: np.ndarray) -> np.ndarray:
    v = counts(texts)
    np.log1p(v, out=v)  # ln(1 + count): 0 stays 0
    v *= idf
    v /= np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)
    return v


def has_letter(text: str | None) -> bool:
    return next(filter(str.isalpha, text or ""), None) is not None


@dataclass
class Model:
    langs: list[str]         # of each centroid
    idf: np.ndarray
    centroid: np.ndarray
    radius: np.ndarray


def fit(docs: DataFrame, seed: int = 5, rows: int = FIT_ROWS) -> Model:
    """Learns from `text` and `lang` of all rows given, nulls left out."""
    known = docs.select("doc_id", "lang", F.col("text").cast("string").alias("text")).where(
        F.col("lang").isNotNull() & F.col("text").isNotNull())

    def bins(batches):
        import pyarrow as pa
        df, n = np.zeros(BINS, np.int64), 0
        for b in batches:
            texts = text_bytes(b.column(0))
            for lo, hi in groups_of([len(t or b"") for t in texts], SEGMENT):
                df += (counts(texts[lo:hi]) > 0).sum(0)
                n += hi - lo
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array([-1, *at], pa.int32()), pa.array([n, *df[at]], pa.int64())], ["bin", "n"])

    # At most BINS + 1 rows come to the driver.
    df = {r["bin"]: r["n"] for r in known.select("text").mapInArrow(bins, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect()}
    n = df.pop(-1, 0) or 0
    idf = np.log((1 + n) / (1 + np.array([df.get(i, 0) for i in range(BINS)]))).astype(np.float32) + 0.1
    share = known.groupBy("lang").agg(F.count("*").alias("__rows"))
    if share.count() <= MANY_LANGS:  # the proven bound that allows the broadcast
        share = F.broadcast(share)
    chosen = known.join(share, "lang").where(
        F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(1 << 30)) * F.col("__rows") < F.lit(rows << 30))

    def vector(batches):
        import pyarrow as pa
        for b in batches:
            langs, texts = b.column(0).to_pylist(), text_bytes(b.column(1))
            for lo, hi in groups_of([len(t or b"") for t in texts], SEGMENT):
                v = vectors(texts[lo:hi], idf).astype(np.float16)
                yield pa.RecordBatch.from_arrays([pa.array(langs[lo:hi]), pa.array([x.tobytes() for x in v], pa.binary())], ["lang", "v"])

    # About `rows` vectors of BINS half floats per language.
    got = chosen.select("lang", "text").mapInArrow(vector, "lang string, v binary").collect()
    return cluster([(r["lang"], np.frombuffer(r["v"], np.float16)) for r in got], idf, seed)


def cluster(rows: list[tuple[str, np.ndarray]], idf: np.ndarray, seed: int) -> Model:
    """Cosine k-means per language: seeds drawn by their distance to those
    before, in a seeded order by content. The texts of a cluster of fewer than
    MEMBERS go to the nearest other one; every other cluster, however small a
    part of the language, gives a centroid."""
    langs, centroids, radius, rng = [], [], [], np.random.default_rng(seed)
    for lang in sorted({r[0] for r in rows}):
        x = np.stack(sorted((v for q, v in rows if q == lang), key=lambda v: v.tobytes())).astype(np.float32)
        c = x.mean(0, keepdims=True)
        while len(c) < min(CENTROIDS, len(np.unique(x, axis=0))):
            far = np.maximum(1 - (x @ c.T).max(1), 0) ** 2 + 1e-9
            c = np.concatenate([c, x[[rng.choice(len(x), p=far / far.sum())]]])
        for _ in range(ROUNDS):
            c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
            own = np.argmax(x @ c.T, 1)
            c = np.stack([x[own == k].mean(0) if (own == k).any() else c[k] for k in range(len(c))])
        size = np.bincount(np.argmax(x @ c.T, 1), minlength=len(c))
        c = c[size >= min(MEMBERS, size.max())]
        own = np.argmax(x @ c.T, 1)
        c = np.stack([x[own == k].mean(0) if (own == k).any() else c[k] for k in range(len(c))])
        c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
        near, own = (x @ c.T).max(1), np.argmax(x @ c.T, 1)
        for k in np.unique(own):
            langs.append(lang)
            centroids.append(c[k])
            radius.append(float(np.quantile(near[own == k], RADIUS_QUANTILE)))
    return Model(langs, idf, np.array(centroids, np.float32).reshape(-1, BINS), np.array(radius))


def predicted(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """One row per input row: `keep`, lang_pred, score (the cosine), rejected."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double").add("rejected", "boolean")

    def run(batches):
        import pyarrow as pa
        m = shared.value
        for b in batches:
            texts = text_bytes(b.column(b.num_columns - 1))
            lang, score, rejected = ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
            for lo, hi in groups_of([len(t or b"") for t in texts], SEGMENT):
                if not m.langs:
                    break
                near = vectors(texts[lo:hi], m.idf) @ m.centroid.T
                best = np.argmax(near, 1)
                for i, k in enumerate(best, lo):
                    if texts[i] and has_letter(texts[i].decode("utf-8", "replace")):
                        lang[i], score[i] = m.langs[k], min(1.0, max(0.0, float(near[i - lo, k])))
                        rejected[i] = score[i] < m.radius[k]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(i) for i in range(b.num_columns - 1)), pa.array(lang), pa.array(score), pa.array(rejected)], schema.names)

    return docs.select(*keep, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)


def op4_langid(spark, sf_dir: str) -> DataFrame:
    """Every document's language, learned from folds 1 to 4 of 5."""
    from barkeep.llm.common import table
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = id_fold(F.col("doc_id"), 5) == 0
    return predicted(docs, fit(docs.where(~held))).select("doc_id", held.alias("held_out"), "lang_pred", "score", "rejected")
