"""Toxicity: a factorization machine over hashed terms.

Terms are words (ASCII punctuation removed, A-Z lower-cased) and their first
four and five bytes, which catch inflected forms, hashed to 2^30 places; a
text's features are the set of its terms. The machine adds a bias,
a weight per term and, for every pair of terms, the inner product of their
factor vectors, so that a combination (an insult with a group's name) can
weigh more than its parts.

Edge cases: a null or empty text has no feature and gets the bias alone; very
long texts count whole; repeated rows are scored alike; an empty table gives no
rows; without labelled rows, or with one class only, the score is the smoothed share of toxic labels; conflicting labels of
one id count as toxic; further columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from barkeep.llm.common import SEGMENT, give_back, hash_words, id_fold, sampled, stored, text_groups

#: At most about this many labelled rows are fitted (seeded hash of the id),
#: and of these (seeded hash of the terms) about as many as hold this many
#: terms together: few very long texts, or many texts of one id, cost no more.
FIT_ROWS, FIT_TERMS = 12_000, 1 << 24
#: A term is a feature if this many fitted texts hold it and its share among
#: toxic texts differs from that among others by this many standard errors,
#: or if a pair it makes with any other term tells by more (a pair can tell
#: what neither of its terms does, or turn what one of them does). A pair
#: counts from PAIR_TEXTS fitted texts on; PAIR_TASKS share the counting.
MIN_TEXTS, MIN_Z = 4, 3.0
PAIR_TEXTS, MIN_PAIR_Z, PAIR_TASKS = 10, 7.0, 24
PREFIXES = (4, 5)
FACTORS, EPOCHS, STEPS, RATE, DECAY = 4, 60, 1400, 0.05, 5e-4

#: ASCII other than letters and digits separates terms.
_TERMS = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


@dataclass
class Machine:
    terms: np.ndarray    # sorted term hashes
    bias: float
    weight: np.ndarray   # per term
    factor: np.ndarray   # per term, FACTORS wide

    def scores(self, doc: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        """Scores of n texts from their (text, feature index) pairs."""
        line = np.bincount(doc, self.weight[term], n) + self.bias
        for f in range(self.factor.shape[1]):
            v = self.factor[term, f]
            line += 0.5 * (np.bincount(doc, v, n) ** 2 - np.bincount(doc, v * v, n))
        return 1.0 / (1.0 + np.exp(-np.clip(line, -40, 40)))


def term_sets(texts: list[bytes | None], known: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text, term) pairs of a batch, ordered by text. `known` marks
    the low 20 bits of the terms that matter: others are left out early."""
    h, counts = hash_words(texts, _TERMS, PREFIXES)
    term = h >> np.uint64(34)
    doc = np.broadcast_to(np.repeat(np.arange(len(texts), dtype=np.uint64), counts), term.shape)
    on = h != 0
    if known is not None:
        on &= known[(term & np.uint64((1 << 20) - 1)).astype(np.int64)]
    pairs = np.unique((doc[on] << np.uint64(30)) | term[on])
    return (pairs >> np.uint64(30)).astype(np.int64), (pairs & np.uint64((1 << 30) - 1)).astype(np.int64)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, held: int = 0,
        rows: int = FIT_ROWS, seed: int = 7) -> Machine:
    """Fits on labelled texts outside the held fold, about `rows` of them at
    most. Terms and pairs are counted by Spark; the driver gets the terms that
    enough fitted texts hold and what the sample's texts hold of them."""
    known = (labels.select("doc_id", F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1)
                    & (id_fold(F.col("doc_id"), folds) != held))
             .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    chosen = known.where(sampled(F.col("doc_id"), known.count(), rows, seed))

    def features(batches):
        import pyarrow as pa
        for b in batches:
            for lo, hi, texts in text_groups(b.column(1), SEGMENT // 2):
                doc, term = term_sets(texts)
                cut = np.searchsorted(doc, np.arange(hi - lo + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(lo, hi - lo), pa.ListArray.from_arrays(
                    pa.array(cut), pa.array(term.astype(np.int32)))], ["toxic", "terms"])
            give_back()

    # `chosen` holds about `rows` ids at most: that bound allows the broadcast.
    sample = stored(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")
                    .mapInArrow(features, "toxic int, terms array<int>").distinct(), "toxicity-sample")
    held_all = sample.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    sample = sample.where(sampled(F.col("terms"), held_all, FIT_TERMS, seed))
    n, toxic = sample.agg(F.count("*"), F.coalesce(F.sum("toxic"), F.lit(0))).first()
    if not 0 < toxic < n:
        return constant(n, toxic)
    counts = stored(sample.select("toxic", F.explode("terms").alias("term")).groupBy("term").agg(
        F.count("*").alias("df"), F.sum("toxic").alias("hit")).where(F.col("df") >= MIN_TEXTS), "toxicity-terms")
    p1, p0 = (F.col("hit") + 0.5) / (toxic + 1), (F.col("df") - F.col("hit") + 0.5) / (n - toxic + 1)
    z = F.abs(p1 - p0) / F.sqrt(p1 * (1 - p1) / toxic + p0 * (1 - p0) / (n - toxic))
    telling = [r["term"] for r in counts.where(z >= MIN_Z).select("term").collect()]  # fewer than FIT_TERMS / MIN_TEXTS
    pool = counts.where(F.col("df") >= PAIR_TEXTS).select("term").toArrow().column(0).to_numpy()
    terms = np.union1d(pool, np.array(telling, np.int64)).astype(np.int64)

    def held_terms(batches):
        import pyarrow as pa
        for b in batches:
            sets = []
            for s in b.column(1):
                at = np.searchsorted(terms, own := s.values.to_numpy())
                at[at == len(terms)] = 0
                sets.append(at[terms[at] == own].astype(np.int32).tobytes() if len(terms) else b"")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sets, pa.binary())], ["toxic", "terms"])
        give_back()

    got = sorted((r["toxic"], bytes(r["terms"])) for r in sample.mapInArrow(held_terms, "toxic int, terms binary").collect())
    y = np.array([r[0] for r in got], float)
    term = np.frombuffer(b"".join([r[1] for r in got]), np.int32)
    cut = np.cumsum([0] + [len(r[1]) // 4 for r in got])
    del got
    alone = np.isin(terms, telling)
    keep = np.union1d(np.flatnonzero(alone), paired(docs.sparkSession, term, cut, int(n - toxic), alone)).astype(np.int64)
    return train(terms, keep, term, cut, y, seed)


def constant(n: int, toxic: int) -> Machine:
    """No feature: the smoothed share of toxic labels."""
    rate = (toxic + 0.5) / (n + 10.0)
    return Machine(np.zeros(0, np.int64), float(np.log(rate / (1 - rate))), np.zeros(0), np.zeros((0, FACTORS)))


def train(terms: np.ndarray, keep: np.ndarray, term: np.ndarray, cut: np.ndarray, y: np.ndarray, seed: int = 7) -> Machine:
    """Logistic loss, Adam, mini-batches in a seeded order: EPOCHS rounds, more
    where these make fewer than STEPS steps. Text i holds the places
    term[cut[i]:cut[i + 1]] in `terms`; `keep` has those of the features."""
    n, toxic = len(y), float(y.sum())
    none = constant(n, int(toxic))
    if not len(keep):
        return none
    place = np.full(len(terms), -1)
    place[keep] = np.arange(len(keep))
    on = np.flatnonzero(place[term] >= 0)
    doc, term = np.searchsorted(cut, on, "right") - 1, place[term[on]]
    rng = np.random.default_rng(seed)
    k = len(keep)
    value = np.concatenate([[none.bias], np.zeros(k), rng.normal(0, 0.05, k * FACTORS)])
    m, v, step = np.zeros_like(value), np.zeros_like(value), 0
    cut = np.searchsorted(doc, np.arange(n + 1))
    for _ in range(max(EPOCHS, -(-STEPS // -(-n // 512)))):
        shuffled = rng.permutation(n)
        for lo in range(0, n, 512):
            rows = shuffled[lo:lo + 512]
            size = cut[rows + 1] - cut[rows]
            d = np.repeat(np.arange(len(rows)), size)
            t = term[np.repeat(cut[rows] - np.cumsum(size) + size, size) + np.arange(size.sum())]
            w, f = value[1:k + 1], value[k + 1:].reshape(k, FACTORS)
            total = np.stack([np.bincount(d, f[t, j], len(rows)) for j in range(FACTORS)], 1)
            line = value[0] + np.bincount(d, w[t], len(rows)) + 0.5 * (
                (total ** 2).sum(1) - np.bincount(d, (f[t] ** 2).sum(1), len(rows)))
            g = (1 / (1 + np.exp(-np.clip(line, -40, 40))) - y[rows]) / len(rows)
            gw = np.bincount(t, g[d], k)
            gf = np.stack([np.bincount(t, g[d] * (total[d, j] - f[t, j]), k) for j in range(FACTORS)], 1)
            grad = np.concatenate([[g.sum()], gw + DECAY / 20 * w, (gf + DECAY * f).ravel()])
            step += 1
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad * grad
            value = value - RATE * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return Machine(terms[keep], float(value[0]), value[1:k + 1], value[k + 1:].reshape(k, FACTORS))


def _gap(one, all_, toxic: int, n: int):
    """By how many standard errors the share among toxic texts differs."""
    p1, p0 = (one + 0.5) / (toxic + 1), (all_ - one + 0.5) / (n - toxic + 1)
    return np.abs(p1 - p0) / np.sqrt(p1 * (1 - p1) / toxic + p0 * (1 - p0) / (n - toxic))


def paired(spark, term: np.ndarray, cut: np.ndarray, clean: int, telling: np.ndarray) -> np.ndarray:
    """Those of the other terms in pairs that tell: two of them, if the pair's
    share differs between the classes by far more than that of either; one
    beside a telling term, if texts with that term are toxic more or less often
    with it than without. Every pair is counted that can reach MIN_PAIR_Z. The
    first `clean` texts are the others', the rest toxic; the sample is sent to
    PAIR_TASKS tasks, which share the terms."""
    n, toxic, size = len(cut) - 1, len(cut) - 1 - clean, len(telling)
    df = np.bincount(term, minlength=size)
    hit = np.bincount(term[cut[clean]:], minlength=size)
    alone = _gap(hit, df, toxic, n)
    # Below `least` texts a pair of either class alone stays under MIN_PAIR_Z.
    m = np.arange(n + 1)
    enough = (_gap(np.minimum(m, toxic), m, toxic, n) >= MIN_PAIR_Z) | (_gap(np.maximum(m - clean, 0), m, toxic, n) >= MIN_PAIR_Z)
    least = max(PAIR_TEXTS, int(np.argmax(enough)) if enough.any() else n + 1)
    first = telling & (df >= PAIR_TEXTS) | ~telling & (df >= least)
    shared = spark.sparkContext.broadcast((term, cut))

    def count(batches):
        import pyarrow as pa
        held, cuts = shared.value
        for b in batches:
            for task in b.column(0).to_pylist():
                at = np.flatnonzero((held % PAIR_TASKS == task) & first[held])
                at = at[np.argsort(held[at], kind="stable")]
                doc, own = np.searchsorted(cuts, at, "right") - 1, held[at]
                ends = np.flatnonzero(np.concatenate([own[1:] != own[:-1], [True]])) + 1 if len(own) else []
                found, lo = np.zeros(size, bool), 0
                for hi in ends:
                    a, in_clean = own[lo], lo + np.searchsorted(doc[lo:hi], clean)
                    zero, one = (np.bincount(np.concatenate([held[cuts[d]:cuts[d + 1]] for d in part]), minlength=size)
                                 if len(part) else np.zeros(size, np.int64) for part in (doc[lo:in_clean], doc[in_clean:hi]))
                    all_ = zero + one
                    lo = hi
                    if telling[a]:
                        c = np.flatnonzero((all_ >= PAIR_TEXTS) & (all_ < df[a]) & ~telling)
                        rate, rest = (hit[a] + 0.5) / (df[a] + 1), df[a] - all_[c]
                        gap = np.abs(one[c] / all_[c] - (hit[a] - one[c]) / rest)
                        found[c[gap >= MIN_PAIR_Z * np.sqrt(rate * (1 - rate) * (1 / all_[c] + 1 / rest))]] = True
                    else:
                        all_[a] = 0
                        c = np.flatnonzero((all_ >= least) & ~telling)
                        z = _gap(one[c], all_[c], toxic, n)
                        c = c[(z >= MIN_PAIR_Z) & (z >= 2 * np.maximum(alone[a], alone[c]))]
                        found[c] = True
                        found[a] |= len(c) > 0
                yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(found))], ["place"])
                del at, doc, own, found
                give_back()

    tasks = spark.range(0, PAIR_TASKS, 1, PAIR_TASKS)
    return tasks.mapInArrow(count, "place long").distinct().toArrow().column(0).to_numpy()


def scored(docs: DataFrame, machine: Machine, keep: list[str], text: str = "text", out: str = "score") -> DataFrame:
    """The columns `keep` and the score as `out`, one row per input row. A text
    that is among `keep` goes to the tasks once."""
    model = docs.sparkSession.sparkContext.broadcast(machine)
    schema = docs.select(*keep).schema.add(out, "double")
    kept = text in keep and docs.schema[text].dataType == StringType()
    place = keep.index(text) if kept else len(keep)

    def run(batches):
        import pyarrow as pa
        fm = model.value
        known = np.zeros(1 << 20, bool)
        known[fm.terms & ((1 << 20) - 1)] = True
        for b in batches:
            score = np.zeros(b.num_rows)
            for lo, hi, texts in text_groups(b.column(place), SEGMENT // 2):
                doc, term = term_sets(texts, known)
                at = np.searchsorted(fm.terms, term)
                at[at == len(fm.terms)] = 0
                on = fm.terms[at] == term if len(fm.terms) else np.zeros(len(term), bool)
                score[lo:hi] = fm.scores(doc[on], at[on], hi - lo)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keep))), pa.array(score)],
                                             [*b.schema.names[:len(keep)], out])
            give_back()

    sent = [] if kept else [F.col(text).cast("string").alias("__text")]
    return docs.select(*keep, *sent).mapInArrow(run, schema)


def op2_toxicity(spark, sf_dir: str) -> DataFrame:
    """Every document's toxicity score, from labels outside fold 0 of 5."""
    from barkeep.llm.common import table
    docs = table(spark, sf_dir, "documents")
    out = scored(docs, fit(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return out.select("doc_id", (id_fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))
