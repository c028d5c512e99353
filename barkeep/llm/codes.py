"""Vector code compression: product codes whose nearest codebook entry is
found through a GNAT over the entries.

A GNAT node keeps a few split points and, for each pair (split, child), the
range of distances from the split to the child's entries. A query measures its
distance to the splits; a child whose range lies strictly beyond the best
distance so far, by the triangle inequality from any split, goes with its
whole subtree. Ranges and radius are rounded outwards, so rounding never drops
an entry; what is left is compared by exact integer squared distances, ties to
the lower index. The child of the nearest split is searched first, which makes
the radius small before the others are tested.

Codebooks are trained by rounds over the whole table: a task assigns its rows
and adds up integer sums and counts per (part, entry, place); Spark adds the
tasks' sums; the driver holds one codebook (ENTRIES x width integers).

Edge cases: vectors that are null or hold null or non-finite components are
dropped; vectors of other lengths than the longest count as ending in zeros,
and zeros fill it up to a multiple of PARTS; integers beyond the width's bound
(2^27 at 64 places) are set to it, so that sums of squares fit a long; the
start entries are the smallest distinct vec_ids, a repeated id standing for
its least vector and a null id for the last; fewer than ENTRIES ids make a
smaller codebook, none at all an empty result; equal entries are allowed, the
lower index wins; every row is coded, repeated rows and ids too; labels are
compared null-safe; further columns are ignored.
"""

from __future__ import annotations

import hashlib
from math import isqrt

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barkeep.llm.common import spread_join, stored, table

PARTS, ENTRIES, ROUNDS = 16, 64, 2
SPLITS, LEAF, ROWS = 6, 6, 4096
#: Outward rounding of distances: far above the error of a square root.
EPS = 1e-9
_FAR = np.iinfo(np.int64).max


def _squared(x: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows of x to rows of p."""
    out = np.zeros((len(x), len(p)), np.int64)
    for k in range(x.shape[1]):
        t = x[:, k, None] - p[None, :, k]
        out += t * t
    return out


class Gnat:
    """Geometric near-neighbour access tree over integer points."""

    def __init__(self, points: np.ndarray, ids: np.ndarray | None = None):
        ids = np.arange(len(points)) if ids is None else ids
        self.children: list[Gnat | None] = []
        if len(ids) <= LEAF:
            self.ids, self.points = ids, points[ids]
            return
        # Split points far from each other, the first entry to begin with.
        at, near = [0], _squared(points[ids], points[ids[:1]])[:, 0]
        while len(at) < SPLITS:
            far = int(np.argmax(near))
            if near[far] == 0:
                break
            at.append(far)
            near = np.minimum(near, _squared(points[ids], points[ids[far:far + 1]])[:, 0])
        at = sorted(at)
        self.ids, self.points = ids[at], points[ids[at]]
        rest = np.delete(ids, at)
        d = np.sqrt(_squared(points[rest], self.points).astype(np.float64))
        own = np.argmin(d, 1)
        self.low, self.high = np.zeros((len(at), len(at))), np.zeros((len(at), len(at)))
        for j in range(len(at)):
            mine = own == j
            self.children.append(Gnat(points, rest[mine]) if mine.any() else None)
            if mine.any():
                self.low[:, j], self.high[:, j] = d[mine].min(0) * (1 - EPS), d[mine].max(0) * (1 + EPS)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index of the nearest point, squared distance) for each row of x."""
        best, at = np.full(len(x), _FAR), np.zeros(len(x), np.int64)
        for lo in range(0, len(x), ROWS):
            rows = np.arange(lo, min(lo + ROWS, len(x)))
            self._visit(x, rows, best, at)
        return at, best

    def _visit(self, x: np.ndarray, rows: np.ndarray, best: np.ndarray, at: np.ndarray) -> None:
        d2 = _squared(x[rows], self.points)
        one = np.argmin(d2, 1)  # ids ascend: the first is the lowest
        found, names = d2[np.arange(len(rows)), one], self.ids[one]
        better = (found < best[rows]) | ((found == best[rows]) & (names < at[rows]))
        best[rows[better]], at[rows[better]] = found[better], names[better]
        if not self.children:
            return
        d = np.sqrt(d2.astype(np.float64))
        for first in (True, False):
            for j, child in enumerate(self.children):
                if child is None:
                    continue
                r = np.sqrt(best[rows].astype(np.float64))[:, None] * (1 + EPS)
                out = (d * (1 - EPS) - r > self.high[:, j]) | (d * (1 + EPS) + r < self.low[:, j])
                take = ((one == j) == first) & ~out.any(1)
                if take.any():
                    child._visit(x, rows[take], best, at)


def integers(rows: DataFrame) -> DataFrame:
    """vec_id, label, x: the kept rows with floor(256 * component)."""
    v = F.col("embedding").cast("array<double>")
    kept = rows.select(F.col("vec_id").cast("long").alias("vec_id"),
                       (F.col("label") if "label" in rows.columns else F.lit(None).cast("int")).alias("label"),
                       v.alias("v")).where(
        F.col("v").isNotNull() & F.forall("v", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))))
    return kept.select("vec_id", "label", F.transform("v", lambda e: F.floor(e * 256)).alias("x"))


def _bound(width: int) -> int:
    """Largest |x| whose squared distances over `width` places fit a long."""
    return min((1 << 30) - 1, isqrt((1 << 62) // max(width, 1)) // 2)


def matrix(column, width: int) -> np.ndarray:
    """Rows of an Arrow list column as int64, filled up with zeros."""
    n = len(column)
    sizes = np.diff(column.offsets.to_numpy()) if n else np.zeros(0, np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    if n and (sizes == width).all():
        return flat.reshape(n, width)
    out = np.zeros((n, width), np.int64)
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    return out


def _coder(books: np.ndarray):
    """x -> (codes, squared distances), one column per part."""
    trees = [Gnat(b) for b in books]
    step = books.shape[2]

    def code(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        got = [t.nearest(x[:, p * step:(p + 1) * step]) for p, t in enumerate(trees)]
        return np.stack([g[0] for g in got], 1), np.stack([g[1] for g in got], 1)

    return code


def start(kept: DataFrame, width: int, entries: int, parts: int) -> np.ndarray:
    """Parts x entries x width / parts: the smallest vec_ids, ascending."""
    first = kept.select("vec_id").distinct().orderBy(F.col("vec_id").asc_nulls_last()).limit(entries)
    ids = [r[0] for r in first.collect()]
    some = [i for i in ids if i is not None]
    take = F.col("vec_id") <= some[-1] if some else F.lit(False)
    if len(some) < len(ids):
        take = take | F.col("vec_id").isNull()
    found = {r["vec_id"]: r["x"] for r in kept.where(take).groupBy("vec_id").agg(F.min("x").alias("x")).collect()}
    full = np.zeros((len(ids), width), np.int64)
    for i, name in enumerate(ids):
        full[i, :len(found[name])] = found[name]
    return np.ascontiguousarray(full.reshape(len(ids), parts, width // parts).transpose(1, 0, 2))


def updated(kept: DataFrame, books: np.ndarray) -> np.ndarray:
    """One round: every part to its nearest entry, entries to the floored
    means of their parts."""
    parts, entries, step = books.shape
    width = parts * step
    shared = kept.sparkSession.sparkContext.broadcast(books)  # entries x width integers

    def sums(batches):
        import pyarrow as pa
        total = np.zeros((parts, entries, step + 1), np.int64)
        code = _coder(shared.value)
        for b in batches:
            x = matrix(b.column(0), width)
            if not len(x):
                continue
            at = code(x)[0]
            for p in range(parts):
                own = np.ones((len(x), step + 1), np.int64)
                own[:, 1:] = x[:, p * step:(p + 1) * step]
                np.add.at(total[p], at[:, p], own)
        p, e = np.nonzero(total[:, :, 0])
        yield pa.RecordBatch.from_arrays([pa.array(p.astype(np.int32)), pa.array(e.astype(np.int32)),
                                          pa.array(list(total[p, e]), pa.list_(pa.int64()))], ["part", "entry", "sums"])

    # Sums of places outgrow a long only beyond 10^10 rows at the bound: added as decimals.
    added = (kept.select("x").mapInArrow(sums, "part int, entry int, sums array<long>")
             .select("part", "entry", F.posexplode("sums").alias("place", "value"))
             .groupBy("part", "entry", "place").agg(F.sum(F.col("value").cast("decimal(20,0)")).alias("value")))
    total: dict = {(r[0], r[1], r[2]): int(r[3]) for r in added.collect()}  # entries x (width + parts) rows
    new = books.copy()
    for p in range(parts):
        for e in range(entries):
            n = total.get((p, e, 0), 0)
            if n:
                new[p, e] = [total[p, e, k + 1] // n for k in range(step)]
    return new


def compressed(rows: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, error of every kept row; the codebooks)."""
    good = integers(rows)
    width = parts * -(-(good.agg(F.max(F.size("x"))).first()[0] or 0) // parts)
    top = _bound(width)
    clipped = F.transform("x", lambda e: F.greatest(F.least(e, F.lit(top)), F.lit(-top)).cast("int"))
    kept = stored(good.withColumn("x", clipped), "codes-rows")
    books = start(kept, width, entries, parts)
    schema = kept.select("vec_id", "label").schema.add("code", "string").add("error", "long")
    if not books.shape[1]:
        return rows.sparkSession.createDataFrame([], schema), books
    for _ in range(rounds):
        books = updated(kept, books)
    shared = rows.sparkSession.sparkContext.broadcast(books)

    def encode(batches):
        import pyarrow as pa
        code = _coder(shared.value)
        for b in batches:
            at, d2 = code(matrix(b.column(2), width))
            text = [r.tobytes().hex() for r in at.astype(np.uint8)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(text, pa.string()), pa.array(d2.sum(1))],
                                             ["vec_id", "label", "code", "error"])

    return kept.mapInArrow(encode, schema), books


def decoded(code: str, books: np.ndarray) -> np.ndarray:
    """The integer vector a code stands for."""
    return np.concatenate([books[p, e] for p, e in enumerate(bytes.fromhex(code))])


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(str(v) for v in books.ravel().tolist()).encode()).hexdigest()


def op11_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all embeddings: 16 parts, 64 entries, two rounds."""
    found, books = compressed(table(spark, sf_dir, "embeddings"))
    found = stored(found, "codes")
    by_label = stored(found.groupBy("label").agg(F.sum("error").alias("label_error"), F.count(F.lit(1)).alias("n")), "codes-labels")
    return spread_join(found, by_label, ["label"], "n").select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def _op11_sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> str:
    """Assignment as a join of all parts with all entries, per round."""
    sql = """
WITH v AS (SELECT vec_id, label, list_transform(embedding, lambda e: floor(256 * e::DOUBLE)::BIGINT) AS x FROM embeddings
           WHERE embedding IS NOT NULL
             AND coalesce(list_bool_and(list_transform(embedding, lambda e: e IS NOT NULL AND isfinite(e))), true)),
w AS (SELECT {p} * ceil(max(len(x)) / {p}.0)::BIGINT AS width FROM v),
r AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_resize(x, width, 0) AS x, width // {p} AS step FROM v, w),
s AS MATERIALIZED (SELECT r, part, x[part * step + 1 : (part + 1) * step] AS y FROM r, (SELECT unnest(range({p})) AS part)),
f AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS entry, min(x) AS x, any_value(step) AS step FROM r
      GROUP BY vec_id QUALIFY entry < {e}),
b0 AS MATERIALIZED (SELECT part, entry, x[part * step + 1 : (part + 1) * step] AS y FROM f, (SELECT unnest(range({p})) AS part)),
""".format(p=parts, e=entries)
    for i in range(rounds + 1):
        sql += """
d{i} AS (SELECT r, s.part, entry, list_sum(list_transform(list_zip(s.y, b.y), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d2
         FROM s JOIN b{i} AS b ON s.part = b.part),
a{i} AS MATERIALIZED (SELECT r, part, arg_min(entry, (d2, entry)) AS entry, min(d2) AS d2 FROM d{i} GROUP BY r, part),
""".format(i=i)
        if i < rounds:
            sql += """
u{i} AS (SELECT a.part, a.entry, pos, sum(s.y[pos])::HUGEINT AS t, count(*)::HUGEINT AS n
         FROM a{i} AS a JOIN s ON a.r = s.r AND a.part = s.part, (SELECT unnest(range(1, (SELECT max(step) FROM r) + 1)) AS pos)
         GROUP BY a.part, a.entry, pos),
m{i} AS (SELECT part, entry, list(((t - (t % n + n) % n) // n)::BIGINT ORDER BY pos) AS y FROM u{i} GROUP BY part, entry),
b{j} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.y, b.y) AS y FROM b{i} AS b LEFT JOIN m{i} AS m ON b.part = m.part AND b.entry = m.entry),
""".format(i=i, j=i + 1)
    return sql + """
h AS (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{n}),
c AS (SELECT r, string_agg(printf('%02x', entry::INTEGER), '' ORDER BY part) AS code, sum(d2)::BIGINT AS error FROM a{n} GROUP BY r)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM r JOIN c ON r.r = c.r, h
""".format(n=rounds)


OP11_SQL = _op11_sql()
