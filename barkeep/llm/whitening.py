"""Embedding whitening: leading eigenvectors of the covariance by
Chebyshev-filtered subspace iteration.

Vectors become integers and each distinct one counts once. They are packed once
into rows of some thousand vectors, which every pass reads. The covariance is
never formed: one pass multiplies it with a block Q of BLOCK directions,
centring every vector before multiplying (X'XQ, summed per task, then over at
most GROUPS groups of tasks; the driver adds those: width x BLOCK numbers each). A Chebyshev polynomial of
degree m, by its three-term recurrence, needs m such passes and damps the
eigenvalues of the unwanted interval [0, least Ritz value of the block]. Then
QR and a Rayleigh-Ritz step, until every wanted pair is certified by its
residual |Vq - eq|.

Edge cases: vectors that are null or hold null or non-finite entries are
dropped; shorter vectors count as ending in zeros; integers are held within
2^53; components whose eigenvalue is zero to rounding (fewer independent
vectors than components, one vector, equal vectors) are left out, so their
rows are; a deviation beyond a long is null; equal eigenvalues give any
orthonormal choice, the same for all rows; repeated rows and ids each get
their rows, null ids too; no vector at all gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barkeep.llm.codes import integers, matrix
from barkeep.llm.common import stored, table

COMPONENTS, BLOCK, GROUPS = 4, 48, 64
#: Bytes of vectors packed into one row.
PACK = 1 << 22
#: Residual of a certified pair, relative to the largest eigenvalue, and the
#: one below which a round that brings nothing more ends the iteration.
TIGHT, CERTIFIED, MAX_ROUNDS = 1e-13, 1e-11, 60
#: Damping asked of one filter, and its highest degree.
DAMPING, MAX_DEGREE = 1e4, 24
#: Eigenvalues below this share of the largest are rounding.
ZERO = 1e-12


@dataclass(frozen=True)
class Whitener:
    n: int
    sums: list[int]            # exact, per dimension
    vectors: np.ndarray        # width x components
    values: np.ndarray
    trace: float
    residual: float            # largest of the wanted pairs, relative
    passes: int

    def centred(self, x: np.ndarray) -> np.ndarray:
        return centred(x, self.n, self.sums)

    def project(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n, the numerator n * x - sums exact where it fits a long."""
    top = max(int(np.abs(x).max(initial=0)), 1)
    if n * top * 2 < 1 << 62:
        return (x * n - np.array(sums, np.int64)) / n
    whole = [s // n for s in sums]
    rest = np.array([(s % n) / n for s in sums])
    return (x - np.array(whole, np.int64)).astype(np.float64) - rest


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over dimensions of (n * x - sums)^2 per row, exact; None beyond a long."""
    top = n * max(int(np.abs(x).max(initial=0)), 1) + max((abs(s) for s in sums), default=0)
    if top * top * max(x.shape[1], 1) < 1 << 63:
        d = x * n - np.array(sums, np.int64)
        return (d * d).sum(1).tolist()
    exact = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x.tolist()]
    return [v if v < 1 << 63 else None for v in exact]


def vectors_of(rows: DataFrame) -> DataFrame:
    """vec_id, x of the kept rows."""
    held = F.transform("x", lambda e: F.greatest(F.least(e, F.lit(1 << 53)), F.lit(-(1 << 53))))
    return integers(rows).select("vec_id", held.alias("x"))


def fit_list(vectors: DataFrame) -> tuple[DataFrame, int]:
    """(the distinct rows of `vectors` packed into matrices, width), stored."""
    width = vectors.agg(F.max(F.size("x"))).first()[0] or 0

    def pack(batches):
        import pyarrow as pa
        step = max(1, PACK // (8 * max(width, 1)))
        for b in batches:
            x = matrix(b.column(0), width)
            for lo in range(0, len(x), step):
                part = x[lo:lo + step]
                top = int(np.abs(part).max(initial=0))
                kind = "<i2" if top < 1 << 15 else "<i4" if top < 1 << 31 else "<i8"
                yield pa.RecordBatch.from_arrays([pa.array([kind]), pa.array([part.astype(kind).tobytes()], pa.binary())], ["kind", "data"])

    packed = vectors.select("x").distinct().mapInArrow(pack, "kind string, data binary")
    return stored(packed, "whitening-fit"), width


def _matrices(batches, width: int):
    for b in batches:
        for kind, data in zip(b.column(0).to_pylist(), b.column(1)):
            yield np.frombuffer(data.as_buffer(), kind).reshape(-1, width)


def _summed(fit: DataFrame, width: int, fn, rows: int, columns: int) -> np.ndarray:
    """Sum over all packed matrices of the rows x columns matrix `fn` makes of
    one: per task, then per group of tasks, then here."""
    def task(batches):
        import pyarrow as pa
        total = np.zeros((rows, columns))
        for x in _matrices(batches, width):
            total += fn(x)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    def add(batches):
        import pyarrow as pa
        total = np.zeros((rows, columns))
        for b in batches:
            for m in b.column(0):
                total += np.frombuffer(m.as_buffer()).reshape(rows, columns)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], ["m"])

    parts = fit.mapInArrow(task, "m binary")
    groups = min(GROUPS, isqrt(fit.rdd.getNumPartitions()))
    out = np.zeros((rows, columns))
    for r in (parts.repartition(groups).mapInArrow(add, "m binary") if groups > 2 else parts).collect():
        out += np.frombuffer(r[0]).reshape(rows, columns)
    return out


def _moments(fit: DataFrame, width: int) -> tuple[int, list[int], float]:
    """n, exact sums, and the trace of the covariance."""
    def task(batches):
        import pyarrow as pa
        n, s, q = 0, [0] * width, [0] * width
        for x in _matrices(batches, width):
            n += len(x)
            wide = len(x) * int(np.abs(x.astype(np.int64)).max(initial=0)) ** 2 >= 1 << 62
            y = x.astype(object if wide else np.int64)
            s = [a + int(v) for a, v in zip(s, y.sum(0))]
            q = [a + int(v) for a, v in zip(q, (y * y).sum(0))]
        names = np.arange(width + 1, dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(names), pa.array([str(v) for v in [*s, n]]), pa.array([str(v) for v in [*q, n]])],
                                         ["i", "s", "q"])

    # Exact integers travel as text; a place's sums of all tasks meet as decimals.
    got = fit.mapInArrow(task, "i int, s string, q string").groupBy("i").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum(F.col("q").cast("decimal(38,0)")).alias("q")).collect()
    s, q = [0] * (width + 1), [0] * (width + 1)
    for r in got:
        s[r[0]], q[r[0]] = int(r[1]), int(r[2])
    n = s.pop()
    q.pop()
    trace = float(sum(n * b - a * a for a, b in zip(s, q))) / n / n if n else 0.0
    return n, s, trace


def fit_whitener(fit: DataFrame, width: int, components: int = COMPONENTS, block: int = BLOCK, seed: int = 12) -> Whitener:
    """Leading components of a packed fit list."""
    n, sums, trace = _moments(fit, width) if width else (0, [], 0.0)
    if not n or trace <= 0:
        return Whitener(n, sums, np.zeros((width, 0)), np.zeros(0), trace, 0.0, 0)
    passes, mean = 0, np.array([t / n for t in sums])

    def product(q: np.ndarray) -> np.ndarray:
        """V q: one pass, every vector centred before it is multiplied."""
        nonlocal passes
        passes += 1

        def fn(x):
            c = x - mean
            return c.T @ (c @ q)

        return _summed(fit, width, fn, width, q.shape[1]) / n

    k = min(width, block)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, k)))[0]
    last = np.inf
    for _ in range(MAX_ROUNDS):
        # Rayleigh-Ritz on the block; V q serves the filter too.
        vq = product(q)
        h = q.T @ vq
        e, u = np.linalg.eigh((h + h.T) / 2)
        e, u = e[::-1], u[:, ::-1]
        q, vq = q @ u, vq @ u
        m = min(components, k)
        residual = float(np.linalg.norm(vq[:, :m] - q[:, :m] * e[:m], axis=0).max() / e[0])
        if residual <= TIGHT or k == width or (residual <= CERTIFIED and residual > last / 2):
            break
        last = residual
        q = np.linalg.qr(_filtered(product, q, vq, float(e[0]), float(e[m - 1]), max(float(e[-1]), 0.0)))[0]
    else:
        raise ArithmeticError("whitening: residual %g after %d rounds" % (residual, MAX_ROUNDS))
    keep = [j for j in range(m) if e[j] > ZERO * e[0]]
    return Whitener(n, sums, q[:, keep], e[keep], trace, residual, passes)


def _filtered(product, q, vq, top: float, wanted: float, cut: float) -> np.ndarray:
    """The Chebyshev polynomial of the covariance that is small on [0, cut],
    applied to q (scaled at `top` so that nothing overflows)."""
    if cut <= ZERO * top:
        return vq  # the block spans the whole range already
    gain = np.arccosh(max(2 * wanted / cut - 1, 1 + 1e-9))
    degree = int(np.clip(np.ceil(np.arccosh(DAMPING) / gain), 2, MAX_DEGREE))
    mid = half = cut / 2
    first = scale = half / (top - mid)
    before, now = q, (vq - mid * q) * (scale / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - scale)
        now, before = 2 * (product(now) - mid * now) * (following / half) - scale * following * before, now
        scale = following
    return now


def identity_error(fit: DataFrame, width: int, w: Whitener) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus
    the identity."""
    m = len(w.values)
    if not m:
        return 0.0

    def fn(x):
        y = np.hstack([w.project(x.astype(np.int64)), np.ones((len(x), 1))])
        return y.T @ y

    s = _summed(fit, width, fn, m + 1, m + 1)
    mean = s[:m, m] / s[m, m]
    return float(np.abs(s[:m, :m] / s[m, m] - np.outer(mean, mean) - np.eye(m)).max())


def whitened(rows: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """A row per kept row of `rows` (vec_id, embedding) and component."""
    kept = stored(vectors_of(rows), "whitening-rows")
    fit, width = fit_list(kept)
    w = fit_whitener(fit, width, components)
    error = identity_error(fit, width, w)
    m = len(w.values)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    explained = w.values / w.trace if m else w.values

    def project(batches):
        import pyarrow as pa
        for b in batches:
            x = matrix(b.column(1), width)
            size = len(x) * m
            yield pa.RecordBatch.from_arrays([
                b.column(0).take(pa.array(np.repeat(np.arange(len(x)), m))),
                pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(x))),
                pa.array(np.full(size, w.n)),
                pa.array([v for v in deviations(x, w.n, w.sums) for _ in range(m)], pa.int64()),
                pa.array(w.project(x).ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(size, error))], names)

    if not m:
        return rows.sparkSession.createDataFrame([], schema)
    return kept.mapInArrow(project, schema)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four leading components of all embeddings, whitened."""
    return whitened(table(spark, sf_dir, "embeddings"))
