"""Helpers shared by the operators: table reads, tables written to the shared
folder, the hash folds of the contracts, and vectorised word hashing."""

from __future__ import annotations

import ctypes

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barkeep.session import scratch_path

#: Bytes of text handled at once inside a task: bounds the numpy work arrays.
SEGMENT = 1 << 20
WHITE = b"\x20\x09\x0a\x0b\x0c\x0d"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet("%s/%s.parquet" % (sf_dir.rstrip("/"), name))


def stored(df: DataFrame, name: str) -> DataFrame:
    """`df` written once as Parquet in the cluster's shared folder and read
    again: lineage ends there, so a lost executor costs no recomputation and
    row numbering made inside the table cannot change between reads."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as ''."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def sampled(id_col: Column, rows: int, bound: int, seed: int) -> Column:
    """A seeded condition that keeps about min(rows, bound) of `rows` rows."""
    if rows <= bound:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.lit(seed), id_col), F.lit(1 << 30)) < int((1 << 30) * bound / rows)


#: Keys that hold more than 1/HOT of all rows: there are fewer than HOT of them.
HOT = 4096


def spread_join(rows: DataFrame, keyed: DataFrame, on: list[str], weight: str) -> DataFrame:
    """Inner null-safe join of `rows` with `keyed` (one row per key, `weight`
    = how many of the rows have it). Keys of more than 1/HOT of all rows,
    fewer than HOT of them, are broadcast, so a hot key stays where its rows
    are; the rest, whose groups are small, is shuffled. `keyed` is read more
    than once: store it before."""
    total = keyed.agg(F.sum(weight)).first()[0] or 0
    side = keyed.select(*[F.col(c).alias("__key_" + c) for c in on], *[c for c in keyed.columns if c not in on])

    def same(other: DataFrame) -> Column:
        out = F.lit(True)
        for c in on:
            out = out & rows[c].eqNullSafe(other["__key_" + c])
        return out

    hot = F.broadcast(side.where(F.col(weight) * HOT > total))
    cold = side.where(F.col(weight) * HOT <= total)
    rest = rows.join(hot, same(hot), "left_anti")
    return (rows.join(hot, same(hot)).unionByName(rest.join(cold, same(cold)))
            .drop(*["__key_" + c for c in on]))


# --- vectorised hashing -------------------------------------------------

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_INV = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[list(WHITE)] = False
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _POWERS or len(_POWERS[0]) < n:
        size = max(n, SEGMENT)
        for base in (_BASE, _INV):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            _POWERS.append(np.cumprod(p, dtype=np.uint64))
        del _POWERS[:-2]
    return _POWERS[0][:n], _POWERS[1][:n]


def _segments(buf: bytes):
    """Cuts of at most SEGMENT bytes that never split a word (a longer single
    word is a segment of its own)."""
    pos, n = 0, len(buf)
    while pos < n:
        end = min(pos + SEGMENT, n)
        if end < n:
            cut = np.flatnonzero(~_IS_WORD[np.frombuffer(buf, np.uint8, end - pos, pos)])
            if len(cut):
                end = pos + int(cut[-1]) + 1
            else:
                after = [x for x in (buf.find(bytes([w]), end) for w in WHITE) if x >= 0]
                end = min(after, default=n - 1) + 1
        yield pos, end
        pos = end


def hash_words(texts: list[bytes | None], table: bytes | None = None,
               prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): the 64-bit hash of every word of every text in order,
    and the words per text. Words are runs of bytes other than 0x20 and
    0x09-0x0D with A-Z lower-cased; `table` (256 bytes) is applied first.
    With `prefixes`, hashes has further rows: of the first so many bytes of
    each word (0 for a word no longer than that). A null text has no words."""
    parts = [(t or b"").lower() for t in texts]
    buf = b" ".join(parts)
    if table is not None:
        buf = buf.translate(table)
    first = np.cumsum([0] + [len(p) + 1 for p in parts])
    hashes, begins = [], []
    for lo, hi in _segments(buf):
        a = np.frombuffer(buf, np.uint8, hi - lo, lo)
        edge = np.diff(np.concatenate([[False], _IS_WORD[a], [False]]).view(np.int8))
        s, e = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        up, down = _powers(len(a))
        c = np.zeros(len(a) + 1, np.uint64)
        np.cumsum(_BYTE[a] * down, out=c[1:])
        got = [mix((c[e] - c[s]) * up[s] + (e - s).astype(np.uint64))]
        for k in prefixes:
            part = mix((c[np.minimum(s + k, e)] - c[s]) * up[s] + np.uint64(k << 40))
            got.append(np.where(e - s > k, part, np.uint64(0)))
        hashes.append(np.stack(got) if prefixes else got[0])
        begins.append(s + lo)
    h = np.concatenate(hashes, -1) if hashes else np.zeros((1 + len(prefixes), 0) if prefixes else 0, np.uint64)
    b = np.concatenate(begins) if begins else np.zeros(0, np.int64)
    return h, np.diff(np.searchsorted(b, first))


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Hash of the ordered pair of two hashes."""
    return mix(a * np.uint64(_BASE) + (b ^ (b >> np.uint64(32))) * _M2 + np.uint64(1))


def groups_of(sizes: list[int], limit: int = 2 * SEGMENT):
    """(lo, hi) ranges of consecutive items whose sizes sum to about `limit`."""
    lo = total = 0
    for i, n in enumerate(sizes):
        if total and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def text_bytes(column) -> list[bytes | None]:
    """UTF-8 bytes of an Arrow string column, without decoding."""
    import pyarrow as pa
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist() if not pa.types.is_null(column.type) else [None] * len(column)


def text_groups(column, limit: int = 2 * SEGMENT):
    """(lo, hi, texts): ranges of consecutive rows of an Arrow string column
    that hold about `limit` bytes, with the UTF-8 bytes of each text. Only one
    range's texts are copied at a time."""
    import pyarrow as pa
    import pyarrow.compute as pc
    sizes = [0] * len(column) if pa.types.is_null(column.type) else pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for lo, hi in groups_of(sizes, limit):
        yield lo, hi, text_bytes(column.slice(lo, hi - lo))


def give_back() -> None:
    """Returns to the system what freed Arrow buffers and arrays leave reserved:
    a Python worker lives on, and an executor's memory counts its workers."""
    import pyarrow as pa
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc's
    if trim:
        trim(0)
