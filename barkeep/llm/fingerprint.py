"""Document fingerprints by a homomorphic multiset hash.

A text is the multiset of its paragraphs (non-empty lines). Each paragraph
hashes to a wide vector, and a fingerprint is the sum of those vectors, lane
by lane, modulo powers of two: the order of paragraphs does not matter, and a
paragraph is inserted or deleted by adding or subtracting its vector. Two
kinds of lanes stand side by side:

- EXACT lanes of 64 bits, modulo 2^64, uniform in the whole paragraph: equal
  sums mean equal multisets of paragraphs (up to hash collisions).
- NEAR lanes of 32 bits, modulo 2^32 (a text of 2 GB cannot fill one), where each pair of successive words of
  the paragraph (a lone word, if it is one) adds +1 or -1 to one lane. Their
  inner products estimate those of the word-pair counts, so two fingerprints
  alone tell how alike the texts are: twice the product over the sum of
  squares, held to 0..1; equal fingerprints give exactly 1.

Edge cases: a null text is empty; an empty text has the zero fingerprint;
two empty texts are alike by 1, an empty and another by 0; texts count whole;
repeated rows get equal fingerprints.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barkeep.llm.common import groups_of, hash_words, pair_hash

EXACT, NEAR = 4, 256
#: Lines end as str.splitlines' \n, \r\n and \r; blank ones are no paragraph.
_ENDS = bytes.maketrans(b"\r", b"\n")
#: Bytes of text per range of successive documents, and how many ranges at
#: most; characters handled at once.
RANGE, RANGES, BATCH = 4 << 20, 4096, 1 << 20


def paragraphs(text: bytes) -> list[bytes]:
    return [p for p in text.translate(_ENDS).split(b"\n") if p.strip()]


def paragraph_vectors(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(exact, near) lanes of each paragraph."""
    h, n = hash_words(parts)
    return _exact(parts), _near(h, n, np.arange(len(parts)), len(parts))


def _exact(parts: list[bytes]) -> np.ndarray:
    digest = b"".join([hashlib.blake2b(p, digest_size=8 * EXACT).digest() for p in parts])
    return np.frombuffer(digest, "<u8").reshape(-1, EXACT)


def _near(h: np.ndarray, n: np.ndarray, owner: np.ndarray, owners: int) -> np.ndarray:
    unit = np.repeat(np.arange(len(n)), n)
    same = unit[1:] == unit[:-1]
    lone = np.cumsum(n)[n == 1] - 1
    pairs = np.concatenate([pair_hash(h[:-1][same], h[1:][same]), h[lone]])
    who = owner[np.concatenate([unit[:-1][same], unit[lone]])]
    sign = 1 - 2 * ((pairs >> np.uint64(40)) & np.uint64(1)).astype(np.int64)
    lane = (pairs & np.uint64(NEAR - 1)).astype(np.int64)
    total = np.bincount(who * NEAR + lane, sign, owners * NEAR).astype(np.int64)
    return total.astype(np.uint32).reshape(owners, NEAR)  # modulo 2^32


def fingerprints(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(exact, near) sums per text."""
    exact, near = np.zeros((len(texts), EXACT), np.uint64), np.zeros((len(texts), NEAR), np.uint32)
    raw = [(t or "").encode() for t in texts]
    for lo, hi in groups_of([len(t) for t in raw], 1 << 20):
        parts = [paragraphs(t) for t in raw[lo:hi]]
        flat = [p for ps in parts for p in ps]
        if not flat:
            continue
        owner = np.repeat(np.arange(hi - lo), [len(p) for p in parts])
        np.add.at(exact, owner + lo, _exact(flat))
        h, n = hash_words(flat)
        near[lo:hi] = _near(h, n, owner, hi - lo)
    return exact, near


def add(a, b, sign: int = 1):
    """Fingerprint after inserting (or, with sign -1, deleting) paragraphs."""
    if sign > 0:
        return a[0] + b[0], a[1] + b[1]
    return a[0] - b[0], a[1] - b[1]


def render(exact: np.ndarray, near: np.ndarray) -> str:
    return base64.b64encode(exact.astype("<u8").tobytes() + near.astype("<u4").tobytes()).decode()


def parse(text: str) -> tuple[np.ndarray, np.ndarray]:
    raw = base64.b64decode(text)
    return np.frombuffer(raw[:8 * EXACT], "<u8"), np.frombuffer(raw[8 * EXACT:], "<u4")


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Row-wise likeness of two sets of fingerprints."""
    x, y = a[1].astype(np.int32).astype(float), b[1].astype(np.int32).astype(float)
    squares = (x * x).sum(1) + (y * y).sum(1)
    alike = np.clip(2 * (x * y).sum(1) / np.maximum(squares, 1), 0, 1)
    return np.where((a[0] == b[0]).all(1) & (a[1] == b[1]).all(1), 1.0, alike)


def with_next(docs: DataFrame, fn, schema: str, range_bytes: int = RANGE, ranges: int = RANGES) -> DataFrame:
    """`fn(rows)` over documents in descending order of id (nulls last, equal
    ids by descending text), where rows are (doc_id, text) pairs and the last
    one only shows what follows; the smallest is followed by the largest.

    Ids are cut into ranges of about `range_bytes` of text, `ranges` at most,
    found from a summary of the ids; the first row of each range is also sent
    to the range before it. One shuffle moves the texts; a task sorts its
    ranges and streams over them, so their size is no matter of memory.
    """
    spark = docs.sparkSession
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = base.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = min(ranges, max(1, -(-size // range_bytes)))
    cuts = sorted({int(c) for c in base.approxQuantile("doc_id", [i / parts for i in range(1, parts)], 0.1 / parts)}) if parts > 1 else []
    # Range 0 holds the largest ids; a null id falls into the last one.
    number = F.when(F.col("doc_id").isNull(), F.lit(len(cuts))).otherwise(
        F.size(F.filter(F.lit(cuts[::-1]), lambda c: F.col("doc_id") < c)) if cuts else F.lit(0))
    base = base.withColumn("at", number.cast("int"))
    # One row per range, `ranges` at most: its first id, and the range before.
    head = sorted((r["at"], r["first"]) for r in base.groupBy("at").agg(F.max("doc_id").alias("first")).collect())
    if not head:
        return spark.createDataFrame([], schema)
    before = F.broadcast(spark.createDataFrame(
        [(at, first, head[i - 1][0]) for i, (at, first) in enumerate(head)], "at int, first long, before int"))
    seats = F.array(F.struct("at", F.lit(False).alias("guest")))
    also = F.array(F.struct(F.col("before").alias("at"), F.lit(True).alias("guest")))
    places = F.when(F.col("doc_id").eqNullSafe(F.col("first")), F.concat(seats, also)).otherwise(seats)
    dealt = base.join(before, "at").select("doc_id", "text", F.explode(places).alias("p")).select("p.at", "p.guest", "doc_id", "text")
    order = ["at", "guest", F.col("doc_id").desc_nulls_last(), F.col("text").desc()]

    def run(batches):
        import pyarrow as pa
        rows, held, now, closed = [], 0, None, False
        for b in batches:
            for at, guest, i, t in zip(*(b.column(k) for k in range(4))):
                at, guest = at.as_py(), guest.as_py()
                if at != now:
                    rows, held, now, closed = [], 0, at, False
                if closed:  # only the first guest follows
                    continue
                row = (i.as_py(), t.as_py())
                rows.append(row)
                held += len(row[1])
                closed = guest
                if closed or held > BATCH:
                    if len(rows) > 1:
                        yield from pa.Table.from_pandas(fn(rows), preserve_index=False).cast(arrow).to_batches()
                    rows, held = [row], len(row[1])

    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(spark.createDataFrame([], schema).schema)
    return dealt.repartition("at").sortWithinPartitions(*order).mapInArrow(run, schema)


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double")


def edited_report(rows):
    """The contract's columns for all rows but the last."""
    import pandas as pd
    out = []
    for lo in range(0, len(rows) - 1, 256):
        part = rows[lo:min(lo + 257, len(rows))]
        texts = [t for _, t in part]
        changed = [t[:len(t) - len(t) // 2] + after[:len(t) // 2] for t, after in zip(texts, texts[1:])]
        a, b = fingerprints(texts), fingerprints(changed)
        own, following = (a[0][:-1], a[1][:-1]), (a[0][1:], a[1][1:])
        edited, following = likeness(own, b), likeness(own, following)
        out += [(i, len(t), hashlib.sha256(c.encode()).hexdigest(), render(a[0][k], a[1][k]), render(b[0][k], b[1][k]),
                 float(edited[k]), float(following[k])) for k, ((i, t), c) in enumerate(zip(part, changed))]
    frame = pd.DataFrame(out, columns=[c.split()[0] for c in RESULT.split(", ")])
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    return frame


def op8_fingerprint(spark, sf_dir: str) -> DataFrame:
    """Every document's fingerprint beside that of its edited text."""
    from barkeep.llm.common import table
    return with_next(table(spark, sf_dir, "documents"), edited_report, RESULT)
