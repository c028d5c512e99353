"""Near-duplicate documents: SuperMinHash signatures, banding, verification
on full shingle sets and union-find grouping.

SuperMinHash ranks the M signature places anew for each element by a random
permutation and gives the element the value j + r at the place of rank j. A
place keeps the least value, so no two ranks of an element compete for one
place, which lowers the variance. Once every place holds a value below j + 1,
ranks from j + 1 on cannot change it and the computation stops: long texts
need one rank, short ones more.

Documents with equal shingle sets are one node from the start. Nodes that
agree in a band of the signature are candidates; a link needs the threshold
on the full sets. Within a bucket of a band a centre is compared with all
others, and all that link are joined; buckets that still hold several
components are compared around further centres. In the end the signatures of
every two nodes of different components in a bucket are compared, in blocks,
and those that agree in ESTIMATE of their places or more are verified there,
in the first bucket that they share; only links leave a block. So the
components are those of all candidate links, while a large group of near
copies costs work in proportion to its members, not to their pairs.

A pair at the threshold 0.8 misses all 30 bands with a chance of 1e-5, and
falls below ESTIMATE with one of 2e-6.

Edge cases: null and empty texts, and texts without a word, have no shingle
and link with nothing; a text of fewer words than a shingle is one shingle;
equal texts always link; rows that share an id are one document, linked if
any of them is; rows without an id stand alone and are kept, component null;
further columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barkeep.llm.common import give_back, groups_of, hash_words, mix, pair_hash, stored, text_groups

ROWS, BANDS = 5, 30
M = ROWS * BANDS
#: Candidate ids up to this many (8 MB) are broadcast to the texts.
FEW_IDS = 1_000_000
ESTIMATE = 0.65
#: Rows of a bucket that meet in one block.
CHUNK = 4096
_EMPTY = np.uint32(0xFFFFFFFF)


def shingles(texts: list[bytes | None], width: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, counts): the distinct shingles of each text, ascending."""
    h, n = hash_words(texts)
    doc = np.repeat(np.arange(len(n)), n)
    first = np.concatenate([[0], np.cumsum(n)])[:-1]
    grown, owner, short = mix(h + np.uint64(width)), doc, []
    # A text with fewer words is the chain of its words, salted by their number.
    for i in np.flatnonzero((n > 0) & (n < width)):
        one = mix(h[first[i]:first[i] + 1] + np.uint64(1 << 20))
        for x in h[first[i] + 1:first[i] + n[i]]:
            one = pair_hash(one, np.array([x], np.uint64))
        short.append((i, mix(one + n[i].astype(np.uint64))[0]))
    for k in range(1, width):
        same = owner[:-1] == doc[k:] if len(owner) > 1 else np.zeros(0, bool)
        grown = pair_hash(grown[:-1], h[k:]) if len(grown) > 1 else grown[:0]
        owner = np.where(same, owner[:-1], -1) if len(same) else owner[:0]
    on = owner >= 0
    grown = np.concatenate([grown[on], np.array([x for _, x in short], np.uint64)])
    owner = np.concatenate([owner[on], np.array([i for i, _ in short], np.int64)]).astype(np.int64)
    order = np.lexsort((grown, owner))
    grown, owner = grown[order], owner[order]
    fresh = np.ones(len(grown), bool)
    fresh[1:] = (grown[1:] != grown[:-1]) | (owner[1:] != owner[:-1])
    return grown[fresh], np.bincount(owner[fresh], minlength=len(n))


def superminhash(elements: np.ndarray, counts: np.ndarray, m: int = M) -> np.ndarray:
    """Signatures (texts x m) of sets of hashed elements, given one after the
    other. Values are rank << 24 | 24 random bits."""
    sig = np.full((len(counts), m), _EMPTY, np.uint32)
    flat = sig.reshape(-1)
    ends = np.cumsum(counts)
    for lo, hi in groups_of(counts.tolist(), 100_000):
        e, d = elements[ends[lo] - counts[lo]:ends[hi - 1]], np.repeat(np.arange(lo, hi), counts[lo:hi])
        perm = None
        for rank in range(m):
            x = mix(e + np.uint64((rank + 1) * 0x632BE59BD9B4E019 & (1 << 64) - 1))
            pick = rank + ((x >> np.uint64(32)) * np.uint64(m - rank) >> np.uint64(32)).astype(np.int64)
            value = (np.uint32(rank) << np.uint32(24)) | (x & np.uint64(0xFFFFFF)).astype(np.uint32)
            if perm is None:
                place = pick
            else:
                place = perm[rows, pick].astype(np.int64)
                perm[rows, pick] = perm[:, rank]
            np.minimum.at(flat, d * m + place, value)
            # Early stopping: texts whose places are all taken are done.
            open_ = (sig[lo:hi] == _EMPTY).any(1)
            on = open_[d - lo]
            if not on.any():
                break
            if perm is None:
                e, d = e[on], d[on]
                perm = np.empty((len(e), m), np.uint8 if m <= 256 else np.uint16)
                perm[:] = np.arange(m)
                rows = np.arange(len(e))
                perm[rows, place[on]] = 0
            elif on.sum() < 0.7 * len(on):
                e, d, perm = e[on], d[on], perm[on]
                rows = np.arange(len(e))
    return sig


def band_hashes(sig: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash per band (texts x bands); the band's number is part of it."""
    parts = sig.reshape(len(sig), -1, rows).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, parts.shape[1] + 1, dtype=np.uint64), parts.shape[:2])
    for k in range(rows):
        out = pair_hash(out, parts[:, :, k])
    return out


def _signed(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n, a, b (hash of the set, 128 bits), bands, places (16 bits of
    each place of the signature)."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for lo, hi, texts in text_groups(batch.column(1)):
                e, n = shingles(texts, width)
                owner = np.repeat(np.arange(hi - lo), n)
                a, b = np.zeros(hi - lo, np.uint64), np.zeros(hi - lo, np.uint64)
                np.add.at(a, owner, mix(e ^ np.uint64(0x51)))
                np.add.at(b, owner, mix(e ^ np.uint64(0xA3)))
                sig = superminhash(e, n)
                bands = band_hashes(sig).view(np.int64)
                held = np.flatnonzero(n == 0)
                rows = [None if i in held else r for i, r in enumerate(bands)] if len(held) else list(bands)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo), pa.array(n.astype(np.int64)), pa.array(a.view(np.int64)),
                    pa.array(b.view(np.int64)), pa.array(rows, pa.list_(pa.int64())),
                    pa.array([x.tobytes() for x in sig.astype(np.uint16)], pa.binary())],
                    ["doc_id", "n", "a", "b", "bands", "places"])
            give_back()

    return docs.mapInArrow(run, "doc_id long, n long, a long, b long, bands array<long>, places binary")


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """doc_id and its shingles, equal rows once."""
    def run(batches):
        import pyarrow as pa
        for batch in batches:
            for lo, hi, texts in text_groups(batch.column(1)):
                e, n = shingles(texts, width)
                ends = np.concatenate([[0], np.cumsum(n)])
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, hi - lo),
                    pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(e.view(np.int64)))], ["doc_id", "set"])
            give_back()

    return docs.mapInArrow(run, "doc_id long, set array<long>")


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the edges (a, b), the root being the
    component's least node. Each partition first joins its edges by
    union-find; stars are then contracted until nothing changes."""
    def local(batches):
        import pyarrow as pa
        parent: dict[int, int] = {}

        def find(x):
            while parent.setdefault(x, x) != x:
                parent[x] = x = parent[parent[x]]
            return x

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                x, y = find(x), find(y)
                parent[max(x, y)] = min(x, y)
            if len(parent) > 500_000:  # bounded: what is joined so far goes out
                rows = [(x, find(x)) for x in parent if find(x) != x]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], ["u", "v"])
                parent.clear()
        rows = [(x, find(x)) for x in list(parent) if find(x) != x]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], pa.int64()) for i in (0, 1)], ["u", "v"])

    # Every edge runs from the larger node u to the smaller v.
    now = stored(edges.select("a", "b").mapInArrow(local, "u long, v long").distinct(), "components")
    state = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "components")
        last, state = state, now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))"), F.expr("bit_xor(xxhash64(v, u))")).first()
        if state == last or not state[0]:
            roots = now.select("v").distinct()
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
                roots.select(F.col("v").alias("node"), F.col("v").alias("root")))


def _crossed(rows: DataFrame, threshold: tuple[int, int]) -> DataFrame:
    """The components (a, b) of all linked pairs of different components in a
    bucket: sizes and signatures first, then the full sets. A bucket of more
    than CHUNK rows is dealt out as pairs of chunks; small ones share a
    task's group."""
    low, full = threshold
    parts = rows.groupBy("bucket").agg(F.count("*").alias("size")).where(F.col("size") > CHUNK).select(
        "bucket", F.ceil(F.col("size") / CHUNK).cast("int").alias("parts"))
    own = rows.join(parts, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = own.withColumn("own", F.pmod(F.xxhash64(F.lit(9), "node"), F.col("parts")).cast("int"))
    own = own.select("bucket", "band", "node", "root", "n", "places", "set", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other"))
    cell = F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other"))
    groups = max(1, rows.count() // max(1, CHUNK // 4))
    own = own.withColumn("cell", cell).withColumn("group", F.pmod("cell", F.lit(groups)))

    def pairs(key, frame):
        import pandas as pd
        frame = frame.sort_values(["cell", "node"])
        cells, node, root, n = (frame[c].to_numpy() for c in ("cell", "node", "root", "n"))
        sig = np.frombuffer(b"".join(frame["places"]), np.uint16).reshape(len(frame), -1)
        mine, band, sets = frame["own"].to_numpy(), frame["band"].to_numpy(), list(frame["set"])
        cut = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1], [True]]))
        out = set()
        for lo, hi in zip(cut[:-1], cut[1:]):
            # The largest component is only compared with the others.
            names, code, size = np.unique(root[lo:hi], return_inverse=True, return_counts=True)
            if len(names) < 2:
                continue
            place = np.empty(len(names), np.int64)
            place[np.argsort(-size, kind="stable")] = np.arange(len(names))
            order = place[code]
            both = len(np.unique(mine[lo:hi])) > 1
            for i in np.flatnonzero(order > 0):
                others = np.flatnonzero(order < order[i]) + lo
                if both:
                    others = others[mine[others] != mine[lo + i]]
                a, b = n[others], n[lo + i]
                others = others[np.minimum(a, b) * full >= np.maximum(a, b) * low]
                same = sig[others] == sig[lo + i]
                others, same = others[near := same.mean(1) >= ESTIMATE], same[near]
                # Verified in the first band that both share, nowhere else.
                first = same.reshape(len(same), sig.shape[1] // ROWS, ROWS).all(2).argmax(1)
                for j in others[first >= band[lo + i]]:
                    if (link := (min(root[lo + i], root[j]), max(root[lo + i], root[j]))) not in out:
                        common = len(np.intersect1d(sets[lo + i], sets[j], assume_unique=True))
                        if common * full >= low * (n[lo + i] + n[j] - common):
                            out.add(link)
        return pd.DataFrame(sorted(out), columns=["a", "b"], dtype="int64")

    return own.groupBy("group").applyInPandas(pairs, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, width: int = 5, threshold: tuple[int, int] = (80, 100)) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per input row. Links
    need threshold[1] * intersection >= threshold[0] * union."""
    low, full = threshold
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(_signed(rows, width), "neardup-signatures")
    known = signed.where("doc_id is not null and n > 0")
    nodes = known.groupBy("n", "a", "b").agg(F.min("doc_id").alias("node"), F.count("*").alias("members"), F.first("bands").alias("bands"),
                                               F.first("places").alias("places"))
    nodes = stored(nodes, "neardup-nodes")
    bucket = nodes.select("node", "n", F.posexplode("bands").alias("band", "bucket"))
    shared = bucket.groupBy("bucket").agg(F.count("*").alias("m")).where("m > 1").select("bucket")
    bucket = stored(bucket.join(shared, "bucket").select("bucket", "band", "node", "n"), "neardup-buckets")
    near = lambda: (F.least("n", "m") * full >= F.greatest("n", "m") * low)  # noqa: E731  other sizes cannot link

    ids = stored(bucket.select(F.col("node").alias("doc_id")).distinct(), "neardup-ids")
    wanted = rows.join(F.broadcast(ids) if ids.count() <= FEW_IDS else ids, "doc_id", "left_semi")
    sets = stored(_sets(wanted, width).distinct(), "neardup-sets")

    def links(pairs: DataFrame) -> DataFrame:
        """The pairs (x, y, with the components p, q) that reach the threshold."""
        left = sets.select(F.col("doc_id").alias("y"), F.col("set").alias("s"))
        right = sets.select(F.col("doc_id").alias("x"), F.col("set").alias("t"))
        both = F.size(F.array_intersect("s", "t"))
        return pairs.join(left, "y").join(right, "x").where(
            both * full >= low * (F.size("s") + F.size("t") - both)).select(F.col("p").alias("a"), F.col("q").alias("b"))

    label = None  # (node, root) of all nodes with a link
    for step in range(4):
        own = bucket.withColumn("root", F.col("node"))
        if label is not None:
            own = bucket.join(label, "node", "left").withColumn("root", F.coalesce("root", "node"))
            several = own.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo < hi").select("bucket")
            own = stored(own.join(several, "bucket"), "neardup-open")
            if own.isEmpty():
                break
        if step < 3:
            # A centre per bucket: first the same one wherever it occurs, then others.
            order = F.xxhash64("node", F.lit(step), *(["bucket"] if step else []))
            centre = own.groupBy("bucket").agg(F.min(F.struct(order.alias("o"), "node", "n", "root")).alias("c")).select(
                "bucket", F.col("c.node").alias("x"), F.col("c.n").alias("m"), F.col("c.root").alias("p"))
            pairs = own.join(centre, "bucket").where((F.col("root") != F.col("p")) & near())
            pairs = pairs.select("x", F.col("node").alias("y"), "p", F.col("root").alias("q"))
        else:
            held = sets.select(F.col("doc_id").alias("node"), "set")
            pairs = None
            found = stored(_crossed(own.join(nodes.select("node", "places"), "node").join(held, "node"), threshold), "neardup-links")
        if pairs is not None:
            found = stored(links(pairs.distinct()), "neardup-links")
        merged = components(found)
        if label is None:
            label = merged
        else:
            moved = merged.select(F.col("node").alias("root"), F.col("root").alias("to"))
            fresh = merged.join(label.select("node"), "node", "left_anti")
            label = label.join(moved, "root", "left").select("node", F.coalesce("to", "root").alias("root")).unionByName(fresh)
        label = stored(label, "neardup-labels")

    # Only documents that share their node or link need an answer.
    whole = nodes.select("n", "a", "b", "node", "members")
    if label is not None:
        whole = whole.join(label, "node", "left").where("members > 1 or root is not null")
    whole = whole.select("n", "a", "b", F.coalesce("root", "node").alias("component_id"))
    out = signed.drop("bands", "places").join(whole, ["n", "a", "b"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"),
                      F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op10_neardup(spark, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents on 2-word shingles."""
    from barkeep.llm.common import table
    return near_duplicates(table(spark, sf_dir, "documents"), width=2)


OP10_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON link.a = reach.b)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.c AS component_id, d.doc_id = r.c AS kept
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) r ON r.a = d.doc_id
"""
