"""Language-model scoring with a weighted backoff automaton.

N-gram counts of the training texts become an automaton: a state is a context
seen in training, an arc reads a token that followed it, and a failure arc
leads to the state of the context without its first token. With interpolated
(Jelinek-Mercer) smoothing,

    p(w|h) = LAMBDA c(hw)/c(h) + (1-LAMBDA) p(w|h'),   p(w) = c(w)/(N+V),

an unseen token having V/(N+V) in all, an arc weighs log10 p(w|h) and a
failure arc log10(1-LAMBDA). A text is scored in one traversal from left to
right that carries the state; it begins in the start state and ends with the
end token.

Nothing of the model is collected: texts are packed into blocks, each block
asks for the counts of its own n-grams, parts of the key space answer, and
the block compiles the part of the automaton that its texts can reach. What a
task holds is bounded by BLOCK and PART_KEYS, not by the corpus. An n-gram
comes at most once from each block, so frequent words are no hot keys.

Keys are 64-bit hashes of n-grams: two of 10^9 distinct ones collide with a
chance of 3 %, and then share a count.

Edge cases: a null or empty text is the end token alone; without training
texts every probability is 1 (score 0); repeated rows count and are scored
each; a null id is fold 0 (held out); texts count whole; further columns are
ignored.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barkeep.llm.common import groups_of, hash_words, id_fold, pair_hash, stored, text_bytes

ORDER, LAMBDA = 2, 0.4
#: Bytes of text per block (one longer text is a block of its own), and about
#: how many n-grams meet in a part of the key space.
BLOCK, PART_KEYS = 6 << 20, 3_000_000
START, STOP = np.uint64(1), np.uint64(2)


def pack_sorted(keys: np.ndarray) -> bytes:
    """Ascending keys as differences, byte by byte of each: the high bytes
    are zeros, which the shuffle's compression takes away."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_sorted(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(raw, np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(planes).view(np.uint64).ravel(), dtype=np.uint64)


def pack_counts(n: np.ndarray) -> bytes:
    return n.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpack_counts(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


class Block:
    """The n-grams of a block's texts. `gram[k]` gives, for each place of the
    token sequence, the number of the (k+1)-gram that ends there (or -1), and
    `keys[k]` their keys, with `sorting[k]` putting these in order."""

    def __init__(self, texts: list[bytes | None], order: int):
        import pandas as pd
        h, n = hash_words(texts)
        self.begin = np.concatenate([[0], np.cumsum(n + 2)]).astype(np.int64)
        seq = np.empty(self.begin[-1], np.uint64)
        inner = np.ones(len(seq), bool)
        inner[self.begin[:-1]] = inner[self.begin[1:] - 1] = False
        seq[inner], seq[self.begin[:-1]], seq[self.begin[1:] - 1] = h, START, STOP
        place = np.arange(len(seq)) - np.repeat(self.begin[:-1], n + 2)
        code, key = pd.factorize(seq)
        self.gram, self.keys = [code.astype(np.int64)], [np.asarray(key, np.uint64)]
        for k in range(1, order):
            long_enough = place >= k
            # A (k+1)-gram is the k-gram one place before, then this token.
            both = np.full(len(seq), -1, np.int64)
            both[1:] = self.gram[-1][:-1] * len(self.keys[0]) + self.gram[0][1:]
            code, pair = pd.factorize(both[long_enough])
            gram = np.full(len(seq), -1, np.int64)
            gram[long_enough] = code
            pair = np.asarray(pair, np.int64)
            self.keys.append(pair_hash(self.keys[-1][pair // len(self.keys[0])], self.keys[0][pair % len(self.keys[0])]))
            self.gram.append(gram)
        self.sorting = [np.argsort(k, kind="stable") for k in self.keys]

    def counts(self, trained: np.ndarray) -> list[np.ndarray]:
        """Occurrences of each n-gram in the texts marked."""
        on = np.repeat(trained, np.diff(self.begin))
        return [np.bincount(g[on & (g >= 0)], minlength=len(k)) for g, k in zip(self.gram, self.keys)]


def compile_arcs(block: Block, count: list[np.ndarray], tokens: int, types: int, weight: float) -> list[np.ndarray]:
    """log10 weight of the arc of each n-gram, NaN where there is none. The
    arcs of single tokens exist in the empty state for every token."""
    total = tokens + types
    p = np.where(count[0] > 0, count[0], types) / total if total else np.ones(len(count[0]))
    arcs, lower = [np.log10(p)], p
    for k in range(1, len(block.keys)):
        g, ends = block.gram[k], np.flatnonzero(block.gram[k] >= 0)
        last = np.zeros(len(block.keys[k]), np.int64)
        last[g[ends]] = ends  # a place where the n-gram ends
        context, suffix = block.gram[k - 1][last - 1], block.gram[k - 1][last]
        with np.errstate(divide="ignore", invalid="ignore"):
            p = np.where(count[k] > 0, weight * count[k] / count[k - 1][context], 0) + (1 - weight) * lower[suffix]
            arcs.append(np.where(count[k] > 0, np.log10(p), np.nan))
        lower = p
    return arcs


def traverse(arcs: list[list[float]], seen: list[bool], fail: float) -> float:
    """Score of one text: `arcs[k][i]` weighs the arc of the (k+1)-gram that
    ends at place i (NaN: no arc), `seen[i]` tells a known token."""
    order, total, state = len(arcs), 0.0, 1  # the start state has one token
    for i in range(1, len(seen)):
        k = min(state, order - 1)
        while k and arcs[k][i] != arcs[k][i]:
            total += fail  # the failure arc: a shorter context
            k -= 1
        total += arcs[k][i]
        state = k + 1 if k or seen[i] else 0
    return total


def _bigram(first: list[float], arcs: list[float], seen: list[bool], fail: float) -> float:
    """`traverse` for order 2, where a state is the last token or none."""
    total, known = 0.0, True
    for one, two, now in zip(first, arcs, seen):
        if known:
            total += two if two == two else fail + one
        else:
            total += one
        known = now
    return total


def scored(docs: DataFrame, folds: int = 10, order: int = ORDER, weight: float = LAMBDA, keep_ids: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score;
    the model learns from the rows outside fold 0."""
    rows = docs.select(F.col(keep_ids).cast("long").alias("doc_id"), (id_fold(F.col(keep_ids), folds) == 0).alias("held"),
                       F.col("text").cast("string").alias("text"))
    kind = "ids array<long>, held array<boolean>, sizes array<long>, texts binary"

    def gather(batches):
        import pyarrow as pa
        import zstandard
        pack = zstandard.ZstdCompressor(3)

        def out(ids, held, texts):
            return pa.RecordBatch.from_arrays([
                pa.array([ids], pa.list_(pa.int64())), pa.array([held], pa.list_(pa.bool_())),
                pa.array([[len(t) for t in texts]], pa.list_(pa.int64())), pa.array([pack.compress(b"".join(texts))], pa.binary())],
                ["ids", "held", "sizes", "texts"])

        ids, held, texts, size = [], [], [], 0
        for b in batches:
            for i, f, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), text_bytes(b.column(2))):
                t = t or b""
                if texts and size + len(t) > BLOCK:
                    yield out(ids, held, texts)
                    ids, held, texts, size = [], [], [], 0
                ids.append(i)
                held.append(f)
                texts.append(t)
                size += len(t)
        if texts:
            yield out(ids, held, texts)

    # Written once: the blocks stay what they are when read again.
    packed = rows.mapInArrow(gather, kind)
    blocks = stored(packed.withColumn("block", F.monotonically_increasing_id()), "lm-blocks")
    volume = blocks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, s: a + s))).first()[0] or 0
    bits = max(0, math.ceil(math.log2(max(1, volume / 6 * order / PART_KEYS))))

    def opened(row_ids, row_sizes, raw):
        import zstandard
        data = zstandard.ZstdDecompressor().decompress(raw, max_output_size=max(1, int(sum(row_sizes))))
        cut = np.cumsum([0, *row_sizes])
        return [data[cut[i]:cut[i + 1]] for i in range(len(row_ids))]

    def requests(batches):
        import pyarrow as pa
        for b in batches:
            for ids, held, sizes, raw, name in zip(*(b.column(i).to_pylist() for i in range(5))):
                block = Block(opened(ids, sizes, raw), order)
                count = block.counts(~np.array(held, bool))
                for k in range(order):
                    keys, n = block.keys[k][block.sorting[k]], count[k][block.sorting[k]]
                    part = (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
                    cut = np.searchsorted(part, np.arange((1 << bits) + 1))
                    on = np.flatnonzero(np.diff(cut))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(on), k, np.int32)), pa.array(on), pa.array(np.full(len(on), name)),
                        pa.array([pack_sorted(keys[cut[p]:cut[p + 1]]) for p in on], pa.binary()),
                        pa.array([pack_counts(n[cut[p]:cut[p + 1]]) for p in on], pa.binary())], ["k", "part", "block", "keys", "n"])

    def answer(key, frame):
        import pandas as pd
        keys = [unpack_sorted(r) for r in frame["keys"]]
        cut = np.cumsum([0, *(len(k) for k in keys)])
        code, distinct = pd.factorize(np.concatenate(keys))
        total = np.bincount(code, np.concatenate([unpack_counts(r) for r in frame["n"]])).astype(np.uint64)
        own = total[(distinct != START)] if key[0] == 0 else np.zeros(0, np.uint64)
        out = pd.DataFrame({"k": key[0], "part": key[1], "block": frame["block"],
                            "n": [pack_counts(total[code[cut[i]:cut[i + 1]]]) for i in range(len(keys))],
                            "tokens": 0, "types": 0})
        out.loc[out.index[:1], ["tokens", "types"]] = [int(own.sum()), int((own > 0).sum())]
        return out

    asked = blocks.select("ids", "held", "sizes", "texts", "block").mapInArrow(
        requests, "k int, part long, block long, keys binary, n binary")
    replies = stored(asked.groupBy("k", "part").applyInPandas(
        answer, "k int, part long, block long, n binary, tokens long, types long"), "lm-counts")
    tokens, types = (int(x or 0) for x in replies.agg(F.sum("tokens"), F.sum("types")).first())
    fail = math.log10(1 - weight)
    floor = 0.1 * (types + 1) + tokens

    def score(frame, answers):
        import pandas as pd
        out = []
        for ids, held, sizes, raw in zip(frame["ids"], frame["held"], frame["sizes"], frame["texts"]):
            block = Block(opened(ids, sizes, raw), order)
            count = []
            for k in range(order):
                mine = answers[answers["k"] == k].sort_values("part")
                n = np.empty(len(block.keys[k]), np.uint64)
                n[block.sorting[k]] = np.concatenate([unpack_counts(r) for r in mine["n"]])
                count.append(n.astype(np.float64))
            arcs = compile_arcs(block, count, tokens, types, weight)
            known = count[0] > 0
            base = np.log10((count[0] + 0.1) / floor)
            places = [np.where(g >= 0, a[g], np.nan) for a, g in zip(arcs, block.gram)]
            seen, base = known[block.gram[0]], base[block.gram[0]]
            for i in range(len(ids)):
                lo, hi = block.begin[i], block.begin[i + 1]
                row = [p[lo:hi].tolist() for p in places]
                flags = seen[lo:hi].tolist()
                if order == 2:
                    s = _bigram(row[0][1:], row[1][1:], flags[1:], fail) if tokens else 0.0
                else:
                    s = traverse(row, flags, fail) if tokens else 0.0
                out.append((ids[i], bool(held[i]), hi - lo - 1, int(sum(flags[1:])), tokens, float(base[lo + 1:hi].sum()), s))
        done = pd.DataFrame(out, columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        done["doc_id"] = done["doc_id"].astype("Int64")
        return done

    return blocks.groupBy("block").cogroup(replies.select("block", "k", "part", "n").groupBy("block")).applyInPandas(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def op1_lm(spark, sf_dir: str) -> DataFrame:
    """Every document's score, learned from folds 1 to 9 of 10."""
    from barkeep.llm.common import table
    out = scored(table(spark, sf_dir, "documents"))
    return out.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


#: crc32 of an id's text, bit by bit.
_CRC = """xor(list_reduce([4294967295::UBIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::UBIGINT),
  lambda c, b: list_reduce([xor(c, b)] || [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0],
    lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::UBIGINT) ELSE x // 2 END)), 4294967295::UBIGINT)"""
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1_SQL = """
WITH d AS (SELECT doc_id, %s %% 10 = 0 AS held_out,
    regexp_extract_all(%s, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
t AS (SELECT doc_id, held_out, unnest(w || ['  end']) AS w, unnest(['  start'] || w) AS h, unnest(range(len(w) + 1)) AS i FROM d),
uni AS (SELECT w, count(*) AS c FROM t WHERE NOT held_out GROUP BY w),
ctx AS (SELECT h, count(*) AS c FROM t WHERE NOT held_out GROUP BY h),
bi AS (SELECT h, w, count(*) AS c FROM t WHERE NOT held_out GROUP BY h, w),
s AS (SELECT coalesce(sum(c), 0)::BIGINT AS n, count(*) AS v FROM uni),
p AS (SELECT t.*, uni.c AS cu, ctx.c AS ch, bi.c AS cb, n, v,
    CASE WHEN n + v = 0 THEN 1.0 ELSE coalesce(uni.c, v)::DOUBLE / (n + v) END AS pu
  FROM t CROSS JOIN s LEFT JOIN uni USING (w) LEFT JOIN ctx ON ctx.h = t.h LEFT JOIN bi ON bi.h = t.h AND bi.w = t.w)
SELECT doc_id, held_out, count(*)::BIGINT AS n_tokens, count(cu)::BIGINT AS n_known, any_value(n)::BIGINT AS train_tokens,
  round(sum(log10((coalesce(cu, 0) + 0.1::DOUBLE) / (n + 0.1::DOUBLE * (v + 1))) ORDER BY i), 6) AS base_score,
  round(sum(log10(CASE WHEN ch IS NULL THEN pu ELSE 0.4::DOUBLE * coalesce(cb, 0) / ch + 0.6::DOUBLE * pu END) ORDER BY i), 6) AS score
FROM p GROUP BY doc_id, held_out
""" % (_CRC, LOWER)
