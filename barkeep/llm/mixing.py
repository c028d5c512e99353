"""Mixing sources to target weights by subset-sum budget fitting.

Each source gets a share of all words by its weight, held to a number of
epochs; whole epochs of it are taken first. The budget that remains is fitted
on the exact counts of documents by length: a bounded knapsack (dynamic
programming over reachable sums) has all of a small budget and the last ROOM
words or more of a large one, of which every length gave its share before.
Which documents of a length are taken is seeded by their id.

Only counts by (source, length) meet in one task. The choice within a length
is made by hash buckets: counts per bucket say which buckets are taken whole
and how many documents of the one at the edge, so a length or a source that
holds most rows is still spread over BUCKETS tasks.

Edge cases: a null text has no words; a null source is a source of its own,
last in order; documents without words take nothing; repeated rows count each
(equal ids are interchangeable); ties of the hash go by id; texts of any
length are counted whole; an empty table gives an empty result; columns of the
input, whatever their names, pass through in `doc`.
"""

from __future__ import annotations

from math import gcd

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barkeep.llm.common import stored

WEIGHTS, EPOCHS, BUCKETS, SEED = (1, 2, 3), 3, 256, 11
#: Budget left to the knapsack at first and at most, in words: bounds its table.
ROOM, MOST = 1 << 15, 1 << 24


def words(text: Column) -> Column:
    """Number of `[^\\x20\\x09-\\x0D]+` in a text."""
    bare = F.btrim(F.coalesce(text.cast("string"), F.lit("")), F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", F.lit(0)).otherwise(F.size(F.split(bare, r"[\x20\x09-\x0D]+", -1))).cast("long")


def targets(sizes: dict[str | None, int], weights=WEIGHTS, epochs: int = EPOCHS) -> dict[str | None, float]:
    """Words per source: shares by weight, the excess over `epochs` times a
    source's size shared again among the others until none is above."""
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out: dict[str | None, float] = {}
    left, free = float(sum(sizes.values())), list(names)
    while free:
        each = left / sum(weight[s] for s in free)
        over = [s for s in free if each * weight[s] > epochs * sizes[s]]
        if not over:
            return out | {s: each * weight[s] for s in free}
        for s in over:
            out[s] = float(epochs * sizes[s])
            left -= out[s]
        free = [s for s in free if s not in over]
    return out


def reachable(counts: dict[int, int], goal: int) -> dict[int, int]:
    """Bounded knapsack: how many of each length to take so that their words
    come to the largest reachable sum up to `goal`. A length's count is cut
    into powers of two; each reachable sum keeps the step that first made it,
    from which the choice is read back."""
    held, first = np.zeros(goal + 1, bool), np.zeros(goal + 1, np.int32)
    held[0], steps = True, []
    for k in sorted(counts, reverse=True):
        spare, part = counts[k], 1
        while spare and not held[goal]:
            part = min(part, spare)
            if part * k > goal:
                break
            fresh = np.flatnonzero(held[:goal + 1 - part * k] & ~held[part * k:]) + part * k
            held[fresh], first[fresh] = True, len(steps)
            steps.append((k, part))
            spare -= part
            part *= 2
    take, at = dict.fromkeys(counts, 0), int(np.flatnonzero(held)[-1])
    while at:
        k, part = steps[first[at]]
        take[k] += part
        at -= part * k
    return take


def fitted(counts: dict[int, int], budget: int) -> dict[int, int]:
    """How many documents of each length to take, so that their words come to
    the largest reachable sum up to `budget`.

    All but `room` words are dealt in proportion, the knapsack fits the rest.
    No sum passes the largest multiple of the lengths' common divisor; while
    that is missed, more of the share is given back to the knapsack, up to all
    of it or to MOST words (then the nearest sum found stands). Up to ROOM
    words the knapsack has everything and is exact."""
    own = {k: n for k, n in counts.items() if k and n}
    total = sum(k * n for k, n in own.items())
    goal = min(budget, total)
    goal -= goal % gcd(*own) if own else 0
    best, room = dict.fromkeys(counts, 0), ROOM
    while own:
        dealt = max(goal - room, 0)
        take = {k: n * dealt // total for k, n in own.items()}
        left = goal - sum(k * n for k, n in take.items())
        for k in sorted(own, reverse=True):  # what rounding left over, longer ones first
            more = max(min(own[k] - take[k], (left - room) // k), 0)
            take[k] += more
            left -= more * k
        for k, n in reachable({k: n - take[k] for k, n in own.items()}, left).items():
            take[k] += n
            left -= k * n
        if goal - left > sum(k * n for k, n in best.items()):
            best = dict.fromkeys(counts, 0) | take
        if not left or not dealt or room >= MOST:
            break
        room *= 8
    return best


def mixed(docs: DataFrame, seed: int = SEED, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """doc (the input's row as a struct, so that no name can clash), size,
    source_size, target, copies."""
    name = docs["source"].cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    place = F.xxhash64(F.lit(seed), docs["doc_id"])
    rows = docs.select(
        F.struct(*[docs[c] for c in docs.columns]).alias("doc"), docs["doc_id"].alias("id"),
        F.when(name.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), name)).alias("source"),  # joins find null too
        words(docs["text"]).alias("size"), place.alias("hash"), F.pmod(place, F.lit(BUCKETS)).cast("int").alias("bucket"))
    cell = ["source", "size", "bucket"]
    cells = stored(rows.groupBy(*cell).agg(F.count("*").alias("n")), "mix-counts")
    lengths = cells.groupBy("source", "size").agg(F.sum("n").alias("n"))
    # One row per source reaches the driver: a mix names its sources anyway.
    sizes = {(None if r[0] == "-" else r[0][1:]): int(r[1]) for r in lengths.groupBy("source").agg(F.sum(F.col("n") * F.col("size"))).collect()}
    target = targets(sizes, weights, epochs)

    def plan(key, frame):
        import pandas as pd
        source = None if key[0] == "-" else key[0][1:]
        size, aim = sizes[source], target[source]
        whole = min(epochs, int(aim // size)) if size else 0
        counts = dict(zip(frame["size"].astype(int).tolist(), frame["n"].astype(int).tolist()))
        take = fitted(counts, round(aim - whole * size)) if size else dict.fromkeys(counts, 0)
        return pd.DataFrame({"source": key[0], "size": list(take), "source_size": size, "target": float(aim),
                             "whole": whole, "take": list(take.values())})

    plans = lengths.groupBy("source").applyInPandas(
        plan, "source string, size long, source_size long, target double, whole long, take long")
    before = F.sum("n").over(Window.partitionBy("source", "size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    edges = cells.join(plans, ["source", "size"]).withColumn("take", F.col("take") - F.coalesce(before, F.lit(0)))
    ranked = rows.join(edges.drop("n"), cell).withColumn(
        "rank", F.row_number().over(Window.partitionBy(*cell).orderBy("hash", "id")))
    return ranked.select("doc", "size", "source_size", "target",
                         (F.col("whole") + (F.col("rank") <= F.col("take")).cast("long")).alias("copies"))


def op5_mixing(spark, sf_dir: str) -> DataFrame:
    """Words taken of every document for the mix."""
    from barkeep.llm.common import table
    out = mixed(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return out.select("doc.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
