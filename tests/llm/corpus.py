"""Small tables with every awkward row, written as the driver's are."""

import os
import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, n int, block string, size string, held boolean"
LONG = " ".join("w%d" % (i * i % 7919) for i in range(30_000))  # far more than one segment of a task


def awkward():
    """(doc_id, text): nulls, blanks, repeats, ties, one very long text."""
    return [(1, None), (2, ""), (3, " \t\n\x0b\f\r "), (4, "one"), (5, "One two"), (5, "One two"), (6, "one  two"),
            (7, "été ÉTÉ ñ 漢字 🙂"), (8, LONG), (9, LONG + " tail"), (None, "no id here"), (None, None),
            (-10, "a-b, c! a-b, c!"), (100, "x" * 5000), (200, "12345 !!! \x1f \x85 end")]


def write_docs(spark, path, rows, name="documents"):
    """rows: (doc_id, text[, lang[, source]]); other columns hold traps."""
    full = [(*r, *[None] * (4 - len(r)), None if i % 2 else 7, 0.25, i, "b%d" % i, None, True) for i, r in enumerate(rows)]
    spark.createDataFrame(full, DOCS).repartition(3).write.parquet(os.path.join(path, name + ".parquet"))
    return path


def write(spark, path, name, rows, schema):
    spark.createDataFrame(rows, schema).write.parquet(os.path.join(path, name + ".parquet"))


def prose(seed, n, words=40, vocabulary=60):
    rng = random.Random(seed)
    pool = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(vocabulary)]
    return [" ".join(rng.choice(pool) for _ in range(rng.randint(1, words))) for _ in range(n)]


def words(text):
    return (text or "").encode().lower().split()
