"""op11, op12, op13 against brute force and their SQL, with every awkward row."""
import hashlib
import os
import sys

import duckdb
import numpy as np
import pytest

from barkeep.llm import codes, lines, whitening
from barkeep.llm.common import table
from tests.llm import corpus

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "scripts"))

from oracle_check import _rows  # noqa: E402

VECTORS = "vec_id long, embedding array<float>, label int, x string, code string, n string"


def vector_rows(seed, n, width=32, labels=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, width)).astype(np.float32) * np.linspace(2, 0.2, width, dtype=np.float32)
    rows = [(int(i), [float(v) for v in r], int(i % labels)) for i, r in enumerate(x)]
    rows += [(0, rows[5][1], 0), (7, rows[7][1], 1), (7, rows[9][1], 1), (None, rows[3][1], None), (n, rows[3][1], None),
             (n + 1, None, 1), (n + 2, [float("nan")] * width, 1), (n + 3, [*rows[0][1][:-1], float("inf")], 1),
             (n + 4, [0.0] * width, 2), (n + 5, [-0.0] * width, 2), (-3, rows[2][1], 2)]
    rows += [(n + 10 + i, rows[11][1], 1) for i in range(n // 2)]  # a third of all rows is one vector
    return [(*r, "t", "c", "n") for r in rows]


def write_vectors(spark, path, rows):
    spark.createDataFrame(rows, VECTORS).repartition(3).write.parquet(os.path.join(path, "embeddings.parquet"))
    return path


def sql(path, name, query):
    con = duckdb.connect()
    con.execute("CREATE VIEW %s AS SELECT * FROM read_parquet('%s/%s.parquet/*.parquet')" % (name, path, name))
    cur = con.execute(query)
    return [d[0] for d in cur.description], cur.fetchall()


def same(df, wanted):
    cols, rows = wanted
    assert sorted(df.columns) == sorted(cols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(cols, rows)


# --- op11 -------------------------------------------------------------------

@pytest.mark.parametrize("seed, entries, width, spread", [(0, 64, 4, 40), (1, 64, 4, 3), (2, 1, 4, 9), (3, 7, 1, 5), (4, 256, 3, 2), (5, 64, 16, 10 ** 6), (6, 20, 0, 1)])
def test_gnat_finds_the_nearest_of_the_lowest_index(seed, entries, width, spread):
    rng = np.random.default_rng(seed)
    points = rng.integers(-spread, spread + 1, (entries, width))
    x = np.concatenate([rng.integers(-2 * spread, 2 * spread + 1, (700, width)), points])
    at, d2 = codes.Gnat(points).nearest(x)
    full = ((x[:, None] - points[None]) ** 2).sum(2)
    assert (d2 == full.min(1)).all() and (at == full.argmin(1)).all()


def test_gnat_leaves_out_whole_subtrees(monkeypatch):
    rng = np.random.default_rng(8)
    centres = rng.integers(-10 ** 5, 10 ** 5, (16, 4))
    points = np.concatenate([c + rng.integers(-9, 10, (16, 4)) for c in centres])
    seen = []
    plain = codes._squared
    tree = codes.Gnat(points)
    monkeypatch.setattr(codes, "_squared", lambda x, p: seen.append(len(x) * len(p)) or plain(x, p))
    x = points[rng.integers(0, len(points), 500)]
    tree.nearest(x)
    assert sum(seen) < 0.4 * len(x) * len(points)


def test_op11_matches_sql_with_awkward_rows(spark, tmp_path):
    path = write_vectors(spark, str(tmp_path), vector_rows(1, 150))
    same(codes.op11_codes(spark, path), sql(path, "embeddings", codes.OP11_SQL))


def test_op11_short_odd_and_empty_vectors(spark, tmp_path):
    rng = np.random.default_rng(2)
    rows = [(i, [float(v) for v in rng.normal(size=int(rng.integers(0, 19)))], None, "t", "c", "n") for i in range(40)]
    path = write_vectors(spark, str(tmp_path), rows)
    same(codes.op11_codes(spark, path), sql(path, "embeddings", codes.OP11_SQL))


@pytest.mark.parametrize("rows", [[], [(1, None, 1, "t", "c", "n")], [(1, [], 1, "t", "c", "n")]])
def test_empty_tables(spark, tmp_path, rows):
    path = write_vectors(spark, str(tmp_path), rows)
    held = int(bool(rows) and rows[0][1] is not None)
    assert len(codes.op11_codes(spark, path).collect()) == held
    assert whitening.op12_whitening(spark, path).collect() == []


def test_codes_stand_for_vectors_within_their_error(spark, tmp_path):
    path = write_vectors(spark, str(tmp_path), vector_rows(3, 60, width=16))
    emb = table(spark, path, "embeddings")
    found, books = codes.compressed(emb, entries=8, rounds=3)
    kept = codes.integers(emb).collect()
    left = sorted((-99 if r["vec_id"] is None else r["vec_id"], tuple(r["x"])) for r in kept)
    got = sorted((-99 if r["vec_id"] is None else r["vec_id"], r["code"], r["error"]) for r in found.collect())
    assert len(left) == len(got)
    errors = sorted((i, int(((np.array(x) - codes.decoded(c, books)) ** 2).sum())) for (i, x), (_, c, _) in zip(left, got) if i not in (7, 0))
    assert errors == sorted((i, e) for i, _, e in got if i not in (7, 0))


def test_huge_components_are_held_within_the_bound(spark, tmp_path):
    rows = [(i, [3e38 if i == k else float(i) for k in range(16)], 1, "t", "c", "n") for i in range(5)]
    path = write_vectors(spark, str(tmp_path), rows)
    assert len(codes.op11_codes(spark, path).collect()) == 5
    assert whitening.op12_whitening(spark, path).count() == 20


# --- op12 -------------------------------------------------------------------

def brute_whitening(rows, m=4):
    kept = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in v]) for i, v, *_ in rows
            if v is not None and np.isfinite(np.array(v, float)).all()]
    fit = sorted({tuple(x) for _, x in kept})
    n, s = len(fit), [sum(c) for c in zip(*fit)]
    a = np.array(fit, float)
    cov = (a - a.mean(0)).T @ (a - a.mean(0)) / n
    e, u = np.linalg.eigh(cov)
    e, u = e[::-1][:m], u[:, ::-1][:, :m]
    out = {}
    for i, x in kept:
        dev = sum((n * v - t) ** 2 for v, t in zip(x, s))
        out.setdefault(i, []).append((dev, ((np.array(x) - np.array(s) / n) @ u) / np.sqrt(e)))
    return n, e / np.trace(cov), out


@pytest.mark.parametrize("seed, width", [(4, 32), (5, 64), (6, 3), (7, 1)])
def test_op12_matches_eigh(spark, tmp_path, seed, width):
    rows = vector_rows(seed, 120, width)
    n, explained, want = brute_whitening(rows, min(4, width))
    path = write_vectors(spark, str(tmp_path), rows)
    got = whitening.op12_whitening(spark, path).collect()
    m = min(4, width)
    assert len(got) == m * sum(len(v) for v in want.values())
    by_row, sign = {}, None
    for r in got:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert r["explained"] == pytest.approx(explained[r["component"] - 1], rel=1e-10)
        by_row.setdefault((r["vec_id"], r["deviation"], r["component"]), []).append(r["whitened"])
    sign = [np.sign(by_row[(12, want[12][0][0], j + 1)][0] * want[12][0][1][j]) for j in range(m)]
    for i, versions in want.items():
        for dev, w in versions:
            for j in range(m):
                assert min(abs(v - sign[j] * w[j]) for v in by_row[(i, dev, j + 1)]) < 1e-8


def test_whitener_is_certified_by_passes_and_not_by_a_covariance(spark, tmp_path):
    path = write_vectors(spark, str(tmp_path), vector_rows(9, 300, 64))
    w = whitening.fit_whitener(*whitening.fit_list(whitening.vectors_of(table(spark, path, "embeddings"))))
    assert w.passes > 2 and w.residual < 1e-11
    assert np.abs(w.vectors.T @ w.vectors - np.eye(4)).max() < 1e-12


def test_components_without_spread_are_left_out(spark, tmp_path):
    flat = [(i, [float(i), 2.0 * i, 1.0], 1, "t", "c", "n") for i in range(6)]
    got = whitening.op12_whitening(spark, write_vectors(spark, str(tmp_path / "a"), flat)).collect()
    assert sorted({r["component"] for r in got}) == [1] and got[0]["explained"] == pytest.approx(1.0)
    one = [(i, [1.0, 2.0], 1, "t", "c", "n") for i in range(3)]
    assert whitening.op12_whitening(spark, write_vectors(spark, str(tmp_path / "b"), one)).collect() == []


def test_deviations_are_exact_or_null_beyond_a_long():
    far, near = [1 << 40, 3], [5, -7]
    assert whitening.deviations(np.array([far, near]), 10 ** 6, [9, 4]) == [None, (5 * 10 ** 6 - 9) ** 2 + (7 * 10 ** 6 + 4) ** 2]
    assert whitening.deviations(np.array([[2, 3]]), 4, [1, 20]) == [49 + 64]


# --- op13 -------------------------------------------------------------------

A, B, C = "the same long line of at least forty code points", "é" * 40, "ä" * 39


def line_docs():
    rows = [(i, "\n".join([A, "own %d" % i, B if i % 2 else "x", C])) for i in range(1, 9)]
    rows += [(20, "  %s\t\r\nshort" % A.upper()), (20, A), (20, A + "\n" + A), (None, A + "\nno id"), (None, None),
             (30, "\n\n"), (31, None), (32, ""), (33, A.replace(" ", "\n")), (34, " " + A), (35, corpus.LONG + "\n" + A + "\n" + corpus.LONG),
             (36, "\v" + A + "\f\n" + A.title() + "\n"), (-5, B + "\n" + B + "tail"), (37, "É" * 40)]
    return rows + corpus.awkward() + [(i, t.replace(" ", "\n") + "\n" + t) for i, t in enumerate(corpus.prose(3, 40, 30, 4), 300)]


def test_op13_matches_sql_and_brute_force(spark, tmp_path):
    rows = line_docs()
    path = corpus.write_docs(spark, str(tmp_path), rows)
    got = lines.op13_lines(spark, path)
    same(got, sql(path, "documents", lines.OP13_SQL))

    def key(line):
        return line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})

    holders = {}
    for i, t, *_ in rows:
        for x in (t or "").split("\n"):
            if len(key(x)) >= 40:
                holders.setdefault(key(x), set()).add(i)
    want = []
    for i, t, *_ in rows:
        all_ = (t or "").split("\n")
        kept = [x for x in all_ if len(holders.get(key(x), ())) < 5
                or i == max((h for h in holders[key(x)] if h is not None), default=None)]
        want.append((i, len(all_), len(all_) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    assert sorted(map(str, want)) == sorted(str((r[0], r[1], r[2], r[3])) for r in got.collect())


@pytest.mark.parametrize("batches, fanout", [(1, 2), (2, 2), (5, 2), (4, 3), (9, 4)])
def test_lines_do_not_depend_on_batches_and_levels(spark, batches, fanout):
    docs = spark.createDataFrame([(r[0], r[1]) for r in line_docs()[:20]], "doc_id long, text string")
    plain = sorted(map(str, lines.deduped(docs, 10, 3, 1).collect()))
    assert sorted(map(str, lines.deduped(docs, 10, 3, batches, fanout).collect())) == plain


def test_runs_are_compacted_and_fresh_keys_are_those_no_run_holds(spark):
    runs = lines.LineRuns(spark, 4, fanout=2)
    given = [[(1, 1, 2, 2, 90), (2, 2, 1, 1, 91)], [(2, 2, 3, 4, 80), (3, 3, 1, 1, 81)], [(1, 1, 1, 1, 70)], [(3, 3, 1, 1, 60), (4, 4, 1, 1, 61)]]
    fresh = []
    for batch in given:
        out = runs.add(spark.createDataFrame(batch, "h1 long, h2 long, docs long, n long, holder long"))
        fresh.append(sorted(r["h1"] for r in out.collect() if r["holder"] is not None))
    assert fresh == [[1, 2], [3], [], [4]]
    assert [len(x) for x in runs.levels] == [0, 0, 1]
    assert sorted(map(tuple, runs.merged().collect())) == [(1, 1, 3, 3, 90), (2, 2, 4, 5, 91), (3, 3, 2, 2, 81), (4, 4, 1, 1, 61)]
    run = spark.table(runs.live()[0])
    plan = run.join(run.select("h1", "h2").hint("merge"), ["h1", "h2"])._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    runs.forget()


def test_many_equal_rows_are_salted(spark):
    rows = [(1, A + "\nrest")] * 2500 + [(i, A) for i in range(2, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = lines.deduped(docs).groupBy("doc_id", "n_dropped", "text").count().collect()
    assert sorted(map(tuple, got)) == [(1, 1, "rest", 2500)] + [(i, 1, "", 1) for i in range(2, 6)] + [(6, 0, A, 1)]


def test_no_documents(spark, tmp_path):
    assert lines.op13_lines(spark, corpus.write_docs(spark, str(tmp_path), [])).collect() == []
