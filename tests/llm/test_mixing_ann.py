import itertools
import random

import numpy as np
import pytest
from corpus import awkward, prose, words, write, write_docs

from barkeep.llm import ann, mixing


def test_targets_follow_weights_and_caps():
    assert mixing.targets({}) == {}
    got = mixing.targets({"a": 100, "b": 100, "c": 100})
    assert got == {"a": 50.0, "b": 100.0, "c": 150.0}
    got = mixing.targets({None: 10, "b": 400, "a": 1000})     # a: 1, b: 2, null (last): 3
    assert got[None] == 30 and got["b"] == pytest.approx(1380 * 2 / 3) and got["a"] == pytest.approx(460)
    assert mixing.targets({"a": 0, "b": 5}) == {"a": 0.0, "b": 5.0}
    # code points: capitals before small letters, the astral planes last
    got = mixing.targets({"\U0001f642": 100, "￿": 100, "Z": 100})
    assert got["Z"] < got["￿"] < got["\U0001f642"]


def test_fitting_reaches_every_reachable_budget():
    rng = random.Random(1)
    cases = [{7: 2, 10: 2}, {3: 4, 5: 3}, {6: 3, 9: 2, 20: 1}, {4: 3, 6: 2}, {0: 5, 3: 2}]
    cases += [{k: rng.randint(1, 3) for k in rng.sample(range(1, 12), rng.randint(1, 4))} for _ in range(60)]
    for counts in cases:
        sums = {sum(k * n for k, n in zip(counts, c)) for c in itertools.product(*(range(n + 1) for n in counts.values()))}
        for budget in range(sum(k * n for k, n in counts.items()) + 3):
            take = mixing.fitted(counts, budget)
            assert set(take) == set(counts) and all(0 <= take[k] <= counts[k] for k in counts)
            assert sum(k * n for k, n in take.items()) == max(s for s in sums if s <= budget), (counts, budget)


@pytest.mark.parametrize("room", [1, 3, 9])
def test_share_is_given_back_until_the_sum_is_met(monkeypatch, room):
    monkeypatch.setattr(mixing, "ROOM", room)
    rng = random.Random(5)
    for _ in range(300):
        counts = {k: rng.randint(1, 4) for k in rng.sample(range(1, 14), rng.randint(1, 4))}
        sums = {sum(k * n for k, n in zip(counts, c)) for c in itertools.product(*(range(n + 1) for n in counts.values()))}
        budget = rng.randint(0, max(sums))
        assert sum(k * n for k, n in mixing.fitted(counts, budget).items()) == max(s for s in sums if s <= budget)


def test_a_source_is_fitted_to_the_word(spark, tmp_path):
    docs = [(i, " ".join(["w"] * n), None, "a") for i, n in enumerate([7, 7, 10, 10])]
    docs += [(10 + i, "w " * n, None, "b") for i, n in enumerate([9, 9, 8])]       # a: 20 of 60 words, b: 40 (once, then 14)
    got = mixed_rows(spark, write_docs(spark, str(tmp_path), docs))
    assert sum(r[4] for r in got if r[0] < 10) == 20 and sum(r[4] for r in got if r[0] >= 10) == 26 + 9


def test_names_of_the_input_never_clash(spark):
    rows = [(i, "w " * (i % 5), "s", 8, 9, 1, 2, 3, 4) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long, n long, bucket int, doc int, take long, id long")
    got = mixing.mixed(docs).select("doc.*").collect()
    assert sorted(map(tuple, got)) == sorted(rows)


@pytest.mark.parametrize("room", [mixing.ROOM, 50])
def test_large_budgets_close_to_the_word(monkeypatch, room):
    monkeypatch.setattr(mixing, "ROOM", room)
    rng = random.Random(2)
    counts = {k: rng.randint(1, 40) for k in range(1, 300)}
    total = sum(k * n for k, n in counts.items())
    for budget in (1, 7, total // 3, total - 5, total):
        assert sum(k * n for k, n in mixing.fitted(counts, budget).items()) == budget


def mixed_rows(spark, path):
    return sorted((tuple(r) for r in mixing.op5_mixing(spark, path).collect()), key=str)


def test_mix_keeps_its_promises(spark, tmp_path):
    rng = random.Random(3)
    rows = [(i, t, None, rng.choice(["s0"] * 5 + ["s1", "s2", None])) for i, t in enumerate(prose(4, 400))]
    rows += [(1000 + i, "same length text here", None, "s1") for i in range(200)]      # ties of one length
    rows += [(5000, "only", None, "tiny"), (5001, "", None, "void")] + [(i, t, None, None) for i, t in awkward()]
    path = write_docs(spark, str(tmp_path), rows)
    got = mixed_rows(spark, path)
    assert got == mixed_rows(spark, path)
    assert len(got) == len(rows)
    sizes = {}
    for _, t, _, s in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    target = mixing.targets(sizes)
    by_id = {}
    for i, t, _, s in rows:
        by_id.setdefault(i, []).append((len(words(t)), s))
    taken = {}
    for i, size, source_size, aim, took in got:
        held = [s for n, s in by_id[i] if n == size]
        assert held and any(sizes[s] == source_size and target[s] == pytest.approx(aim) for s in held)
        assert took % size == 0 and took <= 3 * size if size else took == 0
        source = next(s for s in held if sizes[s] == source_size)
        taken[source] = taken.get(source, 0) + took
    for s in sizes:
        assert abs(taken.get(s, 0) - target[s]) <= max(1, 0.02 * target[s]) or s in ("tiny", None, "s1"), s


def test_nothing_to_mix(spark, tmp_path):
    assert mixed_rows(spark, write_docs(spark, str(tmp_path), [])) == []


VECS = "vec_id long, embedding array<float>, label int, score double, leaf string"


def brute(rows, k=20):
    good = {}
    dims = [len(v) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    dim = max(set(dims), key=lambda d: (dims.count(d), d), default=0)
    for i, v in rows:
        if i is not None and v and len(v) == dim and all(x is not None and np.isfinite(x) for x in v) and any(v):
            good.setdefault(i, []).append(np.array(v, np.float32).astype(float))
    out = {}
    for q, vs in good.items():
        if q % 20 == 0:
            best = sorted(((max(float(np.add.reduce(w * v)) for v in vs for w in ws), i) for i, ws in good.items() if i != q),
                          key=lambda x: (-x[0], x[1]))[:k]
            out[q] = best
    return out


def vectors(n, dim, seed, clusters=8):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    return [(i, (centres[i % clusters] + 0.4 * rng.normal(size=dim)).astype(np.float32).tolist()) for i in range(n)]


def run(spark, path):
    out = {}
    for r in ann.op6_ann(spark, path).orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.score, r.vec_id))
        assert r.rank == len(out[r.query_id])
    return out


def test_recall_order_and_scores(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 32)
    monkeypatch.setattr(ann, "CHUNK", 100)          # leaves and queries in several parts
    rows = vectors(1500, 12, 1)
    rows += [(2000 + i, rows[0][1]) for i in range(300)]                   # one very common vector
    write(spark, str(tmp_path), "embeddings", [(*r, 1, 0.5, "x") for r in rows], VECS)
    got, want = run(spark, str(tmp_path)), brute(rows)
    assert set(got) == set(want)
    held = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    recall = []
    for q, found in got.items():
        assert len(found) == 20 and q not in [i for _, i in found]
        assert all(s == float(np.add.reduce(held[q] * held[i])) for s, i in found)
        assert found == sorted(found, key=lambda x: (-x[0], x[1]))
        recall.append(np.mean([s >= want[q][-1][0] for s, _ in found]))
    assert np.mean(recall) >= 0.9
    # ties: of the equal vectors those with the least ids
    same = float(np.add.reduce(held[2000] * held[2000]))
    tied = [i for s, i in got[2000] if s == same]
    assert tied == [0, *range(2001, 2020)][:len(tied)]
    unit = [(i, (np.array(v) / np.linalg.norm(v)).astype(np.float32).tolist()) for i, v in rows]
    write(spark, str(tmp_path / "unit"), "embeddings", [(*r, 1, 0.5, "x") for r in unit], VECS)
    assert [i for _, i in run(spark, str(tmp_path / "unit"))[2000]] == [0, *range(2001, 2020)]


def test_bad_vectors_take_no_part_and_few_give_all(spark, tmp_path):
    rows = [(0, [1.0, 0.0]), (20, [0.5, 0.5]), (1, [0.0, 0.0]), (2, None), (3, [1.0, None]), (4, [float("nan"), 1.0]),
            (5, [float("inf"), 1.0]), (40, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (7, [-1.0, 0.0]), (7, [2.0, 0.0]), (60, []), (8, [0.5, 0.5])]
    write(spark, str(tmp_path), "embeddings", [(*r, 1, 0.5, "x") for r in rows], VECS)
    got = run(spark, str(tmp_path))
    assert got == brute(rows) and set(got) == {0, 20}
    assert got[20] == [(1.0, 7), (0.5, 0), (0.5, 8)]


def test_rows_of_an_id_take_one_place(spark, tmp_path, monkeypatch):
    rows = vectors(60, 12, 2)
    write(spark, str(tmp_path / "twice"), "embeddings", [(*r, 1, 0.5, "x") for r in rows * 2], VECS)
    assert run(spark, str(tmp_path / "twice")) == brute(rows)
    near = [(61, (np.array(rows[20][1]) * (2 + i / 50)).astype(np.float32).tolist()) for i in range(40)]
    write(spark, str(tmp_path / "one"), "embeddings", [(*r, 1, 0.5, "x") for r in rows + near], VECS)
    assert run(spark, str(tmp_path / "one")) == brute(rows + near)
    # Leaves full of one id's rows do not end the search.
    monkeypatch.setattr(ann, "LEAF", 16)
    write(spark, str(tmp_path / "leaves"), "embeddings", [(*r, 1, 0.5, "x") for r in rows + near * 3], VECS)
    assert {len(found) for found in run(spark, str(tmp_path / "leaves")).values()} == {20}


def test_leaves_split_as_the_table_grows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ann, "SAMPLE_ROWS", 64)
    monkeypatch.setattr(ann, "LEAF", 16)
    monkeypatch.setattr(ann, "GROW", 40)
    opened, blocks = [], []
    split = ann.grown
    monkeypatch.setattr(ann, "grown", lambda rows, *a: opened.append(split(blocks.append(rows) or rows, *a)) or opened[-1])
    rows = vectors(3000, 12, 5)
    rows += [(4000 + i, rows[20][1]) for i in range(1500)]                 # a third is one vector
    rows += [(20, (np.array(rows[20][1]) * (1 + i / 900)).astype(np.float32).tolist()) for i in range(300)]   # many vectors of one id
    write(spark, str(tmp_path), "embeddings", [(*r, 1, 0.5, "x") for r in rows], VECS)
    got, want = run(spark, str(tmp_path)), brute(rows)
    assert len([t for t in opened if t is not None]) >= 2                  # levels below the top
    sizes = [r.n for r in blocks[-1].where("vec_id < 4000").groupBy("leaf").count().withColumnRenamed("count", "n").collect()]
    assert np.median(sizes) <= 40
    assert set(got) == set(want) and {len(f) for f in got.values()} == {20}
    assert np.mean([np.mean([s >= want[q][-1][0] for s, _ in found]) for q, found in got.items()]) >= 0.9


def test_doubles_keep_their_precision(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=7).tolist()) for i in range(90)]
    docs = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {(r.query_id, r.vec_id): r.score for r in ann.search(docs, lambda i: i % 20 == 0).collect()}
    assert len(got) == 100
    assert all(s == float(np.add.reduce(np.array(rows[q][1]) * np.array(rows[i][1]))) for (q, i), s in got.items())


def test_no_vectors(spark, tmp_path):
    write(spark, str(tmp_path), "embeddings", [], VECS)
    assert run(spark, str(tmp_path)) == {}
