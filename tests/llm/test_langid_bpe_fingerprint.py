import hashlib
import random
import zlib

import numpy as np
import pytest
from corpus import LONG, awkward, prose, write_docs

from barkeep.llm import bpe, fingerprint, langid


def fold(i, n):
    return zlib.crc32(("" if i is None else str(i)).encode()) % n


def speech(lang, seed, n):
    rng = random.Random(seed)
    parts = {"xx": ["ka", "mo", "ri", "tu", "she"], "yy": ["über", "straß", "lich", "keit", "ung"], "zz": ["ción", "ñar", "eza", "mente", "los"]}[lang]
    return [" ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(4, 40))) for _ in range(n)]


def test_language_held_out(spark, tmp_path):
    rows = [(i * 3 + k, t, lang, "xx") for k, lang in enumerate(("xx", "yy", "zz")) for i, t in enumerate(speech(lang, k, 150))]
    rows += [(9000 + i, t, None, "q") for i, (_, t) in enumerate(awkward())]
    got = langid.op4_langid(spark, write_docs(spark, str(tmp_path), rows)).collect()
    assert len(got) == len(rows)
    lang = {r[0]: r[2] for r in rows}
    text = {r[0]: r[1] for r in rows}
    held = [r for r in got if r.held_out and lang[r.doc_id]]
    assert len(held) > 50 and np.mean([r.lang_pred == lang[r.doc_id] for r in held]) > 0.98
    for r in got:
        assert r.held_out == (fold(r.doc_id, 5) == 0) and 0 <= r.score <= 1
        letters = any(c.isalpha() for c in text[r.doc_id] or "")
        assert (r.lang_pred == "und") == (not letters) and (letters or r.score == 0)


def test_language_rejects_far_texts(spark, tmp_path):
    rows = [(i, t, "xx") for i, t in enumerate(speech("xx", 1, 80))] + [(500, "qqqq wwww jjjj vvvv qqww jjvv", None)]
    got = {r.doc_id: r for r in langid.op4_langid(spark, write_docs(spark, str(tmp_path), rows)).collect()}
    assert got[500].rejected and got[500].lang_pred == "xx"
    assert np.mean([r.rejected for i, r in got.items() if i < 500]) < 0.15


def test_language_without_training(spark, tmp_path):
    assert {r.lang_pred for r in langid.op4_langid(spark, write_docs(spark, str(tmp_path), awkward())).collect()} == {"und"}


def test_language_no_rows(spark, tmp_path):
    assert langid.op4_langid(spark, write_docs(spark, str(tmp_path), [])).collect() == []


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer
    path = public_tokenizers.path("word_bpe_49k.json")
    return Tokenizer.from_file(path), bpe.Encoder(path)


def tricky():
    rng = random.Random(6)
    texts = ["", " ", "it's we'll I'M they'd've", "a<|endoftext|>b <|startoftext|>", "<|endoftext", "ΑΣ ΣΑΣ", "İstanbul ÉTÉ é", "!!!!?!", "\x1c a\x85b​c",
             "a" * 3000, "1234 ١٢ ½ ²", "漢字かな 🙂🙂", "x_y-z/w\\", LONG[:4000]]
    texts += ["".join(rng.choice("abcdeioutsnr") for _ in range(rng.randint(1, 30))) for _ in range(400)]
    texts += ["".join(chr(rng.randint(32, 0x24f)) for _ in range(25)) for _ in range(200)]
    return texts + prose(7, 100)


def test_tokens_match_the_library(library):
    lib, own = library
    for t in tricky():
        ids, text = own.encode(t)
        want = lib.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, t
        assert text == lib.decode(want, skip_special_tokens=False), t


def test_automaton_has_one_path(library):
    """Every prefix of a word has exactly one accepted path."""
    _, own = library
    a = own.automaton
    for word in ("tokenization", "aaaaaa", "thethethe"):
        paths = {0: {(): -1}}  # prefix length -> path -> state (its last arc)
        for end in range(1, len(word)):
            paths[end] = {(*p, t): t for start in range(end) for t in [a.ids.get(word[start:end])] if t is not None
                          for p, state in paths[start].items() if a.has(state, t)}
            assert len(paths[end]) == 1, word[:end]


def test_word_table_bounds_memory_only(library, monkeypatch):
    lib, _ = library
    import public_tokenizers
    monkeypatch.setattr(bpe, "WORD_TABLE", 5)
    own = bpe.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    for t in prose(9, 20):
        assert np.frombuffer(own.encode(t)[0], "<u4").tolist() == lib.encode(t, add_special_tokens=False).ids
        assert len(own.known) <= 6 and len(own.older) <= 6


def test_bpe_query(spark, tmp_path, library):
    lib, _ = library
    rows = awkward() + [(1000 + i, t) for i, t in enumerate(tricky()) if i < 60]
    got = bpe.op7_bpe(spark, write_docs(spark, str(tmp_path), rows)).collect()
    want = []
    for i, t in rows:
        ids = lib.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(lib.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_workers_hold_no_word_after_a_task(spark, library):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(prose(9, 60))], "doc_id long, text string").repartition(4)
    assert bpe.encoded(docs).count() == 60 and len({r.ids_sha256 for r in bpe.encoded(docs).collect()}) > 1

    def held(batches):
        import pyarrow as pa

        from barkeep.llm import bpe
        for b in batches:
            n = sum(len(e.known) + len(e.older) + len(e.automaton.table) for e in bpe._ENCODERS.values())
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    assert {r.n for r in spark.range(0, 8, 1, 8).mapInArrow(held, "n long").collect()} == {0}


def test_bpe_no_rows(spark, tmp_path):
    assert bpe.op7_bpe(spark, write_docs(spark, str(tmp_path), [])).collect() == []


def brute_fingerprints(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "")), reverse=True)
    texts = [t or "" for _, t in rows]
    after = texts[1:] + texts[:1]
    return [(i, len(t), hashlib.sha256((t[:len(t) - len(t) // 2] + n[:len(t) // 2]).encode()).hexdigest())
            for (i, _), t, n in zip(rows, texts, after)]


@pytest.mark.parametrize(("size", "ranges", "batch"), [(fingerprint.RANGE, 10, 1 << 20), (500, 4096, 300), (500, 5, 1 << 20)])
def test_edited_texts_match_brute_force(spark, tmp_path, monkeypatch, size, ranges, batch):
    monkeypatch.setattr(fingerprint, "BATCH", batch)
    rows = awkward() + [(1000 + 7 * i, t.replace(" a", "\n")) for i, t in enumerate(prose(11, 80))]
    df = spark.read.parquet(write_docs(spark, str(tmp_path), rows) + "/documents.parquet")
    got = fingerprint.with_next(df, fingerprint.edited_report, fingerprint.RESULT, size, ranges).collect()
    assert sorted(((r.doc_id, r.n_chars, r.edited_sha256) for r in got), key=str) == sorted(brute_fingerprints(rows), key=str)
    by_text = {}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        by_text.setdefault([t for i, t in rows if i == r.doc_id][0] or "", set()).add(r.fingerprint)
    assert all(len(v) == 1 for k, v in by_text.items() if k not in ("no id here", ""))
    assert len({f for v in by_text.values() for f in v}) > 80


def test_multiset_is_homomorphic_and_order_free():
    parts = [b"first paragraph of it", b"second one", b"third", b"second one"]
    whole = fingerprint.fingerprints(["first paragraph of it\nsecond one\n\nthird\nsecond one"])
    mixed = fingerprint.fingerprints(["third\r\nsecond one\r\nsecond one\r\nfirst paragraph of it\r\n"])
    assert fingerprint.render(*[x[0] for x in whole]) == fingerprint.render(*[x[0] for x in mixed])
    total = tuple(np.zeros_like(x[0]) for x in whole)
    for p in parts:
        total = fingerprint.add(total, tuple(x[0] for x in fingerprint.paragraph_vectors([p])))
    assert fingerprint.render(*total) == fingerprint.render(*[x[0] for x in whole])
    less = fingerprint.add(total, tuple(x[0] for x in fingerprint.paragraph_vectors([b"third"])), -1)
    again = fingerprint.fingerprints(["second one\nsecond one\nfirst paragraph of it"])
    assert fingerprint.render(*less) == fingerprint.render(*[x[0] for x in again])
    assert all((a == b).all() for a, b in zip(fingerprint.parse(fingerprint.render(*less)), less))


def test_likeness_tracks_shared_paragraphs():
    lines = prose(12, 60, words=30, vocabulary=3000)
    a, prev = "\n".join(lines[:40]), 1.1
    for kept in (40, 30, 20, 10, 0):
        b = "\n".join(lines[40 - kept:40] + lines[:0] + ["z%d %d q%d" % (i, i * i, kept) for i in range(40 - kept)] * 2)
        x, y = fingerprint.fingerprints([a]), fingerprint.fingerprints([b])
        now = float(fingerprint.likeness(x, y)[0])
        assert now < prev
        prev = now
    assert prev < 0.15


def test_likeness_of_one_pair_repeated():
    """40,000, 70,000 and 35,000 of one pair: sums beyond 16 bits."""
    whole, half = fingerprint.fingerprints(["0 " * 70_001]), fingerprint.fingerprints(["0 " * 35_001])
    near = float(fingerprint.likeness(whole, half)[0])
    assert abs(near - 2 * 70_000 * 35_000 / (70_000 ** 2 + 35_000 ** 2)) < 1e-9
    some = fingerprint.fingerprints(["0 " * 40_001])
    assert abs(float(fingerprint.likeness(whole, some)[0]) - 2 * 70_000 * 40_000 / (70_000 ** 2 + 40_000 ** 2)) < 1e-9
    assert all((a == b[0]).all() for a, b in zip(fingerprint.parse(fingerprint.render(*[x[0] for x in whole])), whole))


def test_fingerprint_one_and_no_row(spark, tmp_path):
    one = fingerprint.op8_fingerprint(spark, write_docs(spark, str(tmp_path / "a"), [(5, "abcd")])).collect()
    assert [(r.doc_id, r.edited_sha256) for r in one] == [(5, hashlib.sha256(b"abab").hexdigest())]
    assert fingerprint.op8_fingerprint(spark, write_docs(spark, str(tmp_path / "b"), [])).collect() == []


def test_language_scores_against_dictionaries(spark):
    """Cosine of dictionary TF-IDF vectors with given centroids."""
    from barkeep.llm.common import mix
    rng = np.random.default_rng(3)
    model = langid.Model(["aa", "bb", "cc"], rng.random(langid.BINS).astype(np.float32) + 0.1,
                         np.abs(rng.normal(size=(3, langid.BINS))).astype(np.float32), np.zeros(3))
    model.centroid /= np.linalg.norm(model.centroid, axis=1, keepdims=True)
    texts = ["Ein Satz, noch EIN Satz.", "été 漢字 x", "a", "a1b2", LONG[:3000], "one two\nthree"] + prose(5, 20)

    def brute(text):
        letters = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in text.encode().lower())
        padded, found = b"  " + letters + b"  ", {}
        for i in range(len(padded) - 2):
            g = padded[i:i + 3]
            if g != b"   ":
                code = np.array([g[0] << 16 | g[1] << 8 | g[2]], np.uint64)
                at = int(mix(code)[0]) % langid.BINS
                found[at] = found.get(at, 0) + 1
        weight = {k: np.log1p(n) * float(model.idf[k]) for k, n in found.items()}
        size = sum(w * w for w in weight.values()) ** 0.5
        return [sum(w * float(c[k]) for k, w in weight.items()) / size for c in model.centroid]

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in langid.predicted(docs, model).collect():
        want = brute(texts[r.doc_id])
        assert r.score == pytest.approx(max(want), abs=1e-5) and want[model.langs.index(r.lang_pred)] == pytest.approx(max(want), abs=1e-6)


def test_a_rare_script_keeps_its_centroid():
    rng = random.Random(4)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(80)) for _ in range(300)]
    rare = ["".join(rng.choice("абвгдежз ") for _ in range(80)) for _ in range(5)]          # under 2 % of the language
    idf = np.ones(langid.BINS, np.float32)
    rows = [("xx", v) for v in langid.vectors([t.encode() for t in texts + rare], idf)]
    m = langid.cluster(rows, idf, 5)
    fresh = langid.vectors(["".join(rng.choice("абвгдежз ") for _ in range(80)).encode() for _ in range(5)], idf)
    plain = langid.cluster(rows[:300], idf, 5)
    assert (fresh @ m.centroid.T).max(1).min() > 2 * (fresh @ plain.centroid.T).max(1).max()
