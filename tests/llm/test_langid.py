import itertools
import zlib

import numpy as np

from lakeledger.llm import langid as L
from lakeledger.llm.queries import PIECES, op7_langid

SF = "/root/testdata/sf0.01"


def cuts(s):
    for marks in itertools.product([0, 1], repeat=len(s) - 1):
        out, at = [], 0
        for i, m in enumerate([*marks, 1]):
            if m:
                out.append(s[at:i + 1])
                at = i + 1
        yield out


def test_forward_and_expected_counts_equal_the_sum_over_all_cuts():
    pieces = [" ", " a", "a", "b", "ab", " ab", "ba", "abab", "c"]
    lattice = L.Lattice(pieces)
    rng = np.random.default_rng(1)
    table = np.concatenate([[0], rng.random(len(pieces)) / 9, [1e-3]])
    words = ["a", "abab", "abcab", "xab", "b", "ababab"]
    counts = np.array([1.0, 2, 3, 1, 5, 1])
    want = np.zeros(len(table))
    got = lattice.forward(lattice.cuts(words), table)
    for w, word in enumerate(words):
        total, use = 0.0, np.zeros(len(table))
        for c in cuts(" " + word):
            at = [lattice.number.get(p, len(table) - 1 if len(p) == 1 else 0) for p in c]
            p = float(np.prod(table[at]))
            total += p
            np.add.at(use, at, p)
        assert np.isclose(got[w, len(word) + 1], total)
        want += counts[w] * use / total
    assert np.allclose(L.expected(lattice, words, counts, table), want)


def test_long_words_equal_the_sum_over_all_cuts(monkeypatch):
    pieces = [" ", " a", "a", "b", "ab", "ba", "abab", "bababababab", "abababababababababab"]
    lattice = L.Lattice(pieces)
    rng = np.random.default_rng(2)
    table = np.concatenate([np.zeros((1, 2)), rng.random((len(pieces), 2)) / 9, np.full((1, 2), 1e-3)])
    words = ["ab" * 18 + "x", "abab" * 10, "b" + "ab" * 17]
    counts = np.array([2.0, 1, 3])
    cut, lengths = lattice.cuts(words), np.array([len(w) + 1 for w in words])
    alpha = lattice.forward(cut, table)
    monkeypatch.setattr(L, "BLOCK", 7)
    for i, w in enumerate(words):
        assert L.words_of(w) == [w]
        assert np.allclose(lattice.long_forward(w, table), np.log(alpha[i, len(w) + 1]))
        assert np.allclose(np.exp(lattice.long_forward(w, table[:, 0])), alpha[i, :len(w) + 2, 0])
    got = L.expected(lattice, words, counts, table[:, 0])
    monkeypatch.setattr(L, "RUN", 1000)
    assert np.allclose(got, L.expected(lattice, words, counts, table[:, 0]))
    # The scorer takes the same way, also beside short words.
    model = L.Model(["p", "q"], np.log([0.5, 0.5]), pieces, table)
    texts = [words[0], f"ab {words[1]} ab"]
    whole = list(L.Scorer(model).judge(texts))
    monkeypatch.setattr(L, "RUN", 32)
    assert [(a, round(b, 9)) for a, b in L.Scorer(model).judge(texts)] == [(a, round(b, 9)) for a, b in whole]
    # Far too long for a plain product.
    assert np.isfinite(lattice.long_forward("x" * 5000, table)).all()


def test_long_pieces_are_used():
    assert {" different", " important", " community"} <= set(L.pieces_of(PIECES))


def test_held_out_accuracy(spark):
    got = op7_langid(spark, SF).collect()
    truth = {r.doc_id: (r.lang, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == len(truth)
    right = []
    for r in got:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1
        if r.held_out and L.words_of(truth[r.doc_id][1]):
            right.append(r.lang_pred == truth[r.doc_id][0])
    assert np.mean(right) >= 0.97


def test_nulls_long_texts_and_no_labels(spark):
    rows = [(1, "the house and the river", "en", "a"), (2, "la maison et le fleuve", "fr", "b"),
            (3, None, "en", "c"), (4, "12 34 !!", "fr", "d"), (5, "", None, "e"), (None, "the", None, "f"),
            (7, "x" * 100_000, None, "g"), (8, "the house " * 20_000, None, "h"), (8, "the house", None, "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score string")
    train = docs.where("doc_id is null or doc_id < 3").withColumn("doc_id", docs.doc_id * 3 + 1)
    model = L.fit(train, PIECES)
    got = {(r.doc_id, i): r for i, r in enumerate(L.predict(docs, model).collect())}
    by = {k[0]: r for k, r in got.items()}
    assert len(got) == len(rows)
    assert [by[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3 and by[3].score == 0
    if model.langs == ["en", "fr"]:
        assert by[8].lang_pred == "en" and by[2].lang_pred == "fr"
    none = L.fit(docs.limit(0), PIECES)
    assert {r.lang_pred for r in L.predict(docs, none).collect()} == {"und"}
    assert L.predict(docs.limit(0), model).count() == 0
