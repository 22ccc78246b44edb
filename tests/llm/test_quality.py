import zlib

import numpy as np

from lakeledger.llm import quality as Q
from lakeledger.llm.queries import op10_quality

SF = "/root/testdata/sf0.01"


def test_score_equals_the_sum_over_all_pairs():
    rng = np.random.default_rng(3)
    m = Q.Machine(0.3, rng.normal(0, 1, Q.SIZE), rng.normal(0, 0.5, (Q.SIZE, Q.FACTORS)))
    for text in ("a b c d", "", "One two two.\nOne two two.", "!!! ### 123"):
        idx, val = Q.features(text)
        z = m.bias + sum(m.linear[i] * x for i, x in zip(idx, val))
        for a in range(len(idx)):
            for b in range(a):
                z += float(m.factors[idx[a]] @ m.factors[idx[b]]) * val[a] * val[b]
        assert abs(m.score(idx, val) - 1 / (1 + np.exp(-z))) < 1e-9


def test_interactions_are_learned():
    """The label is the exclusive or of two words: no linear model can tell."""
    rng = np.random.default_rng(0)
    rows = []
    for _ in range(800):
        a, b = rng.integers(0, 2, 2)
        idx, val = np.array([10 + a, 20 + b]), np.array([1.0, 1.0])
        rows.append((idx, val, int(a != b)))
    m = Q.train(rows, epochs=60, rate=0.2, decay=0.0)
    assert np.mean([(m.score(i, v) >= 0.5) == bool(y) for i, v, y in rows]) > 0.95


def test_held_out_accuracy_and_rows(spark):
    got = {r.doc_id: r for r in op10_quality(spark, SF).collect()}
    assert len(got) == spark.read.parquet(f"{SF}/documents.parquet").count()
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    for d, r in got.items():
        assert r.held_out == (zlib.crc32(str(d).encode()) % 3 == 1)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [(got[d].predicted, y) for d, y in labels.items() if got[d].held_out]
    assert np.mean([p == y for p, y in held]) >= 0.97


def test_nulls_repeats_long_texts_and_no_labels(spark):
    docs = spark.createDataFrame([(1, None, "a"), (None, "", "b"), (2, "word " * 60_000, "c"), (2, "x", "d"),
                                  (2, "x", "d")], "doc_id long, text string, idx string")
    labels = spark.createDataFrame([(1, None), (2, 7), (None, 1)], "doc_id long, quality int")
    machine = Q.fit(docs, labels)
    rows = Q.score(docs, machine).collect()
    assert len(rows) == 5 and all(r.score == 0.5 for r in rows)
    assert Q.keep_good(docs, machine).columns == docs.columns and Q.keep_good(docs, machine).count() == 5
    assert Q.score(docs.limit(0), machine).count() == 0
    one = Q.fit(docs, spark.createDataFrame([(2, 1), (3, 0)], "doc_id long, quality int"))
    assert all(0 <= r.score <= 1 for r in Q.score(docs, one).collect())
