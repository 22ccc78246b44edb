import math

import numpy as np
import pytest

from lakeledger.llm import jaccard, vectors as V
from lakeledger.llm.queries import op3_embeddings
from lakeledger.llm.util import prepare


def brute(rows):
    """Over all pairs of rows (vec_id, vector)."""
    def unit(v):
        if not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            return None
        v = np.array(v, float) / max(map(abs, v))
        return v / np.linalg.norm(v)
    units = [unit(v) for _, v in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    links = [0] * len(rows)
    for i, x in enumerate(units):
        for j, y in enumerate(units[:i]):
            if x is not None and y is not None and len(x) == len(y) and x @ y >= 0.9:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    low = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            low[find(i)] = min(low.get(find(i), k), k)
    return sorted(((k, links[i], low.get(find(i), k), k is not None and k == low[find(i)])
                   for i, (k, _) in enumerate(rows)), key=str)


def make(seed, n=120, dim=24):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.6:
            v = np.array(rows[rng.integers(len(rows))][1]) + rng.normal(0, rng.choice([0.0, 0.02, 0.06]), dim)
        else:
            v = rng.normal(0, 1, dim)
        rows.append((int(i * 7 - 30), [float(np.float32(x)) for x in v]))
    return rows


@pytest.mark.parametrize("seed,few,block", [(1, 8, 512), (2, 1, 6)])
def test_equals_brute_force(spark, monkeypatch, seed, few, block):
    prepare(spark)
    monkeypatch.setattr(jaccard, "FEW", few)
    monkeypatch.setattr(V, "BLOCK", block)
    a = make(seed)
    rows = a + [(9000, None), (9001, []), (9002, [0.0] * 24), (9003, [float("nan")] * 24), (9004, [None] + [1.0] * 23),
                (9005, [1.0]), (9006, [1.0, 0.0]), (9007, [2.0, 0.0]), (9008, [2.0, 0.0]), (None, [2.0, 0.0]),
                (9007, [0.0, 1.0]), (9009, [1e300, 1e300]), (9010, [1e-300, 1e-300]), (9011, [float("inf"), 1.0])]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<double>, rid int, digest string")
    got = sorted([tuple(r) for r in V.near_duplicates(df).collect()], key=str)
    assert got == brute(rows)


@pytest.mark.parametrize("mutual", [0.5, 0.7])
def test_a_common_direction_makes_no_groups(spark, monkeypatch, mutual):
    """All vectors have cosines about ``mutual`` to one another; a few are near."""
    rng = np.random.default_rng(5)
    n, dim = 1500, 64
    x = rng.normal(size=(n, dim)) / math.sqrt(dim)
    x[:, 0] = 0
    x *= math.sqrt(1 - mutual)
    x[:, 0] = math.sqrt(mutual)
    for i in range(0, 200, 2):
        x[i + 1] = x[i] + rng.normal(0, 0.03, dim)
    x[200:260] = x[200] + rng.normal(0, 0.01, (60, dim))  # and one group of copies
    rows = [(i, [float(v) for v in r]) for i, r in enumerate(x)]
    sizes = []
    real = V._clustered
    monkeypatch.setattr(V, "_clustered", lambda c, r, least: (
        sizes.append(c.groupBy("cluster").count().agg({"count": "max"}).first()[0]), real(c, r, least))[1])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.n_links for r in V.near_duplicates(df).collect()}
    want = {k: links for k, links, _, _ in brute(rows)}
    assert sum(want.values()) > 60 * 59 and all(got[k] <= want[k] for k in want)
    assert sum(got.values()) >= 0.95 * sum(want.values())
    assert max(sizes, default=0) <= 200


def test_given_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    assert sorted([tuple(r) for r in op3_embeddings(spark, sf).collect()], key=str) == brute(rows)


def test_hadamard_keeps_lengths_and_is_its_own_inverse():
    x = np.random.default_rng(0).normal(size=(5, 16))
    assert np.allclose(V.hadamard(V.hadamard(x)), x)


@pytest.mark.parametrize("n", [50_000, 20_000_000])
def test_recall_at_the_least_cosine(n):
    rng = np.random.default_rng(1)
    a = rng.normal(size=(1000, 64))
    a /= np.linalg.norm(a, axis=1)[:, None]
    o = rng.normal(size=a.shape)
    o -= (o * a).sum(1)[:, None] * a
    o /= np.linalg.norm(o, axis=1)[:, None]
    b = 0.9 * a + math.sqrt(1 - 0.81) * o
    hashes, tables, probes = V.shape(n, 64)
    x, y = V.buckets(a, tables, hashes, probes), V.buckets(b, tables, hashes, probes)
    met = ((x == y[:, :, :1]) | (y == x[:, :, :1])).any((1, 2))
    assert met.mean() > 0.995


def test_empty_table(spark):
    df = spark.createDataFrame([(1, [1.0])], "vec_id long, embedding array<double>").limit(0)
    assert V.near_duplicates(df).count() == 0
