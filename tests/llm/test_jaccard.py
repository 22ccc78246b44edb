import random

import numpy as np
import pytest

from lakeledger.llm import jaccard as J
from lakeledger.llm.util import prepare


def brute(rows):
    """Over all pairs, on the shingles themselves."""
    def shingles(t):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")
        for c in "\t\n\x0b\x0c\r":
            low = low.replace(c, " ")
        w = [x for x in low.split(" ") if x]
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    sets = [(d, shingles(t)) for d, t in rows]
    root = {d: d for d, _ in rows if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = sorted((find(a), find(b)))
                root[q] = p
    return sorted(((d, len(s), find(d) if d is not None else None) for d, s in sets), key=str)


def make(seed, n=160):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "é", "ok."]
    rows = []
    for i in range(n):
        if rows and rnd.random() < 0.6:
            w = (rnd.choice(rows)[1] or "a").split(" ")
            for _ in range(rnd.randint(0, max(1, len(w) // 20))):
                k = rnd.randrange(len(w) + 1)
                w[k:k + rnd.randint(0, 1)] = [rnd.choice(words)] * rnd.randint(0, 1)
            text = " ".join(w)
        else:
            text = " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 3, 5, 6, 9, 14, 30, 80, 200, 600])))
        rows.append((i * 3 - 50, text))
    return rows


@pytest.mark.parametrize("seed,few,block", [(1, 8, 256), (2, 0, 3)])
def test_components_equal_brute_force(spark, monkeypatch, seed, few, block):
    prepare(spark)
    monkeypatch.setattr(J, "FEW", few)
    monkeypatch.setattr(J, "BLOCK", block)
    rows = make(seed) + [(2000, None), (2001, ""), (2002, " \t\n"), (None, "w1 w2 w3 w4 w5 w6"),
                         (2003, "A b C d e"), (2004, "a B c D e"), (2005, "a b"), (2006, "a b"), (2007, "b"),
                         (2008, "x" * 50_000 + " y z a b c"), (2009, "x" * 50_000 + " y z a b c")]
    df = spark.createDataFrame([(*r, 1, "z") for r in rows], "doc_id long, text string, key int, z string")
    got = sorted([tuple(r) for r in J.join(df.repartition(5, "doc_id")).collect()], key=str)
    assert got == brute(rows)
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted(
        (d for d, _, c in brute(rows) if d == c), key=str)


def test_word_hashes_tell_words_apart():
    words = [b"a", b"b", b"ab", b"ba", b"aa", b"aaa", b"\x00", b"\x00\x00", "é".encode(), b"x" * 9000, b"x" * 9001]
    raw = np.frombuffer(b" " + b"  ".join(words + words) + b"\t", np.uint8)
    h = J.word_hashes(raw).tolist()
    assert len(h) == 2 * len(words) and h[:len(words)] == h[len(words):] and len(set(h)) == len(words)
    rng = np.random.default_rng(9)
    many = {bytes(rng.integers(97, 123, rng.integers(1, 9)).astype(np.uint8)) for _ in range(100_000)}
    assert len(set(J.word_hashes(np.frombuffer(b" ".join(many), np.uint8)).tolist())) == len(many)


def test_no_pair_is_missed():
    """Pigeonhole: any two similar sets meet in a key, whatever their sizes."""
    rng = np.random.default_rng(4)
    for _ in range(600):
        n = int(rng.choice([1, 2, 3, 4, 5, 6, 8, 11, 17, 30, 45, 70, 150, 400]))
        a = np.unique(rng.integers(0, 2 ** 63, n).astype(np.uint64))
        common = int(rng.integers(int(0.78 * n), n + 1))
        extra = int(rng.integers(0, n // 4 + 2))
        b = np.unique(np.concatenate([rng.permutation(a)[:common], rng.integers(0, 2 ** 63, extra).astype(np.uint64)]))
        if not len(b):
            continue
        both = len(np.intersect1d(a, b))
        want = 100 * both >= 80 * (len(a) + len(b) - both)
        assert J.similar(a, b) == want
        if want:
            keys = np.concatenate([J.keys_of(a), J.keys_of(b)])
            ids = np.concatenate([np.full(len(J.keys_of(a)), 1), np.full(len(J.keys_of(b)), 2)])
            order = np.argsort(keys, kind="stable")
            assert (1, 2, False) in J.Meetings().feed(keys[order], ids[order])


def test_forced_probes_of_empty_parts(monkeypatch):
    """With far too few parts per set the pigeonhole still holds."""
    monkeypatch.setattr(J, "allocation", lambda k: (J.most_different(*(2 * [J.band_start(k + 1) * 5 // 4])) + 1, 0))
    test_no_pair_is_missed()


def test_stars_and_streams_across_batches():
    m = J.Meetings()
    keys = np.full(40, 8 * 5 + J.EXACT, np.uint64)
    ids = np.arange(40)
    out = m.feed(keys[:7], ids[:7]) + m.feed(keys[7:], ids[7:])
    assert {(a, b) for a, b, s in out if s} == {(0, i) for i in range(1, 40)}


def test_empty_table(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string").limit(0)
    assert J.join(df).count() == 0 and J.keep_one(df).count() == 0
