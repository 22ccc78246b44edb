import math
import random
import re
from collections import Counter

import pytest

from lakeledger.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(items, docs, best=20):
    docs = [(d, terms(t)) for d, t in docs]
    docs = [(d, ws, Counter(ws)) for d, ws in docs if ws]
    n, length = len(docs), sum(len(ws) for _, ws, _ in docs)
    df = Counter(w for *_, c in docs for w in c)
    out = []
    for item, text in items:
        scored = []
        for d, ws, c in docs:
            m = 75 + 25 * len(ws) * n // length
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1)))
                        * (1000000000 * c[w] // (1000 * c[w] + 12 * m)) for w in terms(text) if c[w])
            if score > 0:
                scored.append((-score, d is None, d or 0))
        out += [(item, i + 1, None if null else d, -s) for i, (s, null, d) in enumerate(sorted(scored)[:best])]
    return sorted(out, key=str)


def run(spark, items, docs, **kw):
    i = spark.createDataFrame([(a, b, 1) for a, b in items], "item_id long, text string, score int")
    d = spark.createDataFrame([(a, b, "x", 2) for a, b in docs], "doc_id long, text string, id string, row int")
    out = lexical.search(i, d, **kw)
    assert out.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def corpus(n=300, seed=2):
    r = random.Random(seed)
    words = [f"w{int(1.07 ** i)}x{i % 7}" for i in range(110)] + ["Été", "été", "ÉTÉ", "日本", "a_b"]

    def text(k):
        return " ".join(words[min(int(r.expovariate(0.06)), len(words) - 1)] for _ in range(k))
    docs = [(i, text(r.randint(1, 60))) for i in range(n)]
    items = [(i, text(r.randint(1, 25))) for i in range(14)]
    return items, docs


@pytest.mark.parametrize("kw", [{}, {"block": 16, "bundle": 4, "stages": 3}, {"block": 50, "stages": 1}, {"stages": 9, "best": 3}])
def test_equals_brute_force(spark, kw):
    items, docs = corpus()
    want = brute(items, docs, kw.get("best", 20))
    assert len(want) > 30
    assert run(spark, items, docs, **kw) == want


def test_join_beyond_the_vocabulary_that_is_sent(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SEND", 5)
    items, docs = corpus(80)
    assert run(spark, items, docs, block=20, bundle=3) == brute(items, docs)


def test_nulls_repeats_ties_and_long_texts(spark):
    docs = [(5, "Same words HERE"), (4, "same words here"), (4, "same words here"), (None, "same words here"), (1, None),
            (2, ""), (3, "... ---"), (6, "long " * 30_000 + "words"), (7, "other")]
    docs += [(100 + i, "same words here") for i in range(40)]
    items = [(1, "words words here"), (1, "words words here"), (None, "LONG other"), (2, None), (3, ""), (4, "absent")]
    assert run(spark, items, docs, block=8) == brute(items, docs)


def test_bound_keeps_what_can_still_win(spark):
    # The first owners leave all documents equal; the last one decides.
    docs = [(i, f"rare{i % 2} common " + "end " * (i % 9 + 1)) for i in range(90)]
    items = [(1, "rare0 common end"), (2, "end"), (3, "rare1 end end end")]
    assert run(spark, items, docs, stages=4, block=1000, best=2) == brute(items, docs, 2)


def test_empty_tables(spark):
    items, docs = corpus(5)
    assert run(spark, [], docs) == []
    assert run(spark, items, []) == []
    assert run(spark, items, [(1, "none of them")]) == []
