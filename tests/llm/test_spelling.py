import random
import re
import zlib
from collections import Counter

import pytest

from lakeledger.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(docs, times=3):
    found = Counter()
    for doc, text in docs:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'null' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            found[run] += 1
    words = {w: n for w, n in found.items() if len(w) >= 5 and n >= times}
    form, out = {}, []
    for w in words:
        others = [x for x in words if near(w, x)]
        best = min(others, key=lambda x: (-words[x], x), default=None)
        form[w] = (len(others), best if best and words[best] >= 2 * words[w] else None)
    for w, n in words.items():
        root = w
        while form[root][1]:
            root = form[root][1]
        out.append((w, form[w][1], root, n, form[w][0], words.get(form[w][1])))
    return sorted(out)


def run(spark, docs, **kw):
    df = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, n long, word string")
    out = spelling.variants(df, **kw)
    assert out.columns == COLUMNS
    return sorted(tuple(r) for r in out.collect())


def test_equals_brute_force(spark):
    r = random.Random(3)
    letters = "abé×"
    words = ["".join(r.choice(letters) for _ in range(r.choice([4, 5, 5, 6, 6, 7, 8]))) for _ in range(250)]
    docs = [(i, " ".join(r.choice(words).title() if r.random() < 0.2 else r.choice(words) for _ in range(60)))
            for i in range(60)]
    docs += [(None, "Straße straße STRASSE strasse"), (None, None), (7, ""), (7, "1 2 Ā"), docs[0], docs[0]]
    want = brute(docs)
    assert len(want) > 100 and any(w[1] for w in want) and any(w[2] != w[1] and w[1] for w in want)
    assert run(spark, docs) == want


@pytest.mark.parametrize("size", [5, 6, 7, 8, 9, 10, 11, 13])
def test_every_edit_of_every_place_is_found(spark, size):
    word = "abcdefghijklmnop"[:size]
    others = {word[:i] + word[i + 1:] for i in range(size)} | {word[:i] + "ü" + word[i:] for i in range(size + 1)} \
        | {word[:i] + "ü" + word[i + 1:] for i in range(size)}
    words = spark.createDataFrame([(w, 3) for w in others | {word}], "word string, n long")
    got = sorted((min(r.a, r.b), max(r.a, r.b)) for r in spelling.near_pairs(words).collect())
    every = sorted(others | {word})
    assert got == sorted((a, b) for a in every for b in every if a < b and near(a, b))


def test_long_chain_of_forms_ends_at_the_root(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(37)] + [("x", "w36")], "word string, form string")
    assert {r.root for r in spelling.roots(forms).collect()} == {"w37"}


def test_ties_very_long_runs_and_hash_deletions(spark):
    long = "y" * 50_000
    docs = [(i, f"bandx {long} bandy bandy bandx bandx bandz bandz {long}z") for i in range(400)]
    assert run(spark, docs) == brute(docs)


def test_empty_table(spark):
    assert run(spark, []) == []
