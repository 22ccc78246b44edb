import hashlib
import re

import pytest

from lakeledger.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def norm(t):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, width=10):
    out = []
    for doc, text in docs:
        ws, hit, found = norm(text), set(), set()
        for item, it in items:
            iw = norm(it)
            n = min(width, len(iw))
            wins = {tuple(iw[i:i + n]) for i in range(len(iw) - n + 1)} if iw else set()
            for i in range(len(ws) - n + 1):
                if n and tuple(ws[i:i + n]) in wins:
                    hit |= set(range(i, i + n))
                    found.add(str(item) if item is not None else "null")
        out.append((doc, len(ws), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


DOCS = [(1, None), (2, ""), (3, "a b c d e f g h i j k"), (4, "x A b. C d! e f g h i j y"),
        (5, "a b c d e f g h i x"), (6, "tiny ITEM here tiny item"), (6, "tiny ITEM here tiny item"),
        (None, "É b c d e f g h i j"), (7, "é b c d e f g h i j"), (8, "a b c d e f g h i j " * 2000),
        (9, "a b c d e f g h i j k l m n o p")]
ITEMS = [(10, "A b c d e f g h i j k"), (2, "a b c d e f g h i j"), (3, "tiny item"), (4, ""), (5, None),
         (None, "É b c d e f g h i j"), (6, "g h i j k l m n o p"), (7, "g h i j k l m n o p")]


@pytest.mark.parametrize("limit", [decontam.SET_LIMIT, 3])
def test_equals_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(decontam, "SET_LIMIT", limit)
    docs = spark.createDataFrame([(d, t, "s", 1) for d, t in DOCS], "doc_id long, text string, h string, start int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = decontam.scan(docs, items).drop("spans").collect()
    want = brute(DOCS, ITEMS)
    assert sorted([tuple(r) for r in got], key=str) == want
    kept = decontam.remove_documents(docs, items)
    assert kept.columns == docs.columns
    clean = sorted((d for d, *_, bad in want if not bad), key=str)
    assert sorted((r.doc_id for r in kept.collect()), key=str) == clean


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontam.scan(docs.limit(0), items).count() == 0
    assert decontam.scan(docs, items.limit(0)).where("contaminated or n_items > 0").count() == 0
    assert decontam.remove_documents(docs, items.limit(0)).count() == len(DOCS)


def test_spans_are_the_union_of_windows(spark):
    docs = spark.createDataFrame([(1, "q a b c d e f g h i j k l m n o p z " + "tiny item")], "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    r = decontam.scan(docs, items).first()
    assert [tuple(s) for s in r.spans] == [(1, 17), (18, 20)]


def test_clashing_names_are_kept(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "tiny item", "a", "b"), (2, "clean", "c", "d")],
                                 "doc_id long, text string, __key string, __KEY_ string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    for limit in (decontam.SET_LIMIT, 3):
        monkeypatch.setattr(decontam, "SET_LIMIT", limit)
        assert [tuple(r) for r in decontam.remove_documents(docs, items).collect()] == [(2, "clean", "c", "d")]
