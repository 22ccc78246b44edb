import hashlib
import random
import re

import pytest

from lakeledger.llm import pii as P

EXPRESSIONS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
               "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
               "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def brute(text):
    """The expressions, applied as they are written."""
    out = []
    for kind, x in EXPRESSIONS.items():
        for m in re.finditer(x, text):
            d = re.sub("[^0-9]", "", m.group())
            if {"email": lambda: True, "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                    "card": lambda: 12 <= len(d) <= 19 and P.luhn(d), "phone": lambda: 9 <= len(d) <= 15}[kind]():
                out.append((kind, *m.span()))
    return sorted(out, key=lambda s: (s[1], list(EXPRESSIONS).index(s[0])))


FIXED = ["", "a@b.c", "a@b@c.d", "a@b.c@d.e", "@b.c", "x a.b+c@d-e.f.g. y", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.02.3.4",
         "4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (407) 555-7710 x", "+1 23", "é+49 30 1234 5678é",
         "1" * 4000, "a" * 4000 + "@", "+1" * 300, "1 " * 500]


@pytest.mark.parametrize("text", FIXED)
def test_fixed_texts(text):
    assert P.base_spans(text) == brute(text)


def test_random_texts():
    rnd = random.Random(2)
    for _ in range(6000):
        text = "".join(rnd.choice("ab1234.@+- ()é\n%") for _ in range(rnd.randint(0, 60)))
        assert P.base_spans(text) == brute(text)
    for _ in range(500):
        text = " ".join("".join(rnd.choice("0123456789") for _ in range(rnd.choice([4, 4, 4, 3, 6, 16]))) for _ in range(12))
        assert P.base_spans(text) == brute(text)


def test_luhn():
    assert P.luhn("4111111111111111") and not P.luhn("4111111111111112") and P.luhn("0" * 12)


def _join(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def corpus():
    """Seeds in a context that also holds forms the base does not know."""
    rows = []
    for i in range(12):
        rows.append((i, f"Text {'x' * i} reach me by phone +1 (407) 555-77{i:02d} any time"))
    rows += [(100, "so reach me by phone 407 555 1234 any time"), (101, "the total was 407 555 1234 in all"),
             (102, "code 99999 is not data"), (103, None), (104, ""), (104, ""),
             (None, "so reach me by phone 407 555 1234 any time"), (105, "plain words only " * 3000)]
    return rows


def test_bootstrapping_finds_unseen_identifiers(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, digest string")
    got = P.find(df).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() >= {"doc_id", "digest", "n_email", "spans"}
    texts = {r[0]: r[1] or "" for r in rows}
    for r in got:
        base = brute(texts[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(_join(base).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for k, *_ in base) for x in EXPRESSIONS]
        if r.doc_id in (100, None):
            assert r.spans == "phone:21:33"
        else:
            assert r.spans == _join(base)


def unseen():
    """Text to the spans that patterns should add: as many unseen numbers as
    seeds in one context; the same with one pattern in common; and a context
    that short codes share."""
    out = {}
    for i in range(12):
        w = chr(97 + i)
        out[f"reach me by phone +1 (407) 555-77{i:02d} any time"] = 0
        out[f"reach me by phone 407 555 12{i:02d} any time"] = 1
        out[f"fax it over +1 (407) 556-77{i:02d} {w}"] = 0
        out[f"fax it over 407 556 12{i:02d} {w}{w}"] = 1
        out[f"order number +1 (407) 557-77{i:02d} sent"] = 0
        out[f"order number 124{i:02d} sent"] = 0
        out[f"order number 407 557 12{i:02d} sent"] = 0
    return out


def test_as_many_unseen_identifiers_as_seeds(spark):
    want = unseen()
    df = spark.createDataFrame([(t,) for t in want], "text string").selectExpr("text as id", "text")
    got = {r.id: (len(r.spans.split(",")) if r.spans else 0) - r.n_phone for r in P.find(df).collect()}
    assert got == want


def chain(steps):
    """Seeds in context a; numbers that are also in context b, whose other
    numbers are also in context c, and so on."""
    at = lambda k: f"{chr(97 + k) * 3} {chr(97 + k) * 2}"
    rows = [f"{at(0)} +1 (407) 555-77{i:02d} {at(0)}" for i in range(12)]
    for k in range(steps):
        rows += [f"{at(c)} 407 5{k:02d} 12{i:02d} {at(c)}" for i in range(12) for c in (k, k + 1)]
    return rows


def test_rounds_until_nothing_is_new(spark):
    df = spark.createDataFrame([(t,) for t in chain(6)], "text string").selectExpr("text as id", "text")
    assert [r.id for r in P.find(df).collect() if not r.spans] == []


def test_redaction(spark):
    rows = corpus()
    df = spark.createDataFrame([(*r, len(r[1] or "")) for r in rows], "doc_id long, text string, n_chars long")
    out = {r.doc_id: r for r in P.redact(df).collect()}
    assert out[100].text == "so reach me by phone <PHONE> any time" and out[101].text == rows[13][1]
    assert out[3].text == "Text xxx reach me by phone <PHONE> any time" and out[103].text is None
    assert all(r.text is None or r.n_chars == len(r.text) for r in out.values())
    assert P.redact(df.limit(0)).count() == 0 and P.find(df.limit(0)).count() == 0
    assert P.masked("a@b.c 1.2.3.4", [("email", 0, 5), ("ip", 6, 13), ("ip", 3, 8)]) == "<EMAIL>"


def test_forms_agree(spark):
    items = ["407 555 1234", "1.2.3", "1:2:3:4", "4111 1111 1111 1112", "a@b", "12345", "1.2 3.4", "a1"]
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(i, k) for i in items for k in P.KINDS], "i string, k string")
    for r in df.withColumn("ok", P._allowed(F.col("k"), F.col("i"))).collect():
        assert r.ok == (r.k in P.forms(r.i)), r
