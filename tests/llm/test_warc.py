import hashlib

import pytest

from lakeledger.llm import warc

LONG = "<p>équal \r\n\r\n payload\r\n\r\n</p>" + "x" * 100
ROWS = [(5, "http://a/\r\nX: y", LONG), (3, "http://b/", LONG), (9, None, LONG), (None, "http://n/", LONG),
        (1, "http://c/", None), (2, "http://c/", ""), (4, "http://d/", "short"), (6, "http://d/", "short"),
        (7, "http://e/", "\r\n\r\n"), (8, "http://e/", "\r\n\r\n" * 40), (10, "http://e/", "\r\n\r\n" * 40),
        (11, "http://f/", "WARC/1.1\r\n\r\nWARC/1.1" * 30), (12, "http://g/", "y" * 500_000),
        (13, "http://h/", "z" * 200), (13, "http://h/", "z" * 200), (14, "http://h/", "z" * 99), (15, "u", "z" * 99)]


def want(rows):
    out = []
    for pid, _, body in rows:
        raw = (body or "").encode()
        same = [p for p, _, b in rows if (b or "").encode() == raw]
        ids = [p for p in same if p is not None]
        first = min(ids) if len(same) > 1 and ids and len(raw) >= 100 else None
        again = first is not None and pid != first
        out.append((pid, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response",
                    first if again else None))
    return sorted(out, key=str)


def test_equals_definition(spark, tmp):
    df = spark.createDataFrame([(*r, "x", 1) for r in ROWS],
                               "page_id long, url string, html string, digest string, first int")
    out = warc.archive(df, f"{tmp}/w")
    assert out.where("not resolved").count() == 0
    got = out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted([tuple(r) for r in got], key=str) == want(ROWS)
    urls = {r.page_id: r.url for r in out.collect()}
    assert urls[5] == "http://a/%0D%0AX: y" and urls[9] is None
    # A second pass over what was read writes the same roles.
    assert warc.archive(df.orderBy("html"), f"{tmp}/w2").where("record_type = 'revisit'").count() == 4


ENDS = ["\r\n", "\r\n" * 3, "\r\n" * 5, "\r", "\n", "\r\n\r", "\n\r\n", "\r\n\n", "\r\r\n"]


def test_payloads_that_end_in_line_ends(spark, tmp):
    rows = [(i, "u", b + e) for i, (b, e) in enumerate((b, e) for b in ("", "a", "b" * 200) for e in ENDS)]
    rows += [(100 + i, "u", b) for i, _, b in rows if i % 2]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    # One file, so that records follow each other in this order, and in the other.
    for n, order in enumerate((df.page_id.asc(), df.page_id.desc())):
        out = warc.archive(df.orderBy(order).coalesce(1), f"{tmp}/w{n}")
        assert out.where("not resolved").count() == 0
        got = out.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
        assert sorted([tuple(r) for r in got], key=str) == want(rows)
    # Each as the last record of its archive.
    for i, e in enumerate(ENDS):
        one = spark.createDataFrame([(i, "u", "c" + e)], "page_id long, url string, html string")
        got = warc.archive(one, f"{tmp}/last{i}").collect()
        assert [(r.payload_bytes, r.resolved) for r in got] == [(1 + len(e), True)], repr(e)


def test_empty_table(spark, tmp):
    df = spark.createDataFrame(ROWS, "page_id long, url string, html string").limit(0)
    assert warc.archive(df, f"{tmp}/w").count() == 0


def test_missing_original_and_broken_archives(spark):
    recs = spark.createDataFrame([(1, None, "revisit", "b", "gone", 7, None, "d", None)], warc.RECORD)
    assert [r.resolved for r in warc.resolve(recs).collect()] == [False]
    with pytest.raises(ValueError):
        list(warc.records([b"nonsense"]))
    with pytest.raises(ValueError):
        list(warc.records([b"WARC/1.1\r\nContent-Length: 9", b"abc"]))
    with pytest.raises(ValueError):
        list(warc.records([b"WARC/1.1\r\nContent-Length: 2", b"abc"]))
