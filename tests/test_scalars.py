import hashlib

from pyspark.sql import functions as F

from lakeledger.functions import scalars as S


def one(spark, rows, schema, expr):
    df = spark.createDataFrame(rows, schema)
    return [r[0] for r in df.select(expr).collect()]


def test_slugify(spark):
    got = one(spark, [("American Express",), (" A&B  c ",), ("--",), ("",), (None,)],
              "s string", S.slugify("s"))
    assert got == ["american_express", "ab_c", "--", "unknown", "unknown"]


def test_normalize_bool(spark):
    got = one(spark, [("true",), ("Yes",), (" 0 ",), ("maybe",), (None,)], "s string",
              S.normalize_bool("s"))
    assert got == [True, True, False, None, None]
    assert one(spark, [(2,), (0,), (None,)], "n int", S.normalize_bool("n", "int")) == \
        [True, False, None]


def test_iso_date_parts(spark):
    texts = ["2026-01-10", "20260111", "2026-01-10T05:00:00", "2026", "2026-1-5", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    y, m = S.iso_date_parts("s")
    got = [(r[0], r[1]) for r in df.select(y, m).collect()]
    assert got == [(2026, 1), (2026, 1), (2026, 1), (None, None), (None, None),
                   (None, None), (None, None)]


def test_text_order_of_fractions():
    # ISO texts compare as text: a second without fraction sorts after one with.
    assert "2026-01-13T02:52:47.5Z" < "2026-01-13T02:52:47Z"


def test_event_id_and_coalesce(spark):
    df = spark.createDataFrame([(None, "", "p.json", "added", "t1")],
                               "i string, r string, p string, e string, t string")
    got = df.select(S.event_id("i", "r", "p", "e", "t")).first()[0]
    assert got == hashlib.sha256(b"|unknown|p.json|added|t1").hexdigest()
    c = one(spark, [(None, "  ", "x"), ("", None, None), ("a", "b", "c")],
            "a string, b string, c string", S.coalesce_blank("a", "b", "c"))
    assert c == ["x", None, "a"]


def test_page_name_parts_and_relative_path(spark):
    df = spark.createDataFrame([("page_0012_20260101_120000.json",)], "n string")
    r = df.select(S.page_number("n"), S.page_run_id("n")).first()
    assert (r[0], r[1]) == (12, "20260101_120000")
    u = spark.createDataFrame([("file:/data/raw/a%20b/page_1_x.json",)], "u string")
    assert u.select(S.relative_path(F.col("u"), "file:/data/raw", "raw/")).first()[0] == \
        "raw/a b/page_1_x.json"


def test_json_id_and_is_iso_date(spark):
    got = one(spark, [('{"transaction_id": "t1"}',), ('{"transaction_id": 7}',), ("r9",),
                      ("{}",), (None,)], "s string", S.json_id("s"))
    assert got == ["t1", "7", "r9", None, None]
    ok = one(spark, [("2026-01-10",), ("20260111",), ("2026",), ("2026-1-5",)], "s string",
             S.is_iso_date("s"))
    assert ok == [True, True, False, False]
