"""Benchmark decontamination with built-in functions alone.

The test items' word windows make a hash set that goes to every task as part
of the plan; a document's windows are hashed where they stand and only those
in the set leave the row.  They are then joined with the items' windows on
hash and words (which verifies them), and a document's hit words are the union
of its verified windows.

The set is sent only while it has at most ``SET_LIMIT`` hashes (the check is a
count).  Beyond that, all windows leave their rows and the join on the hash
does the whole selection.

Defined results: null and empty texts have no words, hit nothing and are
clean; null item ids take part under the name ``null``; equal items each
count.  Rows are told apart by a row number, so repeated rows and null ids
keep one result each.  Texts of any length are read whole.  Columns are kept, whatever
their names.  Empty tables give empty results, or no hits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.util import unused

#: Words of a window.
WIDTH = 10
#: Hashes of item windows up to which the set is part of the plan.
SET_LIMIT = 100_000

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words(text: Column) -> Column:
    """Normalised words: A-Z lower-cased, runs of digits, letters and all
    that is not ASCII.  (``lower`` is the same on ASCII text and faster.)"""
    t = F.coalesce(text.cast("string"), F.lit(""))
    low = F.when(F.length(t) == F.octet_length(t), F.lower(t)).otherwise(F.translate(t, _UPPER, _LOWER))
    return F.regexp_extract_all(low, F.lit(_WORD), F.lit(0))


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` evaluated once for each row."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _hashes(ws: Column) -> Column:
    return F.transform(ws, lambda w: F.xxhash64(w))


def _starts(size: Column, width: int) -> Column:
    """0, 1, ... of the windows of a width; none if it has fewer words."""
    return F.when(size >= width, F.sequence(F.lit(0), size - width)).otherwise(
        F.array().cast("array<int>"))


def item_windows(benchmark: DataFrame, item_id: str = "item_id", text: str = "text",
                 width: int = WIDTH) -> DataFrame:
    """(item, len, h, window) of every item; an item with fewer words than a
    window, but not none, is one window."""
    base = benchmark.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("null")).alias("item"),
                            words(F.col(f"`{text}`")).alias("ws")).where(F.size("ws") > 0)
    size = F.least(F.size("ws"), F.lit(width))
    base = base.select("item", "ws", size.alias("len"), F.explode(
        F.sequence(F.lit(0), F.size("ws") - size)).alias("at"))
    window = F.slice("ws", F.col("at") + 1, F.col("len"))
    return base.select("item", "len", F.xxhash64(_hashes(window)).alias("h"),
                       F.array_join(window, " ").alias("window")).distinct()


def hits(docs: DataFrame, windows: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text, with n_words, and one row for each verified
    window (start, len, item), or one row with nulls if there is none."""
    lens = [r[0] for r in windows.select("len").distinct().limit(WIDTH + 1).collect()]
    known = [r[0] for r in windows.select("h").distinct().limit(SET_LIMIT + 1).collect()]
    small = len(known) <= SET_LIMIT

    def found(ws: Column) -> Column:
        def of(width: int):
            def at(hs: Column) -> Column:
                starts = _starts(F.size(hs), width)

                def h(i):
                    return F.xxhash64(F.slice(hs, i + 1, width))

                if small:
                    starts = F.filter(starts, lambda i: h(i).isin(known))
                return F.transform(starts, lambda i: F.struct(
                    i.alias("start"), F.lit(width).alias("len"), h(i).alias("h"),
                    F.array_join(F.slice(ws, i + 1, width), " ").alias("window")))
            return at
        if not lens or not known:
            return F.array().cast("array<struct<start:int,len:int,h:bigint,window:string>>")
        return _let(_hashes(ws), lambda hs: F.flatten(F.array(*[of(n)(hs) for n in sorted(lens)])))

    keep = [c for c in docs.columns if c != text]
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], F.monotonically_increasing_id().alias("__row"),
                       _let(words(F.col(f"`{text}`")), lambda ws: F.struct(
                           F.size(ws).cast("bigint").alias("n_words"), found(ws).alias("hits"))).alias("__found"))
    each = rows.select(*keep, "__row", F.col("__found.n_words").alias("n_words"),
                       F.explode_outer("__found.hits").alias("__hit"))
    each = each.select(*keep, "__row", "n_words", "__hit.*")
    items = windows.withColumnRenamed("len", "__len")
    if small:
        items = F.broadcast(items)  # at most SET_LIMIT hashes, of the bounded item table
    return (each.join(items, ["h", "window"], "left")
            .select(*keep, "__row", "n_words", "start", "len", "item"))


def scan(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text",
         item_id: str = "item_id", item_text: str = "text", width: int = WIDTH) -> DataFrame:
    """One row for each document: its id, n_words, n_hit, n_items,
    items_sha256 and contaminated; ``spans`` lists the hit words as
    (start, end) word numbers."""
    found = hits(docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text")),
                 item_windows(benchmark, item_id, item_text, width))
    # Each task first reduces its rows; a document has fewer windows than words.
    found = found.groupBy("__row", "doc_id", "n_words").agg(
        F.array_sort(F.collect_set(F.when(F.col("item").isNotNull(), F.struct(
            "start", (F.col("start") + F.col("len")).alias("end"))))).alias("windows"),
        F.array_sort(F.collect_set("item")).alias("items"))
    zero = F.array().cast("array<struct<start:int,end:int>>")
    # Windows by start: one that begins inside the last span (or at its end) makes it longer.
    spans = F.aggregate("windows", zero, lambda acc, w: F.when(
        (F.size(acc) > 0) & (w["start"] <= F.coalesce(F.try_element_at(acc, F.lit(-1))["end"], F.lit(-1))),
        F.concat(F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.struct(
            F.try_element_at(acc, F.lit(-1))["start"].alias("start"),
            F.greatest(F.try_element_at(acc, F.lit(-1))["end"], w["end"]).alias("end")))))
        .otherwise(F.concat(acc, F.array(w))))
    out = found.select(
        "doc_id", "n_words", spans.alias("spans"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"))
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda s, w: s + w["end"] - w["start"])
    return out.withColumn("n_hit", n_hit).withColumn("contaminated", F.col("n_hit") > 0).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans")


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                     item_text: str = "text", width: int = WIDTH) -> DataFrame:
    """``docs`` without the rows that hold a verified window.

    While the set is small its windows are verified where they stand and
    nothing is shuffled; beyond that, rows with a verified window are left
    out by an anti join on all that tells texts apart."""
    windows = item_windows(benchmark, item_id, item_text, width)
    known = windows.select("len", "h", "window").distinct().limit(SET_LIMIT + 1).collect()
    if not known:
        return docs
    if len(known) > SET_LIMIT:
        key = F.sha2(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), 256)
        found = hits(docs.select(key.alias("__key"), F.col(f"`{text}`").alias("text")), windows)
        own = unused("__key", docs.columns)
        found = found.where(F.col("item").isNotNull()).select(F.col("__key").alias(own)).distinct()
        return docs.withColumn(own, key).join(found, own, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])

    def hit(ws: Column) -> Column:
        def of(hs: Column, n: int) -> Column:
            hashes, texts = ([r[k] for r in known if r.len == n] for k in ("h", "window"))
            return F.exists(_starts(F.size(hs), n), lambda i: (
                F.xxhash64(F.slice(hs, i + 1, n)).isin(hashes)
                & F.array_join(F.slice(ws, i + 1, n), " ").isin(texts)))

        def in_hashes(hs: Column) -> Column:
            return F.exists(F.array(*[of(hs, n) for n in sorted({r.len for r in known})]), lambda x: x)
        return _let(_hashes(ws), in_hashes)

    return docs.where(~_let(words(F.col(f"`{text}`")), hit))


#: The contract in DuckDB's SQL.
ORACLE = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
bw AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[i:i + least(len(ws), 10) - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0)),
dw AS (
  SELECT doc_id, n, i, array_to_string(ws[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM bw) WHERE len(ws) >= n)),
h AS (SELECT doc_id, n, i, item_id FROM dw JOIN bw USING (n, win)),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS items
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(c.n_hit, 0) AS n_hit,
       coalesce(t.n_items, 0) AS n_items, sha256(coalesce(t.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN t ON t.doc_id = d.doc_id
"""
