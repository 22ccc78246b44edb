"""Groups of spelling variants by asymmetric q-chunks.

Tasks count the words of whole texts; words that are frequent enough are
compared by spelling.  Two words are near if they differ by exactly one
inserted, deleted or replaced code point.

A word of length L gives two disjoint chunks, its first L // 2 code points and
the rest.  One edit leaves one of them whole, and in a near word that is no
longer it then stands at the same place or, if the near word is shorter, one
place to the left.  So a word offers its grams at all positions where a chunk of
a word of its own length or one more can be found again.  The half that was hit
is cut in the same way, which makes a chunk's key three quarters of a word: even
a common beginning or end is held by few.  Chunks meet grams in a join on the
key; the join itself verifies the distance, and takes a pair at the first of its
keys alone, so that only near pairs leave it, each once.

A word's form is its near word with the most occurrences (ties: the smallest in
code-point order), if it has at least twice as many as the word.  Roots follow
the forms to the end by pointer doubling; occurrences double at each step, so
that a few rounds do.

Defined results: null and empty texts have no words; a null id counts as the
text ``null``; repeated rows count again.  Runs of any length are words like
others.  An empty table gives an empty result.  Other columns of the documents
play no part, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.util import claim, cut

#: Code points of a word and occurrences overall, at least.
LENGTH, TIMES = 5, 3
#: One run in so many, by a hash of document and run, loses a code point.
EVERY = 97
#: A form has at least so many times the occurrences of the word.
RATIO = 2
#: Words that a task counts before it passes them on.
COUNTED = 200_000

#: Latin-1 letters of words as bytes, A-Z lower-cased, and all else a space.
_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def runs(text: str) -> list[bytes]:
    """Lower-cased runs of A-Z, a-z and U+00C0 to U+00FF, in Latin-1."""
    return text.encode("latin-1", "replace").translate(_LETTERS).split()


def spoiled(run: bytes, said: int) -> bytes:
    """The run, without a code point if the hash says so.  ``said``: crc32 of
    the document's id and a colon."""
    h = zlib.crc32(run if run.isascii() else run.decode("latin-1").encode(), said)
    if h % EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
           times: int = TIMES) -> DataFrame:
    """(word, n): words of at least ``length`` code points with at least
    ``times`` occurrences in all texts."""

    def some(found: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([w.decode("latin-1") for w in found], pa.string()), pa.array(found.values(), pa.int64())],
            names=["word", "n"])

    def count(batches):
        claim("spelling")
        found: Counter = Counter()
        for b in batches:
            for doc, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                said = zlib.crc32(f"{doc}:".encode())
                for run, n in Counter(r for r in runs(t or "") if len(r) >= length).items():
                    word = spoiled(run, said)
                    if len(word) >= length:
                        found[word] += n
                if len(found) >= COUNTED:
                    yield some(found)
                    found.clear()
        yield some(found)

    rows = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("null")).alias("doc"),
                       F.col(f"`{text}`").cast("string").alias("text"))
    return (rows.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= times))


def _keys(word: Column, size: Column) -> list[Column]:
    """The four keys that ``word`` shares with a word of ``size`` code points
    whose edit hits its last, third, second or first quarter."""
    half = F.floor(size / 2).cast("int")
    quarter, third = F.floor(half / 2).cast("int"), F.floor((size - half) / 2).cast("int")

    def ends(left: Column, right: Column) -> tuple[Column, Column]:
        return F.left(word, left), F.right(word, right)

    zero = F.lit(0)
    parts = [ends(half + third, zero), ends(half, size - half - third), ends(quarter, size - half),
             ends(zero, size - quarter)]
    return [F.xxhash64(F.lit(i), size, *p) for i, p in enumerate(parts)]


def _signed(words: DataFrame, longer: list[int]) -> DataFrame:
    """One row for each key of a word towards words longer by ``longer``."""
    rows = words.withColumn("more", F.explode(F.array(*[F.lit(x) for x in longer])))
    keys = _keys(F.col("word"), F.char_length("word") + F.col("more"))
    rows = rows.select("*", *[k.alias(f"k{i}") for i, k in enumerate(keys)])
    return rows.select("word", "n", "more", "k0", "k1", "k2", F.posexplode(F.array("k0", "k1", "k2", "k3"))
                       .alias("which", "key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(a, a_n, b, b_n): each pair of near words among ``words`` once.  Words
    have at least four code points."""
    a = _signed(words, [0]).select("key", "which", *[F.col(c).alias(f"a_{c}") for c in ("word", "n", "k0", "k1", "k2")])
    b = _signed(words, [0, 1]).select("key", F.col("which").alias("b_which"), "more", *[
        F.col(c).alias(f"b_{c}") for c in ("word", "n", "k0", "k1", "k2")])
    first = F.lit(True)
    for i in range(3):
        first = first & ((F.col("which") <= i) | (F.col(f"a_k{i}") != F.col(f"b_k{i}")))
    met = ((a["key"] == b["key"]) & (F.col("which") == F.col("b_which"))
           & ((F.col("more") == 1) | (F.col("a_word") < F.col("b_word"))) & first
           & (F.levenshtein(F.col("a_word"), F.col("b_word"), 1) == 1))
    return a.join(b, met).select(F.col("a_word").alias("a"), "a_n", F.col("b_word").alias("b"), "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a table (word, form) without circles."""
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = cut(at.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        at = step.drop("moved")
        if step.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH,
             times: int = TIMES, ratio: int = RATIO) -> DataFrame:
    """One row for each word: word, form, root, n, n_near, form_n."""
    if length < 4:
        raise ValueError("words need at least four code points")
    words = cut(counts(docs, doc_id, text, length, times))
    both = near_pairs(words).select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))).alias("p"))
    best = both.select("p.*").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    big = -F.col("best.less") >= ratio * F.col("n")
    out = cut(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(big, F.col("best.near")).alias("form"), F.when(big, -F.col("best.less")).alias("form_n")))
    ends = roots(out.where("form IS NOT NULL"))
    return out.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


#: The contract in DuckDB's SQL: crc32 by its table, near words by the words that deletions leave.
ORACLE = """
WITH RECURSIVE crc(i, k, v) AS (
  SELECT i, 0, CAST(i AS BIGINT) FROM range(256) t(i)
  UNION ALL SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(3988292384, v >> 1) ELSE v >> 1 END FROM crc WHERE k < 8),
tab AS MATERIALIZED (SELECT list(v ORDER BY i) AS t FROM crc WHERE k = 8),
run AS (
  SELECT doc_id, translate(r, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS r, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')) AS r FROM documents)
  GROUP BY ALL HAVING length(r) >= 5),
hashed AS (
  SELECT r, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(
           range(1, octet_length(encode(said)) + 1),
           lambda p: CAST(concat('0x', substr(hex(encode(said)), CAST(2 * p - 1 AS BIGINT), 2)) AS BIGINT))),
           lambda acc, x: xor(acc >> 8, t[1 + (xor(acc, x) & 255)]))) AS h
  FROM (SELECT *, concat(doc_id, ':', r) AS said FROM run), tab),
word AS MATERIALIZED (
  SELECT w, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 97 = 0 THEN concat(left(r, CAST(h % length(r) AS BIGINT)),
                            substr(r, CAST(h % length(r) AS BIGINT) + 2)) ELSE r END AS w FROM hashed)
  WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3),
less AS (SELECT w, n, i, concat(left(w, i - 1), substr(w, i + 1)) AS d
         FROM (SELECT w, n, unnest(range(1, length(w) + 1)) AS i FROM word)),
pair AS (
  SELECT DISTINCT a.w, b.w AS near, b.n AS near_n FROM less a JOIN less b ON a.d = b.d AND a.i = b.i AND a.w != b.w
  UNION SELECT a.w, b.w, b.n FROM less a JOIN word b ON a.d = b.w
  UNION SELECT b.w, a.w, a.n FROM less a JOIN word b ON a.d = b.w),
best AS (SELECT w, count(*) AS n_near, first(near ORDER BY near_n DESC, encode(near)) AS near, max(near_n) AS near_n
         FROM pair GROUP BY w),
formed AS MATERIALIZED (
  SELECT word.w, word.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * word.n THEN near END AS form,
         CASE WHEN near_n >= 2 * word.n THEN near_n END AS form_n
  FROM word LEFT JOIN best ON best.w = word.w),
walk(w, x, k) AS (
  SELECT w, w, 0 FROM formed
  UNION ALL SELECT walk.w, formed.form, k + 1 FROM walk JOIN formed ON formed.w = walk.x WHERE formed.form IS NOT NULL)
SELECT f.w AS word, f.form, r.root, f.n, f.n_near, f.form_n
FROM formed f JOIN (SELECT w, max_by(x, k) AS root FROM walk GROUP BY w) r ON r.w = f.w
"""
