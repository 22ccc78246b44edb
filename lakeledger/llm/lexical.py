"""Ranked lexical search by pipelined term partitioning.

The items' terms are dealt to ``STAGES`` owners, the rarest terms to the first,
each with about as many postings.  An owner's postings are a folder of their
own.  Items travel in bundles; a bundle's scores for a block of documents are a
sparse accumulator (item, document, score), which passes from owner to owner.
At each stage it is cogrouped with that owner's postings of its block, whose
integer contributions are added.  What an item's remaining terms can add at
most is known, so documents that can no longer come among the best of their
block are not carried on (an exact bound; ties stay).  After the last owner the
best of each block are left, and of these the best of all.

Documents are dealt to blocks of about ``BLOCK`` by a hash, so a term that all
documents hold is spread over all tasks, and a group holds one block.  Terms
that no item has leave no postings: the items' vocabulary goes to the tasks up
to ``SEND`` terms; beyond that all postings leave their rows and a join selects
them.

The score is that of the brief: weights floor(1000 * ln((2N + 2) / (2df + 1)))
and whole-number contributions, lengths relative to the mean.

Defined results: null and empty texts have no terms; they are no documents for
N and match nothing, and an item without terms has no result.  Items and
documents are rows: repeated rows are ranked each, equal ids among themselves in
no fixed order but with equal scores.  Null ids come after all others.  Texts of
any length are read whole.  Empty tables give an empty result.  Other columns
play no part, whatever their names.  Ids of documents are whole numbers.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeledger.llm.util import claim, cut, prepare, shared_path

#: Documents returned for an item.
BEST = 20
#: Owners, one after another; documents of a block and items of a bundle, about.
STAGES, BLOCK, BUNDLE = 4, 1024, 256
#: Distinct terms of all items up to which they go to each task.
SEND = 200_000

#: Bytes of terms (0-9, A-Z lower-cased, a-z, all that is not ASCII); others are spaces.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
              for c in range(256))


def terms_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_TERM).split()


def _counted(rows: DataFrame, known: frozenset[bytes] | None) -> DataFrame:
    """(id, row, size, terms, times) of rows (id, row, text): all terms' number,
    and the distinct ones (of ``known``, if given) with their occurrences."""
    kind = rows.schema["id"].dataType.simpleString()
    said = None if known is None else rows.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        claim("lexical")
        of = said.value if said is not None else None
        for b in batches:
            sizes, terms, times = [], [], []
            for t in b.column(2).to_pylist():
                each = terms_of(t)
                found = Counter(each)
                own = found if of is None else of.intersection(found)
                sizes.append(len(each))
                terms.append([w.decode("utf-8", "surrogatepass") for w in own])
                times.append([found[w] for w in own])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.string())),
                 pa.array(times, pa.list_(pa.int64()))], names=["id", "row", "size", "terms", "times"])

    return rows.mapInArrow(run, f"id {kind}, row long, size long, terms array<string>, times array<long>")


def _rows(df: DataFrame, key: str, text: str) -> DataFrame:
    return df.select(F.col(f"`{key}`").alias("id"), F.monotonically_increasing_id().alias("row"),
                     F.col(f"`{text}`").cast("string").alias("text"))


def _exploded(counted: DataFrame) -> DataFrame:
    return counted.select("id", "row", "size", F.explode(F.arrays_zip("terms", "times")).alias("t")).select(
        "id", "row", "size", F.col("t.terms").alias("term"), F.col("t.times").alias("times"))


def _gain(times: Column, size: Column, n: int, length: int) -> Column:
    """An occurrence's contribution, before the term's weight."""
    m = 75 + F.expr(f"(25L * size * {n}L) div {max(length, 1)}L") if length else F.lit(75)
    return F.call_function("div", F.lit(1_000_000_000) * times, 1000 * times + 12 * m.cast("bigint"))


def _owners(sizes: dict[int, int], stages: int) -> dict[int, int]:
    """The owner of each band of document frequencies (powers of two), the
    rarest first, with about equal numbers of postings."""
    whole, so_far, owner = sum(sizes.values()), 0, {}
    for band in sorted(sizes):
        owner[band] = min(stages - 1, (so_far + sizes[band] // 2) * stages // max(1, whole))
        so_far += sizes[band]
    return owner


class _Bundle:
    """A group's accumulator: for its items, the documents with a score."""

    def __init__(self, table: pa.Table):
        self.names = table.column("items").to_pylist()[0]
        query = table.column("query").combine_chunks().flatten()
        self.query = {f: query.field(f).to_numpy(zero_copy_only=False) for f in ("item", "term", "weight", "owner", "most")}
        got = table.column("found").combine_chunks().flatten()
        self.item = got.field("item").to_numpy(zero_copy_only=False)
        self.row = got.field("row").to_numpy(zero_copy_only=False)
        self.score = got.field("score").to_numpy(zero_copy_only=False)
        ids = got.field("id")
        self.ids = ids.fill_null(0).to_numpy(zero_copy_only=False)
        self.null = np.asarray(ids.is_null())

    def add(self, postings: pa.Table, owner: int) -> None:
        """Adds an owner's contributions for the documents of the block."""
        col = {c: postings.column(c).combine_chunks() for c in ("id", "row", "term", "gain")}
        ids, null = col["id"].fill_null(0).to_numpy(zero_copy_only=False), np.asarray(col["id"].is_null())
        term, gain, row = (col[c].to_numpy(zero_copy_only=False) for c in ("term", "gain", "row"))
        rows, first = np.unique(np.concatenate([self.row, row]), return_index=True)
        every_id, every_null = np.concatenate([self.ids, ids])[first], np.concatenate([self.null, null])[first]
        # One block of documents by one bundle of items: both are bounded.
        whole = np.zeros((len(self.names), len(rows)), np.int64)
        whole[self.item, np.searchsorted(rows, self.row)] = self.score
        order = np.argsort(term, kind="stable")
        term, gain, at = term[order], gain[order], np.searchsorted(rows, row)[order]
        lo, hi = (np.searchsorted(term, self.query["term"], side) for side in ("left", "right"))
        for i in np.flatnonzero((self.query["owner"] == owner) & (lo < hi)):
            held = slice(lo[i], hi[i])
            whole[self.query["item"][i], at[held]] += self.query["weight"][i] * gain[held]
        self.item, where = np.nonzero(whole)
        self.score, self.row = whole[self.item, where], rows[where]
        self.ids, self.null = every_id[where], every_null[where]

    def _keep(self, chosen: np.ndarray) -> None:
        self.item, self.row, self.score = self.item[chosen], self.row[chosen], self.score[chosen]
        self.ids, self.null = self.ids[chosen], self.null[chosen]

    def prune(self, owner: int, best: int) -> None:
        """Documents stay that can still come among the best of the block."""
        later = self.query["owner"] > owner
        rest = np.zeros(len(self.names), np.int64)
        np.add.at(rest, self.query["item"][later], self.query["most"][later])
        starts = np.searchsorted(self.item, np.arange(len(self.names) + 1))
        stay = np.ones(len(self.item), bool)
        for i, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
            if b - a > best:
                part = self.score[a:b]
                stay[a:b] = part + rest[i] >= np.partition(part, -best)[-best]
        self._keep(stay)

    def select(self, best: int) -> None:
        """The best of the block for each item, ties by id."""
        order = np.lexsort((self.row, self.ids, self.null, -self.score, self.item))
        self._keep(order)
        starts = np.searchsorted(self.item, self.item, "left")
        self._keep(np.arange(len(self.item)) - starts < best)

    def found(self) -> pa.StructArray:
        return pa.StructArray.from_arrays(
            [pa.array(self.item.astype(np.int32)), pa.array(self.row), pa.array(self.ids, mask=self.null),
             pa.array(self.score)], ["item", "row", "id", "score"])


_QUERY = "array<struct<item:int,term:bigint,weight:bigint,owner:int,most:bigint>>"
_FOUND = "array<struct<item:int,row:bigint,id:bigint,score:bigint>>"


def _nullable(kind: pa.DataType) -> pa.DataType:
    """The same type as Spark's DDL types have it: all fields may be null."""
    if pa.types.is_list(kind):
        return pa.list_(_nullable(kind.value_type))
    if pa.types.is_struct(kind):
        return pa.struct([(f.name, _nullable(f.type)) for f in kind])
    return kind


def _stage(bundles: DataFrame, postings: DataFrame, owner: int, last: bool, best: int, item_type: str) -> DataFrame:
    """Bundles with the contributions of one owner's postings."""
    schema = f"bundle int, block bigint, items array<struct<row:bigint,id:{item_type}>>, query {_QUERY}, found {_FOUND}"

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        claim("lexical")
        if not left.num_rows:  # every block has its bundles
            raise ValueError("postings of an unknown block")
        b = _Bundle(left)
        b.add(right, owner)
        b.select(best) if last else b.prune(owner, best)
        found = b.found()
        same = {c: left.column(c).cast(_nullable(left.schema.field(c).type)) for c in ("bundle", "block", "items", "query")}
        return pa.table(same | {"found": pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), found)})

    key = ["bundle", "block"]
    return bundles.groupBy(*key).cogroup(postings.groupBy(*key)).applyInArrow(run, schema)


def search(items: DataFrame, docs: DataFrame, item_id: str = "item_id", item_text: str = "text",
           doc_id: str = "doc_id", text: str = "text", best: int = BEST, stages: int = STAGES,
           block: int = BLOCK, bundle: int = BUNDLE) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's highest-scoring documents
    with a score above 0."""
    spark = prepare(docs.sparkSession)
    asked = cut(_counted(_rows(items, item_id, item_text), None).where("size > 0"))
    words = asked.select(F.explode("terms").alias("term")).distinct()
    known = [r[0].encode("utf-8", "surrogatepass") for r in words.limit(SEND + 1).collect()]
    small = len(known) <= SEND
    path = shared_path(spark, "lexical-documents")
    (_counted(_rows(docs, doc_id, text), frozenset(known) if small else None)
     .withColumn("id", F.col("id").cast("bigint")).where("size > 0").write.parquet(path))
    counted = spark.read.parquet(path)
    n, length = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    blocks = max(1, math.ceil(n / block))

    # Terms of items: number, weight, owner, and the most that one can add.
    gains = _exploded(counted).withColumn("gain", _gain(F.col("times"), F.col("size"), n, length))
    stats = gains.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("gain").alias("most"))
    if not small:
        stats = stats.join(words, "term", "left_semi")
    stats = stats.select("term", "df", F.floor(1000 * F.log(F.lit(2.0 * n + 2) / (2 * F.col("df") + 1))).alias("weight"),
                         "most", F.floor(F.log2(F.col("df").cast("double"))).cast("int").alias("band"),
                         F.monotonically_increasing_id().alias("number"))
    stats = cut(stats)
    owner = _owners({r[0]: r[1] for r in stats.groupBy("band").agg(F.sum("df")).collect()}, stages)
    of = F.create_map(*[F.lit(x) for pair in owner.items() for x in pair]) if owner else F.create_map()
    stats = stats.withColumn("owner", F.coalesce(F.try_element_at(of.cast("map<int,int>"), F.col("band")), F.lit(0)))

    # Items in bundles, each with its query.
    bundles = max(1, math.ceil(asked.count() / bundle))
    asked = asked.withColumn("bundle", F.pmod(F.xxhash64("row"), F.lit(bundles)).cast("int"))
    lists = asked.groupBy("bundle").agg(F.array_sort(F.collect_list(F.struct("row", "id"))).alias("items"))
    lists = cut(lists)
    place = lists.select("bundle", F.posexplode("items").alias("item", "i")).select("bundle", "item", F.col("i.row").alias("row"))
    stat_side = F.broadcast(stats) if small else stats
    query = _exploded(asked).join(stat_side, "term").join(place, "row")
    query = cut(query.select("bundle", "item", F.col("number").alias("term"), (F.col("weight") * F.col("times")).alias("weight"),
                             "owner", (F.col("weight") * F.col("times") * F.col("most")).alias("most")))
    start = (lists.join(query.groupBy("bundle").agg(F.collect_list(
        F.struct("item", "term", "weight", "owner", "most")).alias("query")), "bundle")
        .select("bundle", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))).alias("block"),
                "items", "query", F.array().cast(_FOUND).alias("found")))

    # Postings, a folder for each owner; a term's go to each bundle that asks for it.
    asking = query.groupBy(F.col("term").alias("number")).agg(F.collect_set("bundle").alias("bundles"))
    dealt = stats.join(asking, "number").select("term", "number", "owner", "bundles")
    home = shared_path(spark, "lexical-postings")
    (gains.join(F.broadcast(dealt) if small else dealt, "term")
     .select(F.explode("bundles").alias("bundle"), F.pmod(F.xxhash64("row"), F.lit(blocks)).alias("block"), "id", "row",
             F.col("number").alias("term"), "gain", "owner").write.partitionBy("owner").parquet(home))
    schema = "bundle int, block bigint, id bigint, row bigint, term bigint, gain bigint, owner int"
    postings = spark.read.schema(schema).parquet(home)

    kind = asked.schema["id"].dataType.simpleString()
    at = start
    for k in range(stages):
        at = _stage(at, postings.where(F.col("owner") == k).drop("owner"), k, k == stages - 1, best, kind)
    hits = at.select("items", F.explode("found").alias("f")).select(
        F.element_at("items", F.col("f.item") + 1).alias("i"), F.col("f.id").alias("doc_id"), F.col("f.score").alias("score"),
        F.col("f.row").alias("row"))
    order = Window.partitionBy("i.row").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= best).select(
        F.col("i.id").alias("item_id"), "rank", "doc_id", "score")


#: The contract in DuckDB's SQL.
ORACLE = """
WITH d AS MATERIALIZED (
  SELECT doc_id, ws, len(ws) AS n FROM (
    SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ws FROM documents) WHERE len(ws) > 0),
s AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM d),
p AS MATERIALIZED (SELECT doc_id, n, w, count(*) AS tf FROM (SELECT doc_id, n, unnest(ws) AS w FROM d) GROUP BY ALL),
q AS (SELECT item_id, w, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
          'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS w FROM benchmark) GROUP BY ALL),
t AS (SELECT w, CAST(floor(1000 * ln((2.0::DOUBLE * any_value(n_docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight
      FROM p, s GROUP BY w),
r AS (
  SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf)
           // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS BIGINT) AS score
  FROM q JOIN t USING (w) JOIN p USING (w), s GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM r WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 20
"""
