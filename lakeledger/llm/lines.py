"""Lines repeated across documents, found with levelled sorted runs of hashes.

``LineRuns`` holds what is known of all lines seen so far as runs: Parquet
tables bucketed and sorted by the lines' 128-bit hashes, (key, n documents,
``top``: the largest id that holds it).  ``add`` takes a batch of documents,
whose hashes are shuffled and sorted once.  They are merge-joined with each run
in turn; the runs lie in the same buckets and order, so none of them is moved.
The anti join of the merge says which hashes are new, and only these get a
``top``: batches come in descending order of id, so the first batch with a hash
holds its largest.  Hashes whose number of documents has reached ``COMMON``
already are settled and left out; the rest is the batch's own run, of level 0.
When a level has ``FAN`` runs, they are merged into one of the next.

A hash with ``COMMON`` documents or more is common.  Common hashes are joined
with the documents' lines (a join that Spark splits on hot hashes), each
document's list of hashes to drop is put together, and its lines are dropped
where the text is read.

A line's key is the line without white space (space, U+0009 to U+000D) at both
ends, with A-Z lower-cased; keys of fewer than ``LEAST`` code points are never
dropped.  Of a common key's lines, those in the largest id that holds it stay.

Defined results: null and empty texts are one empty line.  Rows with the same id
are one document when documents are counted, and each is shortened by itself.
A null id is lower than all others.  Lines and texts of any length are hashed
whole.  An empty table gives an empty result.  Other columns are kept, whatever
their names, but for ``n_lines``, ``n_dropped`` and ``kept``, which are replaced.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from lakeledger.llm.util import claim, cut, prepare, shared_path

#: Code points of a key and documents that hold it, at least.
LEAST, COMMON = 20, 3
#: Batches that a whole table is added in; runs of a level that are merged.
BATCHES, FAN = 6, 2

_SPACE = "\t\n\v\f\r "
_LOWER = {c: c + 32 for c in range(65, 91)}
_ASCII_UPPER = re.compile("[A-Z]")


def key_of(line: str) -> str:
    """The line without white space at its ends, A-Z lower-cased."""
    line = line.strip(_SPACE)
    if line.isascii():
        return line.lower()
    return line.translate(_LOWER) if _ASCII_UPPER.search(line) else line


def hash_of(key: str) -> bytes:
    return xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass"))


def keys_of(text: str | None, least: int = LEAST) -> list[bytes | None]:
    """The hash of each line's key; none for keys that are too short."""
    out = []
    for line in (text or "").split("\n"):
        key = key_of(line) if len(line) >= least else ""
        out.append(hash_of(key) if len(key) >= least else None)
    return out


def _hashed(docs: DataFrame, doc_id: str, text: str, least: int) -> DataFrame:
    """(doc, body, keys) of each row: a hash of the text, the distinct hashes."""

    def run(batches):
        claim("lines")
        for b in batches:
            keys = [list({k for k in keys_of(t, least) if k}) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(keys, pa.list_(pa.binary()))],
                                             names=["doc", "body", "keys"])

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc"), _body(text), F.col(f"`{text}`").cast("string").alias("t"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, body long, keys array<binary>")


def _body(text: str) -> Column:
    """Tells texts of one id apart (with the id, it names a row's lines)."""
    return F.xxhash64(F.col(f"`{text}`").cast("string")).alias("body")


@contextmanager
def _sorted_scans(spark: SparkSession) -> Iterator[None]:
    """Spark trusts the order of tables with one file a bucket, as runs have."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class LineRuns:
    """What is known of the lines of all batches so far.  The runs have as many
    buckets as the session has shuffle partitions when it is made."""

    def __init__(self, spark: SparkSession, doc_type: str, common: int = COMMON, fan: int = FAN):
        self.spark, self.doc_type = prepare(spark), doc_type
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.common, self.fan = common, fan
        self.levels: list[list[str]] = [[]]

    def _save(self, df: DataFrame) -> str:
        """A run: a table of the session, bucketed and sorted by key, with its
        files in the shared folder."""
        name = f"line_run_{uuid.uuid4().hex}"
        with _sorted_scans(self.spark):
            (df.write.format("parquet").option("path", shared_path(self.spark, name))
             .bucketBy(self.buckets, "key").sortBy("key").saveAsTable(name))
        return name

    @property
    def runs(self) -> list[str]:
        return [name for level in self.levels for name in level]

    def add(self, lines: DataFrame) -> None:
        """A batch of (doc, key); its ids are lower than those of all batches
        before (or the same, or null)."""
        each = lines.groupBy("key", "doc").agg(F.lit(1).alias("one"))  # ids that rows share count once
        mine = each.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc").alias("top"))
        before = F.lit(0)
        for i, name in enumerate(self.runs):
            run = self.spark.table(name).select("key", F.col("n").alias(f"n{i}"))
            mine = mine.join(run.hint("merge"), "key", "left")
            before = before + F.coalesce(f"n{i}", F.lit(0))
        fresh = before == 0
        mine = mine.where(before < self.common).select(
            "key", "n", F.when(fresh, F.col("top")).alias("top"))
        self.levels[0].append(self._save(mine))
        for level, names in enumerate(self.levels):
            if len(names) >= self.fan:
                if level + 1 == len(self.levels):
                    self.levels.append([])
                self.levels[level + 1].append(self._save(self._merged(names)))
                self._forget(names)
                self.levels[level] = []

    def _merged(self, names: list[str]) -> DataFrame:
        """One run of several: numbers are added; at most one has a ``top``.  Two
        runs merge where they lie."""
        whole = self.spark.table(names[0])
        for name in names[1:]:
            other = self.spark.table(name).select("key", F.col("n").alias("m"), F.col("top").alias("other"))
            whole = whole.join(other.hint("merge"), "key", "full").select(
                "key", (F.coalesce("n", F.lit(0)) + F.coalesce("m", F.lit(0))).alias("n"),
                F.coalesce("top", "other").alias("top"))
        return whole

    def _forget(self, names: list[str]) -> None:
        """Merged runs go: the entries, and their files (written by ``_save``)."""
        for name in names:
            where = [r.data_type for r in self.spark.sql(f"DESCRIBE FORMATTED {name}").collect()
                     if r.col_name == "Location"][0]
            self.spark.sql(f"DROP TABLE {name}")
            path = self.spark._jvm.org.apache.hadoop.fs.Path(where)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def common_keys(self) -> DataFrame:
        """(key, top) of the hashes with enough documents, kept in the shared
        folder."""
        schema = f"key binary, n long, top {self.doc_type}"
        whole = self._merged(self.runs) if self.runs else self.spark.createDataFrame([], schema)
        with _sorted_scans(self.spark):
            return cut(whole.where(F.col("n") >= self.common).select("key", "top"))

    def close(self) -> None:
        """All runs go."""
        self._forget(self.runs)
        self.levels = [[]]


def _bounds(rows: DataFrame, batches: int) -> list:
    """Ids that cut the table into about equal batches, descending.  (Where
    they lie changes no result.)"""
    if batches < 2:
        return []
    at = rows.select(F.percentile_approx("doc", [i / batches for i in range(batches - 1, 0, -1)], 1000)).first()[0]
    return sorted(set(at or []), reverse=True)


def drop_repeated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", least: int = LEAST,
                  common: int = COMMON, batches: int = BATCHES) -> DataFrame:
    """``docs`` without the text, with n_lines, n_dropped and ``kept``, the text
    without the lines that go.  Ids are numbers or dates."""
    spark = prepare(docs.sparkSession)
    path = shared_path(spark, "lines")
    _hashed(docs, doc_id, text, least).write.parquet(path)
    rows = spark.read.parquet(path)
    kind = rows.schema["doc"].dataType.simpleString()
    index = LineRuns(spark, kind, common)
    above = None
    for bound in [*_bounds(rows, batches), None]:
        part = F.lit(True) if bound is None else F.col("doc") >= bound
        if above is not None:  # null ids are of the last batch
            part = part & ((F.col("doc") < above) | F.col("doc").isNull())
        index.add(rows.where(part).select("doc", F.explode("keys").alias("key")))
        above = bound
    each = rows.select("doc", "body", F.explode("keys").alias("key"))
    known = index.common_keys()
    index.close()
    gone = (each.join(known, "key").where(~F.col("doc").eqNullSafe(F.col("top")))
            .select(F.struct("doc", "body").alias("row"), "key")
            # One text's own hashes; rows equal in id and text repeat them.
            .groupBy("row").agg(F.collect_set("key").alias("gone")))
    keep = [c for c in docs.columns if c not in (text, "n_lines", "n_dropped", "kept")]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("rest"),
                        F.col(f"`{text}`").cast("string").alias("text"),
                        F.struct(F.col(f"`{doc_id}`").alias("doc"), _body(text)).alias("row"))
    found = whole.join(gone, "row", "left").select("rest", "text", "gone")

    def run(parts):
        claim("lines")
        for b in parts:
            n_lines, n_dropped, kept = [], [], []
            for t, lost in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                lines = (t or "").split("\n")
                stay = lines
                if lost:
                    lost = set(lost)
                    stay = [x for x, key in zip(lines, keys_of(t, least)) if key not in lost]
                n_lines.append(len(lines))
                n_dropped.append(len(lines) - len(stay))
                kept.append("\n".join(stay))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64()),
                 pa.array(kept, pa.string())], names=["rest", "n_lines", "n_dropped", "kept"])

    out = found.mapInArrow(run, StructType([found.schema["rest"], StructField("n_lines", LongType()),
                                            StructField("n_dropped", LongType()), StructField("kept", StringType())]))
    return out.select("rest.*", "n_lines", "n_dropped", "kept")


#: The contract in DuckDB's SQL.
ORACLE = """
WITH line AS (
  SELECT doc_id, i, x, translate(trim(x, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))),
           'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, unnest(xs) AS x, unnest(range(len(xs))) AS i
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS xs FROM documents))),
common AS (SELECT key, max(doc_id) AS top FROM line WHERE length(key) >= 20
           GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*) AS n_lines, count(top) FILTER (WHERE top != doc_id) AS n_dropped,
       sha256(coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (WHERE top IS NULL OR top = doc_id), ''))
         AS kept_sha256
FROM line LEFT JOIN common USING (key) GROUP BY doc_id
"""
