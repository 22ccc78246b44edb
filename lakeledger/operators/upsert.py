"""Tables of the latest row of each key, kept by merging deltas.

A table is bucketed and sorted by its key.  A delta of change events is reduced
to its latest event a key (in the map tasks first), dealt to the table's buckets
and merged with the table where that lies: the base is neither moved nor sorted
again.  The result is the next table; the one before goes when that is complete,
so a merge whose job is lost is simply done again.

An event counts only if it comes after the key's present row in the given order,
so deltas may arrive late or twice.  Deletions stay as tombstones, which are not
read, so that a late event does not bring a deleted row back.  Nulls in a key
are values like others (keys are kept as one struct); equal order leaves the
present row.  An empty delta changes nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.session import checkpoint_dir
from lakeledger.sources import tables


@contextmanager
def _sorted_scans(spark: SparkSession) -> Iterator[None]:
    """Spark trusts the order of tables with one file a bucket, as these have."""
    name = "spark.sql.legacy.bucketedTableScan.outputOrdering"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


class UpsertTable:
    """The latest row of each key of a feed.

    ``order`` are columns that put a key's events in order, ``deleted`` a
    condition (SQL) that says which events delete.  The table is one of the
    session's catalog, with its files below ``home`` (by default the shared
    folder).  Its buckets are as many as the session has shuffle partitions,
    so that a delta is dealt to them by its own exchange."""

    def __init__(self, spark: SparkSession, keys: list[str], order: list[str], deleted: str, home: str | None = None):
        self.spark, self.keys, self.order, self.deleted = spark, list(keys), list(order), deleted
        self.home = (home or checkpoint_dir(spark)).rstrip("/")
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.name: str | None = None

    def _latest(self, delta: DataFrame) -> DataFrame:
        """(key, at, row, gone): a delta's last event of each key."""
        row = F.struct(*[F.col(c) for c in delta.columns])
        at = F.struct(*[F.col(c) for c in self.order])
        rows = delta.select(self._key(delta).alias("key"), at.alias("at"), row.alias("row"),
                            F.coalesce(F.expr(self.deleted), F.lit(False)).alias("gone"))
        last = rows.groupBy("key").agg(F.max(F.struct("at", "gone", "row")).alias("e"))
        return last.select("key", "e.at", "e.row", "e.gone")

    def _key(self, df: DataFrame):
        return F.to_json(F.struct(*[F.col(k).cast("string").alias(k) for k in self.keys]))

    def merged(self, delta: DataFrame) -> DataFrame:
        """The base with the delta, as stored."""
        new = self._latest(delta)
        if self.name is None:
            return new
        new = new.select("key", F.struct("at", "row", "gone").alias("n"))
        base = self.spark.table(self.name).select("key", F.struct("at", "row", "gone").alias("b"))
        both = base.join(new.hint("merge"), "key", "full")
        newer = F.col("b").isNull() | (F.col("n").isNotNull() & (F.col("n.at") > F.col("b.at")))
        both = both.select("key", F.when(newer, F.col("n")).otherwise(F.col("b")).alias("e"))
        return both.select("key", "e.at", "e.row", "e.gone")

    def apply(self, delta: DataFrame) -> str:
        """Merges a delta; the name of the table that results."""
        name = f"upsert_{uuid.uuid4().hex}"
        with _sorted_scans(self.spark):
            (self.merged(delta).write.format("parquet").option("path", f"{self.home}/{name}")
             .bucketBy(self.buckets, "key").sortBy("key").saveAsTable(name))
        old, self.name = self.name, name
        if old is not None:
            self.spark.sql(f"DROP TABLE {old}")
            tables.remove(self.spark, f"{self.home}/{old}")
        return name

    def read(self) -> DataFrame:
        """The present rows, in the columns of the feed."""
        if self.name is None:
            raise tables.TableNotFound("no delta was merged yet")
        return self.spark.table(self.name).where("not gone").select("row.*")
