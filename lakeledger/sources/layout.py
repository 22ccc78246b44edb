"""The key layout that stored Bronze and Silver share.

Both are plain Parquet folders partitioned by the hash bucket of a
transaction's key.  The partition column names the number of buckets
(``key_bucket_of_16=7``), so a table says itself how it is laid out.  What
changes some keys finds their rows in both tables by the same partition filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.sources import tables

#: Buckets of a new table; for large ones choose a number at which a bucket of
#: Silver is some GB.
KEY_BUCKETS = 16
PREFIX = "key_bucket_of_"


def column(buckets: int) -> str:
    return f"{PREFIX}{buckets}"


def key_bucket(buckets: int) -> Column:
    """The bucket of (item_id, transaction_id); keys are compared as Silver
    holds them, where a null is the text 'None'."""
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in ("item_id", "transaction_id")]
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def stored(spark: SparkSession, path: str) -> int | None:
    """The number of buckets a table is laid out by; None without one.  Only
    names of folders are read."""
    if not tables.path_exists(spark, path):
        return None
    names = [c for c in spark.read.schema("item_id string").parquet(path).columns if c.startswith(PREFIX)]
    return int(names[0].removeprefix(PREFIX)) if names else None


def number(spark: SparkSession, path: str, buckets: int | None = None) -> int:
    """The table's own number of buckets, or ``buckets`` for a new one;
    another number than the table's is refused."""
    own = stored(spark, path)
    if own is not None and buckets is not None and own != buckets:
        raise ValueError(f"the table has {own} buckets, not {buckets}")
    return own or buckets or KEY_BUCKETS


def dealt(df: DataFrame, buckets: int) -> DataFrame:
    """``df`` with its bucket, grouped by it into few files; AQE splits a
    bucket that a hot key makes large."""
    return df.withColumn(column(buckets), key_bucket(buckets)).hint("rebalance", column(buckets))


def touched(df: DataFrame, buckets: int) -> list[int]:
    """The buckets of the keys of ``df``: at most ``buckets`` numbers."""
    return sorted(r[0] for r in df.select(key_bucket(buckets).alias("b")).distinct().collect())


def in_buckets(buckets: int, chosen: list[int]) -> Column:
    return F.col(column(buckets)).isin(chosen)
