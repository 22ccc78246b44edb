"""Running values along a key's order when one key may hold most rows.

A range exchange on (key, order) cuts the rows into segments of about
``SEGMENT_ROWS``, so a key of any size lies in several; the assignment is
pinned in the shared checkpoint folder, so that recomputed tasks see the same
segments.  Where segments are small, a task of the exchange holds many of them,
so the number of tasks, and what their ranges and results send to the driver,
does not grow with the number of segments.  A window runs inside each (key, segment); one row a segment, reduced
in the map tasks, carries the value over the borders.  Keys may hold nulls,
which are values like others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger.session import checkpoint_dir

#: Rows of a segment, about.
SEGMENT_ROWS = 1_000_000


def ranged(df: DataFrame, rows: int, segment_rows: int, order: list, name: str) -> DataFrame:
    """``df`` of ``rows`` rows, pinned in the shared checkpoint folder, with
    ``name``: the number, growing along ``order``, of a segment of about
    ``segment_rows``.  At most as many ranges are made as the session has
    shuffle partitions (more only at over ``SEGMENT_ROWS`` rows in each); if
    that is too few, a sorted range is cut again by the place of its rows."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    wanted = max(1, -(-rows // segment_rows))
    n = min(wanted, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // SEGMENT_ROWS)))
    cut = df.repartitionByRange(n, *order)
    if n == wanted:
        return cut.withColumn(name, F.spark_partition_id().cast("bigint")).checkpoint(eager=True)
    place = F.monotonically_increasing_id()  # the range, then the row's place in it
    cut = cut.sortWithinPartitions(*order).withColumn("__place", place)
    return cut.withColumn(name, F.expr(f"__place div {int(segment_rows)}")).drop("__place").checkpoint(eager=True)


def _cut(df: DataFrame, keys: list[str], order: list[Column], segment_rows: int) -> DataFrame:
    """``df`` with __key, __ord (both structs) and __seg."""
    df = df.withColumns({
        "__key": F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)]),
        "__ord": F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])})
    return ranged(df, df.count(), segment_rows, ["__key", "__ord"], "__seg")


def running_sum(df: DataFrame, keys: list[str], order: list[Column], value: Column, name: str,
                segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``df`` with ``name``: the sum of ``value`` over a key's rows up to and
    with this one.  ``order`` must tell a key's rows apart."""
    cut = _cut(df.withColumn("__value", value), keys, order, segment_rows)
    w = Window.partitionBy("__key", "__seg").orderBy("__ord").rowsBetween(Window.unboundedPreceding, 0)
    rows = cut.withColumn("__in", F.sum("__value").over(w))
    before = Window.partitionBy("__key").orderBy("__seg").rowsBetween(Window.unboundedPreceding, -1)
    total = cut.groupBy("__key", "__seg").agg(F.sum("__value").alias("__t"))
    total = total.select("__key", "__seg", F.sum("__t").over(before).alias("__b"))
    joined = rows.join(total, ["__key", "__seg"])
    zero = F.lit(0).cast(joined.schema["__in"].dataType)
    return joined.select(*df.columns, (F.coalesce("__in", zero) + F.coalesce("__b", zero)).alias(name))


def previous(df: DataFrame, keys: list[str], order: list[Column], value: Column, name: str,
             segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``df`` with ``name``: ``value`` of the key's row before this one, null
    for the first.  ``value`` is never null."""
    cut = _cut(df.withColumn("__value", value), keys, order, segment_rows)
    rows = cut.withColumn("__in", F.lag("__value").over(Window.partitionBy("__key", "__seg").orderBy("__ord")))
    last = cut.groupBy("__key", "__seg").agg(F.max_by("__value", "__ord").alias("__l"))
    carried = F.lag("__l").over(Window.partitionBy("__key").orderBy("__seg"))
    joined = rows.join(last.select("__key", "__seg", carried.alias("__b")), ["__key", "__seg"])
    return joined.select(*df.columns, F.coalesce("__in", "__b").alias(name))
