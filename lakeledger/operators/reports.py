"""Spend reports, kept current by differences.

A report holds a number of rows and a sum for each (month, week, category) of
the rows that count: those active in a history.  A refresh gives the rows of the
touched keys before and after; what they add and *retract* is a difference by
group, and only differences are written: a folder for each refresh, with a
folder for each month in it.  Neither the rest of the history nor the report is
read for that, and nothing that is there is changed.  Reading adds the
differences up; asked for some months, it scans their folders alone.

A refresh has a number.  A job that was lost while it wrote is run again with
the same number and replaces its own folder, so no difference counts twice.
``compact`` adds a long row of refreshes up into a new report.

Definitions: a row without a readable date counts in week null and month
``none``, one without a category in category ``none``; a null amount adds
nothing and the row counts.  Weeks begin on Monday.  Sums are exact decimals
with four places, so that what is added can be taken back.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger.functions import scalars as S
from lakeledger.sources import tables

GROUP = ["month", "week", "category"]
NONE = "none"
_SUM = "decimal(38,4)"
_SCHEMA = f"week date, category string, n bigint, amount {_SUM}, refresh bigint, month string"


@dataclass(frozen=True)
class ReportSpec:
    """Columns of the history that a report reads."""
    date: str = "date"
    amount: str = "amount"
    category: str = "pfc_primary"
    counts: str = "is_active"


def totals(history: DataFrame, spec: ReportSpec = ReportSpec(), sign: int = 1) -> DataFrame:
    """(month, week, category, n, amount) of the rows that count."""
    day = S.iso_date(F.col(spec.date).cast("string"))
    rows = history.where(F.col(spec.counts)).select(
        day.alias("day"), F.coalesce(F.nullif(F.col(spec.category).cast("string"), F.lit("")), F.lit(NONE))
        .alias("category"), F.coalesce(F.col(spec.amount).cast("decimal(20,4)"), F.lit(0)).alias("amount"))
    return rows.groupBy(F.coalesce(F.date_format("day", "yyyy-MM"), F.lit(NONE)).alias("month"),
                        F.trunc("day", "week").alias("week"), "category").agg(
        (sign * F.count(F.lit(1))).alias("n"), (sign * F.sum("amount")).cast(_SUM).alias("amount"))


def _added(parts: DataFrame) -> DataFrame:
    return parts.groupBy(*GROUP).agg(F.sum("n").alias("n"), F.sum("amount").cast(_SUM).alias("amount"))


def _some(df: DataFrame) -> DataFrame:
    return df.where((F.col("n") != 0) | (F.col("amount") != 0))


def difference(before: DataFrame, after: DataFrame, spec: ReportSpec = ReportSpec()) -> DataFrame:
    """What a refresh changes: the touched keys' rows ``after`` it are added,
    those ``before`` it retracted.  Groups that stay as they are have no row."""
    return _some(_added(totals(after, spec).unionByName(totals(before, spec, -1))))


def add(change: DataFrame, path: str, refresh: int) -> None:
    """Writes the ``change`` of refresh number ``refresh`` to the report at
    ``path``; the first one, whose rows before are none, makes it."""
    (change.select(*GROUP, "n", "amount").hint("rebalance", "month")
     .write.mode("overwrite").partitionBy("month").parquet(f"{path.rstrip('/')}/refresh={int(refresh)}"))


def _stored(spark: SparkSession, path: str, months: list[str] | None) -> DataFrame:
    if not tables.path_exists(spark, path):
        raise tables.TableNotFound(f"no report at: {path}")
    rows = spark.read.schema(_SCHEMA).parquet(path)
    return rows if months is None else rows.where(F.col("month").isin(months))


def read_report(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """(month, week, category, n, amount) of all ``months`` or the given ones
    (``2024-01``); groups that were emptied are left out."""
    return _some(_added(_stored(spark, path, months)))


def compact(spark: SparkSession, path: str, to: str) -> None:
    """The report at ``path`` as one at ``to``, added up, under the number of
    its last refresh."""
    last = _stored(spark, path, None).agg(F.max("refresh")).first()[0]
    add(read_report(spark, path), to, last or 0)


def roll_up(report: DataFrame) -> DataFrame:
    """Grouping sets over calendar and category: (level, month, week, category,
    n, amount); ``level`` names the columns grouped by, others are null."""
    sets = [["month", "category"], ["week", "category"], ["month"], ["week"], ["category"], []]
    cols = [F.col(c) for c in GROUP]
    by = report.groupingSets([[F.col(c) for c in s] for s in sets], *cols).agg(
        F.sum("n").alias("n"), F.sum("amount").alias("amount"),
        *[F.grouping(c).alias(f"no_{c}") for c in GROUP])
    level = F.concat_ws("+", *[F.when(F.col(f"no_{c}") == 0, F.lit(c)) for c in GROUP])
    return by.select(F.when(level == "", F.lit("all")).otherwise(level).alias("level"), *GROUP, "n", "amount")
