"""Named reads of Silver."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.functions import scalars as S


def all_versions(df: DataFrame) -> DataFrame:
    return df


def current(df: DataFrame) -> DataFrame:
    """Present state without tombstones (``is_active``)."""
    return df.filter(F.col("is_active") == F.lit(True))


def current_including_deleted(df: DataFrame) -> DataFrame:
    """Last version of every key, tombstones included (``is_current``)."""
    return df.filter(F.col("is_current") == F.lit(True))


def as_of(df: DataFrame, ts: str, typed: bool = False) -> DataFrame:
    """Versions valid at ``ts``: ``valid_from_ts <= ts < valid_to_ts`` (an
    open end counts as infinity).  Zero-length versions are never visible.
    Text comparison by default (ISO texts of one format); ``typed`` compares
    parsed times."""
    if typed:
        t = S.parse_iso(F.lit(ts))
        f, to = S.parse_iso("valid_from_ts"), S.parse_iso("valid_to_ts")
    else:
        t, f, to = F.lit(ts), F.col("valid_from_ts"), F.col("valid_to_ts")
    return df.filter((f <= t) & (F.col("valid_to_ts").isNull() | (to > t)))


VIEWS = {
    "silver_transactions_all": all_versions,
    "silver_transactions_current": current,
    "silver_transactions_current_including_deleted": current_including_deleted,
}


def register(df: DataFrame) -> None:
    """Register the three views as temp views for SQL users."""
    for name, fn in VIEWS.items():
        fn(df).createOrReplaceTempView(name)
