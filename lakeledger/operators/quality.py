"""Integrity checks on Silver and Bronze.

All Silver checks come out of two aggregations (one global pass, one pass
grouped by key with partial aggregation before the shuffle) instead of a
scan per check.  Results are a small DataFrame (check, violations, passed,
detail); ``assert_all`` raises listing every failure.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SILVER_KEYS = ("item_id", "transaction_id")

SILVER_CHECKS = {
    "D1_readable": "the table can be read",
    "D2_one_current_per_key": "no key has two open versions",
    "D3_active_is_current_not_deleted": "every active row is an open version and no tombstone",
    "D4_closed_rows_have_end": "a closed version says when it ended",
    "D5_current_rows_open": "an open version has no end",
    "D6_versions_start_at_1": "the versions of a key count from one",
}


def _row(name, violations):
    return F.struct(F.lit(name).alias("check"),
                    violations.cast("bigint").alias("violations"),
                    F.lit(SILVER_CHECKS[name]).alias("detail"))


def check_silver(df: DataFrame, keys=SILVER_KEYS) -> DataFrame:
    """One pass: row-level counts are summed inside the per-key aggregation
    (partial aggregation before the shuffle), then a global aggregation over
    the key rows."""
    ended = F.coalesce(F.length("valid_to_ts") > 0, F.lit(False))
    open_row = F.col("is_current") & ~F.col("is_deleted")
    d3 = F.col("is_active") & ~open_row
    d4 = ~F.col("is_current") & ~ended
    d5 = F.col("is_current") & ended
    per_key = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(F.col("is_current"), 1).otherwise(0)).alias("curr"),
        F.min("version").alias("min_v"),
        F.count_if(d3).alias("d3"), F.count_if(d4).alias("d4"), F.count_if(d5).alias("d5"))
    g = per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows"),
        F.coalesce(F.max("curr"), F.lit(0)).alias("max_curr"),
        F.coalesce(F.sum("d3"), F.lit(0)).alias("d3"),
        F.coalesce(F.sum("d4"), F.lit(0)).alias("d4"),
        F.coalesce(F.sum("d5"), F.lit(0)).alias("d5"),
        F.count_if(F.col("min_v").isNull() | (F.col("min_v") != 1)).alias("d6"))
    rows = F.array(
        _row("D1_readable", F.lit(0)),
        _row("D2_one_current_per_key", F.when(F.col("max_curr") > 1, F.col("max_curr")).otherwise(0)),
        _row("D3_active_is_current_not_deleted", F.col("d3")),
        _row("D4_closed_rows_have_end", F.col("d4")),
        _row("D5_current_rows_open", F.col("d5")),
        _row("D6_versions_start_at_1", F.col("d6")),
    )
    out = g.select("rows", F.explode(rows).alias("r")).select(
        "r.check", "r.violations", "rows", "r.detail")
    # An empty Silver passes everything after D1.
    return out.withColumn("passed", (F.col("violations") == 0) | (F.col("rows") == 0)) \
        .select("check", "violations", "passed", "detail")


def check_bronze(df: DataFrame, raw_failures: DataFrame | None = None) -> DataFrame:
    """Null keys, repeated event ids, unparsable run times, and
    (given the per-page counts of ``bronze.raw_payload_failures``) values that
    did not cast.  One pass grouped by event id, then a global aggregation."""
    per_id = df.groupBy("event_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("item_id").isNull()).alias("null_item_id"),
        F.count_if(F.col("transaction_id").isNull()).alias("null_transaction_id"),
        F.count_if(F.col("run_ts").isNotNull()
                   & F.try_to_timestamp(F.col("run_ts")).isNull()).alias("bad_run_ts"))
    names = ["null_item_id", "null_transaction_id", "bad_run_ts"]
    g = per_id.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names],
                   F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n") - 1)), F.lit(0))
                   .alias("repeated_event_id"))
    names.append("repeated_event_id")
    structs = [F.struct(F.lit(n).alias("check"), F.col(n).cast("bigint").alias("violations"))
               for n in names]
    out = g.select(F.explode(F.array(*structs)).alias("r")).select("r.check", "r.violations")
    if raw_failures is not None:
        bad = raw_failures.agg(
            F.coalesce(F.sum("bad_amount"), F.lit(0)).cast("bigint").alias("bad_amount"),
            F.coalesce(F.sum("bad_pending"), F.lit(0)).cast("bigint").alias("bad_pending"))
        out = out.unionByName(bad.select(F.explode(F.array(
            F.struct(F.lit("bad_amount").alias("check"), F.col("bad_amount").alias("violations")),
            F.struct(F.lit("bad_pending").alias("check"), F.col("bad_pending").alias("violations")),
        )).alias("r")).select("r.check", "r.violations"))
    return out.withColumn("passed", F.col("violations") == 0)


def assert_all(checks: DataFrame) -> DataFrame:
    """Raise when any check failed, listing all failures; else return checks."""
    bad = checks.filter(~F.col("passed")).collect()  # at most a handful of rows
    if bad:
        lines = "; ".join(f"{r['check']}: violations={r['violations']}" for r in bad)
        raise AssertionError(f"checks failed: {lines}")
    return checks
