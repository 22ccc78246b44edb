"""Audit reports over the landed page set (and the runs log).

Windows never run over a whole item: an item's page chain is cut into runs
(level 1: pages of one run) and the hand-over between runs is read from one
summary row per run (level 2).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeledger import schemas
from lakeledger.functions import scalars as S
from lakeledger.session import checkpoint_dir

RUN = ["institution", "item_id", "run_id"]


def _with_page_no(pages: DataFrame) -> DataFrame:
    if "page_no" in pages.columns:
        return pages
    return pages.withColumn("page_no", S.page_number("page_name"))


def _size(c: str):
    return F.coalesce(F.size(F.col(c)), F.lit(0)).cast("bigint")


def _page_rows(pages: DataFrame) -> DataFrame:
    p = _with_page_no(pages)
    return p.select(
        "run_id", F.col("page_no").alias("page"), "institution", "item_id",
        F.coalesce("cursor_in", F.lit("")).alias("cursor_in"),
        F.coalesce("cursor_out", F.lit("")).alias("cursor_out"),
        _size("added").alias("added"), _size("modified").alias("modified"),
        _size("removed").alias("removed"),
        F.coalesce("has_more", F.lit(False)).alias("has_more"), "page_path", "run_ts")


def page_log(pages: DataFrame) -> DataFrame:
    """One record per landed page."""
    return _page_rows(pages).drop("run_ts")


def page_counts(bronze: DataFrame) -> DataFrame:
    """A5: events per page and type, from Bronze."""
    return bronze.groupBy(*RUN, "page_path").agg(
        *[F.count_if(F.col("event_type") == t).cast("bigint").alias(t)
          for t in ("added", "modified", "removed")])


def _run_rows(pages: DataFrame) -> DataFrame:
    """Level 2 input: one row per run with its first and last page."""
    return _page_rows(pages).groupBy(*RUN).agg(
        F.count(F.lit(1)).alias("pages"),
        F.sum("added").alias("added"), F.sum("modified").alias("modified"),
        F.sum("removed").alias("removed"),
        F.min_by("cursor_in", "page").alias("cursor_start"),
        F.max_by("cursor_out", "page").alias("cursor_end"),
        F.max_by("has_more", "page").alias("last_has_more"),
        F.max("page").alias("last_page"),
        F.min("run_ts").alias("run_ts"))


def run_summary(pages: DataFrame) -> DataFrame:
    """R2 + V10: per run, pages and event totals, first and last cursor, and
    the mode (backfill when the run started without a cursor)."""
    r = _run_rows(pages)
    return r.select(
        *RUN, F.col("pages").cast("bigint").alias("pages"),
        F.col("added").cast("bigint").alias("added"),
        F.col("modified").cast("bigint").alias("modified"),
        F.col("removed").cast("bigint").alias("removed"),
        "cursor_start", "cursor_end",
        F.when(F.col("cursor_start") == "", F.lit("backfill"))
        .otherwise(F.lit("incremental")).alias("mode"))


def unfinished_runs(pages: DataFrame) -> DataFrame:
    """Runs whose last landed page still says ``has_more``."""
    r = _run_rows(pages)
    return r.filter(F.col("last_has_more")).select(
        *RUN, F.col("last_page").alias("last_page"), "cursor_end")


def cursor_state(pages: DataFrame) -> DataFrame:
    """Per item, the state after its newest page (by run time, then
    page number): a partial aggregation, no window over the item."""
    p = _page_rows(pages)
    newest = F.max_by(F.struct("run_id", "page", "cursor_out", "cursor_in"),
                      F.struct(S.parse_iso("run_ts"), F.col("run_id"), F.col("page")))
    g = p.groupBy("institution", "item_id").agg(newest.alias("s"),
                                                F.max("run_ts").alias("updated_at"))
    return g.select("institution", "item_id", F.col("s.run_id").alias("run_id"),
                    F.col("s.cursor_out").alias("next_cursor"),
                    F.col("s.page").alias("last_page_written"), "updated_at")


def cursor_chain(pages: DataFrame) -> DataFrame:
    """Every page with the cursor it should have started from.

    Level 1: inside a run, the previous page's ``cursor_out``.  Level 2: for
    a run's first page, the previous run's last ``cursor_out`` ('' for the
    item's first run)."""
    # The pages' few columns are pinned once; both levels read that copy, not
    # the page set again.
    checkpoint_dir(pages.sparkSession)
    p = _page_rows(pages).select(*RUN, "page", "cursor_in", "cursor_out", "page_path", "run_ts").checkpoint(eager=True)
    w = Window.partitionBy(*RUN).orderBy("page")
    r = p.groupBy(*RUN).agg(F.max_by("cursor_out", "page").alias("cursor_end"), F.min("run_ts").alias("run_ts"))
    p = p.withColumn("prev_out", F.lag("cursor_out").over(w))
    w2 = Window.partitionBy("institution", "item_id").orderBy(
        S.parse_iso("run_ts").asc_nulls_first(), "run_id")
    r = r.select(*RUN, F.coalesce(F.lag("cursor_end").over(w2), F.lit(""))
                 .alias("prev_run_out"))
    # Any of a run's columns may be null: inside a struct a null is a value.
    run = F.struct(*RUN)
    r = r.select(run.alias("__run"), "prev_run_out")
    j = p.withColumn("__run", run).join(r, "__run").drop("__run")
    expected = F.coalesce(F.col("prev_out"), F.col("prev_run_out"))
    return j.select(*RUN, "page", "cursor_in", expected.alias("expected_cursor_in"),
                    (~F.col("cursor_in").eqNullSafe(expected)).alias("is_gap"), "page_path")


def cursor_gaps(pages: DataFrame) -> DataFrame:
    return cursor_chain(pages).filter(F.col("is_gap"))


def errors(runs_log: DataFrame) -> DataFrame:
    """Error records of a runs log, flattened."""
    e = runs_log.filter(F.col("event") == "error")
    err = F.from_json(F.col("error"), schemas.ERROR)
    return e.select(
        "ts", "run_id", "institution", "item_id", "mode", "page", "cursor_in",
        err["type"].alias("error_type"), err["message"].alias("message"),
        err["status"].alias("status"), err["reason"].alias("reason"),
        *[err["plaid"][f].alias(f"plaid_{f}") for f in (
            "error_type", "error_code", "error_message", "display_message",
            "request_id", "documentation_url", "suggested_action")])
