"""Structured Streaming entry points.

``bronze_stream``: landed pages -> Bronze.  Page files go through the file sink,
whose own commit log makes the append exactly-once.  Pages in JSON lines may
land again in another file: each micro-batch leaves out those of earlier batches
by the ledger, in ``foreachBatch``, so no state grows with the pages, and writes
a batch folder that a retry replaces.  ``silver_stream``: the same pages with
``foreachBatch``: the batch goes to its own Bronze folder and Silver is refreshed
in the key buckets that the batch touched.

No event-time watermark is used: late pages are legitimate and are put in
order by run time, so nothing may be dropped as late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger import schemas
from lakeledger.functions import scalars as S
from lakeledger.operators import bronze as B
from lakeledger.operators import silver as SV
from lakeledger.session import checkpoint_dir
from lakeledger.sources import layout as L
from lakeledger.sources import pages as P
from lakeledger.sources import tables as T

PAGE_LINE = P.PAGE_LINE


def page_stream(spark: SparkSession, root: str, layout: str = "files",
                prefix: str = "", max_files: int | None = None, mode: str = "FAILFAST") -> DataFrame:
    """Streaming page rows.  ``files``: one pretty-printed page per file
    ``page_*.json`` anywhere below ``root``; ``lines``: JSON lines, one page
    per line, with page_name and page_path fields (a page that landed again is
    a row again; see ``unseen_pages``).  A malformed page fails the stream: it
    must not be checkpointed as done."""
    r = spark.readStream.option("recursiveFileLookup", True).option("mode", mode)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if layout == "files":
        df = (r.schema(schemas.PAGE).option("multiLine", True)
              .option("pathGlobFilter", P.PAGE_GLOB).json(root))
        return df.select("*", F.col("_metadata.file_name").alias("page_name"),
                         S.relative_path(F.col("_metadata.file_path"), P.root_uri(spark, root), prefix)
                         .alias("page_path"))
    if layout == "lines":
        return r.schema(PAGE_LINE).option("pathGlobFilter", "*.json").json(root)
    raise ValueError("layout must be 'files' or 'lines'")


def unseen_pages(spark: SparkSession, batch: DataFrame, batch_id: int, ledger_path: str) -> DataFrame:
    """One page for each path of a micro-batch, without those that the ledger
    has from other batches (those of the batch itself are of a lost try)."""
    led = P.read_jsonl_log(spark, ledger_path, schemas.LEDGER, required="page_path")
    seen = led.where(~F.col("batch").eqNullSafe(F.lit(batch_id + 1))).select("page_path")
    return B.new_pages(B.one_of_each_path(batch), seen)


def bronze_batch(spark: SparkSession, batch: DataFrame, batch_id: int, bronze_path: str, ledger_path: str,
                 now: str | None = None) -> DataFrame:
    """One micro-batch to its own Bronze folder and the ledger; the pages
    taken (page_path, run_id).  Batches count from 1, as those of ``ingest``."""
    checkpoint_dir(spark)
    pages = unseen_pages(spark, batch, batch_id, ledger_path)
    taken = pages.select("page_path", "run_id").checkpoint(eager=True)
    if taken.isEmpty():
        return taken
    rows = B.explode_pages(pages.join(taken.select("page_path"), "page_path", "left_semi"), now)
    B.append_bronze(rows, bronze_path, batch_id + 1)
    B.mark_pages(taken, ledger_path, now, batch_id + 1)
    return taken


def _triggered(w, available_now: bool, processing_time: str | None = None):
    return w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "1 minute")


def bronze_stream(spark: SparkSession, root: str, bronze_path: str, checkpoint: str,
                  now: str | None = None, layout: str = "files", prefix: str = "",
                  available_now: bool = True, processing_time: str | None = None,
                  ledger_path: str | None = None):
    """Start the Bronze stream; returns the StreamingQuery.  The ledger of the
    ``lines`` layout is beside Bronze by default."""
    pages = page_stream(spark, root, layout, prefix)
    if layout == "lines":
        ledger = ledger_path or f"{bronze_path.rstrip('/')}-ledger"

        def each(batch: DataFrame, batch_id: int) -> None:
            bronze_batch(spark, batch, batch_id, bronze_path, ledger, now)

        w = pages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
        return _triggered(w, available_now, processing_time).start()
    # Without a fixed value every micro-batch stamps its own time
    # (current_timestamp is fixed per micro-batch).
    rows = B.explode_pages(pages, now or S.iso_text(F.current_timestamp()))
    w = (rows.writeStream.format("parquet").option("path", bronze_path)
         .option("checkpointLocation", checkpoint).partitionBy("event_year")
         .outputMode("append"))
    return _triggered(w, available_now, processing_time).start()


def silver_batch(spark: SparkSession, batch: DataFrame, batch_id: int, bronze_path: str,
                 silver_path: str, now: str | None = None, built_at: str | None = None,
                 form: str = "auto", ledger_path: str | None = None) -> None:
    """One micro-batch of ``silver_stream`` (also usable from batch jobs): its
    Bronze folder, then Silver in the key buckets it touched.  Repeating a
    batch replaces its folder and refreshes the same keys again."""
    if bronze_batch(spark, batch, batch_id, bronze_path, ledger_path or f"{bronze_path.rstrip('/')}-ledger",
                    now).isEmpty():
        return
    try:
        SV.read_silver(spark, silver_path)
    except T.TableNotFound:
        SV.write_silver(SV.silver_from_bronze(B.read_bronze(spark, bronze_path), built_at, form), silver_path,
                        L.stored(spark, bronze_path))
        return
    folder = f"{bronze_path.rstrip('/')}/batch_id={batch_id + 1}"
    changed = T.read_table(spark, folder, schemas.BRONZE, int_partitions=("event_year",)).select(
        "item_id", "transaction_id")
    SV.refresh_buckets(spark, bronze_path, changed, silver_path, built_at, form=form)


def silver_stream(spark: SparkSession, root: str, bronze_path: str, silver_path: str,
                  checkpoint: str, now: str | None = None, built_at: str | None = None,
                  layout: str = "files", prefix: str = "", available_now: bool = True,
                  form: str = "auto", ledger_path: str | None = None):
    pages = page_stream(spark, root, layout, prefix)

    def each(batch: DataFrame, batch_id: int) -> None:
        silver_batch(spark, batch, batch_id, bronze_path, silver_path, now, built_at, form, ledger_path)

    return _triggered(pages.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint),
                      available_now).start()
