"""Adapters: the given tables read as change logs.

The data holds no bank pages, so ``events`` is read as the event log of a
sync feed (one page per item, day and block of 50 event ids), and
``orders``, ``lineitem`` and ``conversations`` as further change logs with
their own keys and order.  Every adapter is a projection of its table: the
work grows with the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeledger import schemas
from lakeledger.functions import scalars as S
from lakeledger.operators.silver import OrderItem, Scd2Spec

# Fixed values of the events adapter.
INSTITUTION = "events"
PLAID_ENV = "sandbox"
INGESTED_AT = "2024-02-01T00:00:00.000000Z"
BUILT_AT = "2024-02-02T00:00:00.000000Z"
PAGE_SIZE = 50
TYPE_MAP = {"signup": "added", "click": "modified", "view": "modified",
            "purchase": "modified", "error": "removed"}
TYPE_ORD = {"added": 0, "modified": 1, "removed": 2}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _map(col: Column, mapping: dict) -> Column:
    out = None
    for k, v in mapping.items():
        out = (F.when(col == k, F.lit(v)) if out is None else out.when(col == k, F.lit(v)))
    return out


def events_base(spark: SparkSession, sf_dir: str, unknown: tuple[str, ...] = ()) -> DataFrame:
    """Per event: item, transaction, run, page and type (before payload).

    ``unknown`` lists source types left as they are (not mapped), so that
    they reach Silver as unknown event types.  Derived columns are built in
    steps that refer to earlier columns, so no expression is repeated."""
    e = table(spark, sf_dir, "events")
    mapping = {k: v for k, v in TYPE_MAP.items() if k not in unknown}
    b = e.select(
        F.col("event_id").alias("src_event_id"),
        F.col("ts"), F.col("user_id"), F.col("value"), F.col("props"),
        F.col("event_type").alias("src_type"),
        F.pmod(F.col("user_id"), F.lit(10)).cast("string").alias("item_id"),
        F.col("user_id").cast("string").alias("transaction_id"),
        F.coalesce(_map(F.col("event_type"), mapping), F.col("event_type")).alias("event_type"),
        F.date_format("ts", "yyyyMMdd").alias("day"),
        F.date_format("ts", "yyyy-MM-dd").alias("iso_day"),
        F.floor(F.col("event_id") / PAGE_SIZE).cast("bigint").alias("page_no"),
    )
    b = b.select(
        "*",
        F.concat(F.col("day"), F.lit("_000000")).alias("run_id"),
        F.concat(F.col("iso_day"), F.lit("T00:00:00.000000Z")).alias("run_ts"),
        F.coalesce(_map(F.col("event_type"), TYPE_ORD), F.lit(1)).alias("type_ord"),
        (F.col("src_event_id") - F.col("page_no") * PAGE_SIZE).alias("pos"),
    )
    b = b.withColumn("page_name", F.concat(
        F.lit("page_"), F.format_string("%04d", F.col("page_no")), F.lit("_"),
        F.col("run_id"), F.lit(".json")))
    b = b.withColumn("page_path", F.concat(
        F.lit(INSTITUTION + "/"), F.col("item_id"), F.lit("/sync_pages/"), F.col("page_name")))
    return b.drop("day")


def events_changelog(spark: SparkSession, sf_dir: str, unknown: tuple[str, ...] = ()) -> DataFrame:
    """``events`` as the Bronze event log (schema ``BRONZE``)."""
    b = events_base(spark, sf_dir, unknown)
    removed = F.col("event_type") == "removed"
    pay = {
        "account_id": F.concat(F.col("item_id"), F.lit("-"),
                               F.pmod(F.col("user_id"), F.lit(3)).cast("string")),
        "amount": F.col("value"),
        "iso_currency_code": F.lit("USD"),
        "date": F.col("iso_day"),
        "name": F.col("src_type"),
        "merchant_name": F.get_json_object("props", "$.k"),
        "pending": F.col("value") < 10,
    }
    out = b.select(
        F.lit(PLAID_ENV).alias("plaid_env"), "run_id", "run_ts",
        F.col("iso_day").alias("event_date"),
        F.year("ts").cast("bigint").alias("event_year"),
        F.month("ts").cast("bigint").alias("event_month"),
        F.lit("incremental").alias("mode"),
        F.lit(INSTITUTION).alias("institution"), "item_id",
        "page_path", "event_type", "transaction_id",
        S.event_id("item_id", "run_id", "page_path", "event_type", "transaction_id")
        .alias("event_id"),
        *[F.when(~removed, v).alias(k) for k, v in pay.items()],
        F.when(~removed, F.col("props")).alias("raw_transaction_json"),
        F.lit(INGESTED_AT).alias("ingested_at"),
        "page_name", F.col("type_ord").cast("int").alias("type_ord"), "pos",
    )
    return schemas.conform(out, schemas.BRONZE)


# ------------------------------------------------------------ other tables
ORDERS_SPEC = Scd2Spec(
    keys=("o_custkey",), event_time="run_ts", event_type="event_type",
    order=(OrderItem("o_orderdate"),
           OrderItem("o_orderkey")),
    split=1)


def orders_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    et = _map(F.col("o_orderstatus"), {"O": "added", "P": "modified", "F": "removed"})
    return o.select(
        "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "o_orderpriority",
        F.coalesce(et, F.col("o_orderstatus")).alias("event_type"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("run_ts"))


LINEITEM_SPEC = Scd2Spec(
    keys=("l_partkey", "l_suppkey"), event_time="run_ts", event_type="event_type",
    order=(OrderItem("l_shipdate"),
           OrderItem("l_orderkey"),
           OrderItem("l_linenumber"),
           OrderItem("l_quantity"),
           OrderItem("l_extendedprice"),
           OrderItem("l_discount"),
           OrderItem("l_tax"),
           OrderItem("l_linestatus")),
    split=1)


def lineitem_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    et = _map(F.col("l_returnflag"), {"A": "added", "N": "modified", "R": "removed"})
    return li.select(
        "l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_linestatus", "l_shipdate",
        F.coalesce(et, F.col("l_returnflag")).alias("event_type"),
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("run_ts"))


# A coarse, order-preserving segment (blocks of 64 turns) in front of the
# turn, so that a very long conversation is cut into segments as well.
CONVERSATIONS_SPEC = Scd2Spec(
    keys=("conv_id",), event_time="run_ts", event_type="event_type",
    order=(OrderItem("floor(turn / 64)"),
           OrderItem("turn")),
    split=1)


def conversations_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns of a conversation as versions: the first turn adds, user turns
    modify, and an empty text removes."""
    c = table(spark, sf_dir, "conversations")
    et = (F.when(F.length(F.trim("text")) == 0, F.lit("removed"))
          .when(F.col("turn") == 0, F.lit("added"))
          .when(F.col("role") == "user", F.lit("modified"))
          .otherwise(F.col("role")))
    return c.select(
        "conv_id", "turn", "role", F.length("text").cast("bigint").alias("text_len"),
        F.sha2(F.col("text"), 256).alias("text_sha"),
        et.alias("event_type"),
        F.format_string("turn-%06d", F.col("turn")).alias("run_ts"))


# ------------------------------------------------------------ page set
def _tx_object() -> Column:
    """A transaction object as JSON text, built from one event."""
    return F.to_json(F.struct(
        F.col("transaction_id"),
        F.concat(F.col("item_id"), F.lit("-"), F.pmod(F.col("user_id"), F.lit(3))
                 .cast("string")).alias("account_id"),
        F.col("value").alias("amount"),
        F.lit("USD").alias("iso_currency_code"),
        F.date_format("ts", "yyyy-MM-dd").alias("date"),
        F.col("src_type").alias("name"),
        F.get_json_object("props", "$.k").alias("merchant_name"),
        (F.col("value") < 10).alias("pending")))


def _array_of(et: str, junk: bool) -> Column:
    """Elements of one page array in position order.  ``removed`` holds bare
    ids; with ``junk``, ``click`` events go into ``modified`` as bare ids too,
    which are not objects and so must be skipped on ingest."""
    if et == "removed":
        elem = F.col("transaction_id")
    elif not junk:
        elem = _tx_object()
    else:
        elem = F.when(F.col("src_type") == "click", F.col("transaction_id")) \
            .otherwise(_tx_object())
    picked = F.when(F.col("event_type") == et, F.struct(F.col("pos"), elem.alias("j")))
    return F.transform(F.sort_array(F.collect_list(picked)), lambda x: x["j"])


def events_pages(spark: SparkSession, sf_dir: str, junk: bool = False) -> DataFrame:
    """``events`` nested into sync pages (schema ``PAGE`` + page_name,
    page_path, page_no), with cursors chained page to page.

    A page's ``cursor_out`` names the page.  Inside a run a page starts at
    the previous page's cursor; a run starts at the previous run's last
    cursor, or at '' (a fresh backfill) for the item's first run and after a
    run that ended on an error event (its last page keeps ``has_more``).
    Groups are bounded: a page holds at most ``PAGE_SIZE`` events.
    """
    b = events_base(spark, sf_dir)
    g = b.groupBy("item_id", "run_id", "run_ts", "page_no", "page_name", "page_path").agg(
        *[_array_of(x, junk).alias(x) for x in ("added", "modified", "removed")],
        F.max_by("src_type", "pos").alias("last_type"))
    g = g.withColumn("cursor_out", F.concat(
        F.lit("c-"), F.col("item_id"), F.lit("-"), F.col("run_id"), F.lit("-"),
        F.format_string("%04d", F.col("page_no"))))
    # level 1: pages of one run
    w = Window.partitionBy("item_id", "run_id").orderBy("page_no")
    g = (g.withColumn("prev_out", F.lag("cursor_out").over(w))
         .withColumn("is_last", F.lead("page_no").over(w).isNull()))
    # level 2: one row per run
    runs = g.groupBy("item_id", "run_id").agg(
        F.max_by("cursor_out", "page_no").alias("last_out"),
        F.max_by("last_type", "page_no").alias("run_last_type"))
    w2 = Window.partitionBy("item_id").orderBy("run_id")
    prev_out, prev_type = F.lag("last_out").over(w2), F.lag("run_last_type").over(w2)
    runs = runs.select(
        "item_id", "run_id",
        F.when(prev_out.isNull() | (prev_type == "error"), F.lit(""))
        .otherwise(prev_out).alias("run_cursor"))
    p = g.join(runs, ["item_id", "run_id"])
    return p.select(
        "run_id", "run_ts",
        F.when(F.col("run_cursor") == "", F.lit("backfill")).otherwise(F.lit("incremental"))
        .alias("mode"),
        F.lit(INSTITUTION).alias("institution"), "item_id",
        F.lit(PLAID_ENV).alias("plaid_env"),
        F.coalesce("prev_out", "run_cursor").alias("cursor_in"), "cursor_out",
        (~F.col("is_last") | (F.col("last_type") == "error")).alias("has_more"),
        "added", "modified", "removed", "page_name", "page_path", "page_no")


def events_runs_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A runs log derived from ``events``: each error event is an API error
    record of its run (schema ``RUNS_LOG``, ``error`` as JSON text)."""
    b = events_base(spark, sf_dir).filter(F.col("src_type") == "error")
    status = (F.lit(400) + F.pmod(F.col("src_event_id"), F.lit(3)) * 50).cast("bigint")
    err = F.to_json(F.struct(
        F.lit("ApiException").alias("type"),
        F.concat(F.lit("sync failed: "), F.col("props")).alias("message"),
        status.alias("status"),
        F.when(status == 400, F.lit("Bad Request")).when(status == 450, F.lit("Unknown"))
        .otherwise(F.lit("Server Error")).alias("reason"),
        F.struct(
            F.lit("TRANSACTIONS_ERROR").alias("error_type"),
            F.concat(F.lit("E"), F.get_json_object("props", "$.k")).alias("error_code"),
            F.col("props").alias("error_message"),
            F.lit(None).cast("string").alias("display_message"),
            F.sha2(F.col("src_event_id").cast("string"), 256).substr(1, 12).alias("request_id"),
            F.lit(None).cast("string").alias("documentation_url"),
            F.lit(None).cast("string").alias("suggested_action")).alias("plaid")))
    return b.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("ts"), "run_id",
        F.lit(INSTITUTION).alias("institution"), "item_id",
        F.lit("incremental").alias("mode"), F.lit("error").alias("event"),
        F.col("page_no").alias("page"), F.lit("").alias("cursor_in"), err.alias("error"))
