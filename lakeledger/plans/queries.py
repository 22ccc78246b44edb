"""Registered queries: one per operator group of the survey's inventory.

Every query reads the given tables (or data Spark derives from them) in
whole; ``SPARK[name](spark, sf_dir)`` returns a DataFrame and ``SQL[name]``
is its independent DuckDB statement where SQL can state it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger import schemas
from lakeledger.functions import scalars as S
from lakeledger.operators import audit, bronze, export, quality, silver, views
from lakeledger.plans import changelog as C
from lakeledger.plans import oracle as O

Query = Callable[[SparkSession, str], DataFrame]
SPARK: dict[str, Query] = {}
SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        SPARK[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return deco


def silver_of_events(spark: SparkSession, sf_dir: str, unknown=(), form="auto") -> DataFrame:
    return silver.silver_from_bronze(C.events_changelog(spark, sf_dir, unknown),
                                     built_at=C.BUILT_AT, form=form)


# Cut-off of the ledger and the first export: the first half of the month.
LEDGER_CUT = "2024-01-16T00:00:00.000000Z"
ASOF_TS = "2024-01-15T00:00:00.000000Z"

# ------------------------------------------------------------ event log


@register("changelog_events", "WITH " + O.changelog_cte() + f"\nSELECT {O.BRONZE_COLS} FROM cl")
def q_changelog(spark, sf):
    return C.events_changelog(spark, sf)


_ROUNDTRIP_COLS = [c for c in schemas.BRONZE.fieldNames()
                   if c not in ("raw_transaction_json", "pos", "cursor_in", "cursor_out",
                                "has_more", "mode")]


@register("page_roundtrip", "WITH " + O.changelog_cte() + f"""
SELECT {', '.join(_ROUNDTRIP_COLS)},
       CASE WHEN event_type <> 'removed' THEN transaction_id END AS raw_id
FROM cl WHERE src_type <> 'click'""")
def q_page_roundtrip(spark, sf):
    """Events nested into page arrays and flattened again: click events sit
    in ``modified`` as bare ids (not objects) and must be skipped."""
    rows = bronze.explode_pages(C.events_pages(spark, sf, junk=True), now=C.INGESTED_AT)
    return rows.select(*_ROUNDTRIP_COLS,
                       F.get_json_object("raw_transaction_json", "$.transaction_id")
                       .alias("raw_id"))


@register("bronze_new_pages", "WITH " + O.events_base() + f"""
, pg AS (SELECT DISTINCT item_id, run_id, run_ts, page_path FROM ev)
SELECT item_id, run_id, page_path FROM pg p
WHERE NOT EXISTS (SELECT 1 FROM pg l WHERE l.run_ts < '{LEDGER_CUT}'
                  AND l.page_path = p.page_path)""")
def q_new_pages(spark, sf):
    """Pages not yet in the ledger; the ledger holds the pages of the runs
    before the cut-off."""
    pages = C.events_pages(spark, sf)
    ledger = pages.filter(F.col("run_ts") < LEDGER_CUT).select("page_path")
    return bronze.new_pages(pages, ledger).select("item_id", "run_id", "page_path")


# ------------------------------------------------------------ SCD2 history

@register("scd2_full", O.with_silver(f"SELECT {O.SILVER_COLS} FROM silver"))
def q_scd2_full(spark, sf):
    return silver_of_events(spark, sf)


@register("scd2_fast_form", O.with_silver(f"SELECT {O.SILVER_COLS} FROM silver"))
def q_scd2_fast(spark, sf):
    """The single-window backward-frame form (no segment split)."""
    return silver_of_events(spark, sf, form="fast")


@register("scd2_lead_form", O.with_silver(f"SELECT {O.SILVER_COLS} FROM silver"))
def q_scd2_lead(spark, sf):
    """``lead`` form: valid because the event log holds known types only."""
    return silver_of_events(spark, sf, form="lead")


@register("scd2_split_form", O.with_silver(f"SELECT {O.SILVER_COLS} FROM silver"))
def q_scd2_split(spark, sf):
    """Every key through the two-level (segment) form."""
    return silver_of_events(spark, sf, form="split")


@register("scd2_unknown_types",
          O.with_silver(f"SELECT {O.SILVER_COLS} FROM silver", unknown=("view",)))
def q_scd2_unknown(spark, sf):
    """``view`` left unmapped: an unknown type closes, adds no version."""
    return silver_of_events(spark, sf, unknown=("view",))


_HIST = "valid_from_ts, valid_to_ts, is_current, is_active, is_deleted, change_type, version"

_ORDERS_SRC = """
o AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderpriority,
         CASE o_orderstatus WHEN 'O' THEN 'added' WHEN 'P' THEN 'modified'
              WHEN 'F' THEN 'removed' ELSE o_orderstatus END AS event_type,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS run_ts
  FROM orders)"""


@register("scd2_orders", "WITH " + _ORDERS_SRC + O.history_ctes(
    "o", "o_custkey", "o_orderdate, o_orderkey", "run_ts") +
    f"\nSELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority, {_HIST} FROM h")
def q_scd2_orders(spark, sf):
    h = silver.build_scd2(C.orders_changelog(spark, sf), C.ORDERS_SPEC, C.BUILT_AT)
    return h.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority",
                    *[c.strip() for c in _HIST.split(",")])


@register("scd2_orders_hot_key", "WITH " + _ORDERS_SRC.replace(
    "SELECT o_custkey,", "SELECT CASE WHEN o_custkey % 3 = 0 THEN 0 ELSE o_custkey END AS o_custkey,")
    + O.history_ctes("o", "o_custkey", "o_orderdate, o_orderkey", "run_ts") +
    f"\nSELECT o_custkey, o_orderkey, o_totalprice, o_orderpriority, {_HIST} FROM h")
def q_scd2_orders_hot(spark, sf):
    """Orders with one customer holding a third of all orders: the order's
    columns bound no segment, so the hot key is cut by range segments."""
    o = C.orders_changelog(spark, sf).withColumn(
        "o_custkey", F.when(F.col("o_custkey") % 3 == 0, F.lit(0).cast("bigint"))
        .otherwise(F.col("o_custkey")))
    h = silver.build_scd2(o, C.ORDERS_SPEC, C.BUILT_AT, hot_rows=1000, segment_rows=1000)
    return h.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority",
                    *[c.strip() for c in _HIST.split(",")])


_LINEITEM_SRC = """
li AS (
  SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity, l_extendedprice,
         l_discount, l_tax, l_linestatus, l_shipdate,
         CASE l_returnflag WHEN 'A' THEN 'added' WHEN 'N' THEN 'modified'
              WHEN 'R' THEN 'removed' ELSE l_returnflag END AS event_type,
         strftime(l_shipdate, '%Y-%m-%dT%H:%M:%SZ') AS run_ts
  FROM lineitem)"""

_LI_ORDER = ("l_shipdate, l_orderkey, l_linenumber, l_quantity, l_extendedprice, "
             "l_discount, l_tax, l_linestatus")


@register("scd2_lineitem", "WITH " + _LINEITEM_SRC + O.history_ctes(
    "li", "l_partkey, l_suppkey", _LI_ORDER, "run_ts") +
    f"\nSELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_quantity, {_HIST} FROM h")
def q_scd2_lineitem(spark, sf):
    h = silver.build_scd2(C.lineitem_changelog(spark, sf), C.LINEITEM_SPEC, C.BUILT_AT)
    return h.select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber", "l_quantity",
                    *[c.strip() for c in _HIST.split(",")])


_CONV_SRC = """
cv AS (
  SELECT conv_id, turn, role, CAST(length(text) AS BIGINT) AS text_len,
         sha256(text) AS text_sha,
         CASE WHEN length(trim(text)) = 0 THEN 'removed' WHEN turn = 0 THEN 'added'
              WHEN role = 'user' THEN 'modified' ELSE role END AS event_type,
         printf('turn-%06d', turn) AS run_ts
  FROM conversations)"""


@register("scd2_conversations", "WITH " + _CONV_SRC + O.history_ctes(
    "cv", "conv_id", "turn", "run_ts") +
    f"\nSELECT conv_id, turn, role, text_len, text_sha, {_HIST} FROM h")
def q_scd2_conversations(spark, sf):
    h = silver.build_scd2(C.conversations_changelog(spark, sf), C.CONVERSATIONS_SPEC,
                          C.BUILT_AT, form="split")
    return h.select("conv_id", "turn", "role", "text_len", "text_sha",
                    *[c.strip() for c in _HIST.split(",")])


def hot_key_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events log with one hot key: every user whose id is a multiple of
    three writes to transaction '0' of item '0' (about a third of all rows)."""
    b = C.events_changelog(spark, sf_dir)
    hot = F.col("transaction_id").cast("bigint") % 3 == 0
    return (b.withColumn("item_id", F.when(hot, F.lit("0")).otherwise(F.col("item_id")))
            .withColumn("transaction_id", F.when(hot, F.lit("0"))
                        .otherwise(F.col("transaction_id"))))


@register("scd2_hot_key", "WITH " + O.changelog_cte() + """,
cl_hot AS (
  SELECT * REPLACE (
    CASE WHEN CAST(transaction_id AS BIGINT) % 3 = 0 THEN '0' ELSE item_id END AS item_id,
    CASE WHEN CAST(transaction_id AS BIGINT) % 3 = 0 THEN '0' ELSE transaction_id END
      AS transaction_id)
  FROM cl)""" + O.silver_ctes("cl_hot") + f"\nSELECT {O.SILVER_COLS} FROM silver")
def q_scd2_hot_key(spark, sf):
    """SCD2 when one key holds a third of all events: keys above 1,000
    events are routed to the two-level form in segments of about 1,000, the
    rest to the fast form."""
    return silver.silver_from_bronze(hot_key_changelog(spark, sf), built_at=C.BUILT_AT,
                                     hot_rows=1000, segment_rows=1000)


# ------------------------------------------------------------ views

@register("view_all", O.with_silver(f"SELECT {O.SILVER_COLS} FROM silver"))
def q_view_all(spark, sf):
    return views.all_versions(silver_of_events(spark, sf))


@register("view_current", O.with_silver(
    f"SELECT {O.SILVER_COLS} FROM silver WHERE is_active = TRUE"))
def q_view_current(spark, sf):
    return views.current(silver_of_events(spark, sf))


@register("view_current_including_deleted", O.with_silver(
    f"SELECT {O.SILVER_COLS} FROM silver WHERE is_current = TRUE"))
def q_view_current_incl(spark, sf):
    return views.current_including_deleted(silver_of_events(spark, sf))


@register("asof_versions", O.with_silver(
    f"SELECT {O.SILVER_COLS} FROM silver WHERE valid_from_ts <= '{ASOF_TS}' "
    f"AND (valid_to_ts IS NULL OR valid_to_ts > '{ASOF_TS}')"))
def q_asof(spark, sf):
    return views.as_of(silver_of_events(spark, sf), ASOF_TS)


# ------------------------------------------------------------ quality

def _dq_sql(src: str) -> str:
    return f""",
pk AS (
  SELECT item_id, transaction_id, count(*) AS n,
         sum(CASE WHEN is_current THEN 1 ELSE 0 END) AS curr, min(version) AS min_v
  FROM {src} GROUP BY item_id, transaction_id),
row_counts AS (
  SELECT count(*) AS n_rows,
         count(*) FILTER (WHERE is_active AND NOT (is_current AND NOT is_deleted)) AS d3,
         count(*) FILTER (WHERE NOT is_current AND NOT ended) AS d4,
         count(*) FILTER (WHERE is_current AND ended) AS d5
  FROM (SELECT *, coalesce(length(valid_to_ts), 0) > 0 AS ended FROM {src})),
agg AS (
  SELECT r.*, k.* FROM row_counts r,
    (SELECT coalesce(max(curr), 0) AS max_curr,
            count(*) FILTER (WHERE min_v IS DISTINCT FROM 1) AS d6 FROM pk) k),
chk AS (
  SELECT unnest([{", ".join(f"'{n}'" for n in quality.SILVER_CHECKS)}]) AS "check",
         unnest([0, CASE WHEN max_curr > 1 THEN max_curr ELSE 0 END, d3, d4, d5, d6]) AS violations,
         unnest([{", ".join(f"'{t}'" for t in quality.SILVER_CHECKS.values())}]) AS detail
  FROM agg)
SELECT "check", CAST(violations AS BIGINT) AS violations,
       violations = 0 OR (SELECT n_rows FROM agg) = 0 AS passed, detail
FROM chk"""


@register("dq_silver", "WITH " + O.changelog_cte() + O.silver_ctes() + _dq_sql("silver"))
def q_dq_silver(spark, sf):
    return quality.check_silver(silver_of_events(spark, sf))


def break_silver(df: DataFrame) -> DataFrame:
    """Silver broken on purpose, each check by its own rows: second versions
    made current (D2, D5 where closed), tombstones made active (D3), closed
    first versions lose their end (D4), item '0' starts at version 2 (D6)."""
    v = F.col("version")
    return df.select(
        *[c for c in df.columns if c not in ("is_current", "is_active", "valid_to_ts",
                                              "version")],
        (F.col("is_current") | (v == 2)).alias("is_current"),
        (F.col("is_active") | F.col("is_deleted")).alias("is_active"),
        F.when((v == 1) & ~F.col("is_current"), F.lit(None).cast("string"))
        .otherwise(F.col("valid_to_ts")).alias("valid_to_ts"),
        F.when(F.col("item_id") == "0", v + 1).otherwise(v).alias("version"))


@register("dq_silver_broken", "WITH " + O.changelog_cte() + O.silver_ctes() + """,
broken AS (
  SELECT * REPLACE (
    is_current OR version = 2 AS is_current,
    is_active OR is_deleted AS is_active,
    CASE WHEN version = 1 AND NOT is_current THEN NULL ELSE valid_to_ts END AS valid_to_ts,
    CASE WHEN item_id = '0' THEN version + 1 ELSE version END AS version)
  FROM silver)""" + _dq_sql("broken"))
def q_dq_silver_broken(spark, sf):
    return quality.check_silver(break_silver(silver_of_events(spark, sf)))


@register("dq_bronze", "WITH " + O.changelog_cte() + """,
per_id AS (SELECT event_id, count(*) AS n FROM cl GROUP BY event_id),
agg AS (
  SELECT (SELECT count(*) FROM cl WHERE item_id IS NULL) AS null_item_id,
         (SELECT count(*) FROM cl WHERE transaction_id IS NULL) AS null_transaction_id,
         (SELECT count(*) FROM cl WHERE run_ts IS NOT NULL
            AND TRY_CAST(run_ts AS TIMESTAMPTZ) IS NULL) AS bad_run_ts,
         (SELECT coalesce(sum(n - 1), 0) FROM per_id WHERE n > 1) AS repeated_event_id),
chk AS (
  SELECT 'null_item_id' AS "check", null_item_id AS violations FROM agg
  UNION ALL SELECT 'null_transaction_id', null_transaction_id FROM agg
  UNION ALL SELECT 'bad_run_ts', bad_run_ts FROM agg
  UNION ALL SELECT 'repeated_event_id', repeated_event_id FROM agg)
SELECT "check", CAST(violations AS BIGINT) AS violations, violations = 0 AS passed FROM chk""")
def q_dq_bronze(spark, sf):
    return quality.check_bronze(C.events_changelog(spark, sf))


# ------------------------------------------------------------ export
_EXPORT_COLS = ", ".join(schemas.EXPORT_COLUMNS)
_EXPORT_ORDER = ("ORDER BY valid_from_ts NULLS LAST, institution NULLS LAST, "
                 "item_id NULLS LAST, transaction_id NULLS LAST, version NULLS LAST")
SILVER_PATH = "silver/events"
WORKSHEET = "transactions"


@register("export_current", O.with_silver(
    f"SELECT {_EXPORT_COLS} FROM silver WHERE is_current = TRUE {_EXPORT_ORDER}"))
def q_export_current(spark, sf):
    return export.unsynced_rows(silver_of_events(spark, sf), "current", None)


@register("export_all", O.with_silver(f"SELECT {_EXPORT_COLS} FROM silver {_EXPORT_ORDER}"))
def q_export_all(spark, sf):
    return export.unsynced_rows(silver_of_events(spark, sf), "all", None)


def sync_log_of(silver_df: DataFrame) -> DataFrame:
    """A sync log derived from Silver: daily exports of the first half of the
    month in mode 'current', plus records that must not match: mode 'all'
    and another environment, both covering every day."""
    daily = silver_df.groupBy("source_run_id").agg(
        F.count(F.lit(1)).alias("rows_synced"),
        F.max("valid_from_ts").alias("last_synced_valid_from_ts"))

    def rec(env, mode, keep):
        d = daily.filter(keep)
        return d.select(
            F.concat(F.col("last_synced_valid_from_ts").substr(1, 10), F.lit("T23:59:59Z"))
            .alias("timestamp"),
            F.lit(env).alias("plaid_env"), F.lit(SILVER_PATH).alias("silver_delta_path"),
            F.lit("sheet-1").alias("spreadsheet_id"), F.lit(WORKSHEET).alias("worksheet_name"),
            F.lit(mode).alias("export_mode"), F.col("rows_synced").cast("bigint"),
            "last_synced_valid_from_ts")
    first_half = F.col("last_synced_valid_from_ts") < LEDGER_CUT
    return (rec("sandbox", "current", first_half)
            .unionByName(rec("sandbox", "all", F.lit(True)))
            .unionByName(rec("production", "current", F.lit(True))))


_SYNC_LOG_SQL = f""",
daily AS (SELECT source_run_id, count(*) AS rows_synced,
                 max(valid_from_ts) AS last_synced_valid_from_ts
          FROM silver GROUP BY source_run_id),
synclog AS (
  SELECT 'sandbox' AS plaid_env, '{SILVER_PATH}' AS silver_delta_path,
         '{WORKSHEET}' AS worksheet_name, 'current' AS export_mode, last_synced_valid_from_ts
  FROM daily WHERE last_synced_valid_from_ts < '{LEDGER_CUT}'
  UNION ALL SELECT 'sandbox', '{SILVER_PATH}', '{WORKSHEET}', 'all', last_synced_valid_from_ts
  FROM daily
  UNION ALL SELECT 'production', '{SILVER_PATH}', '{WORKSHEET}', 'current',
         last_synced_valid_from_ts FROM daily)"""


@register("sync_watermark", "WITH " + O.changelog_cte() + O.silver_ctes() + _SYNC_LOG_SQL + f"""
, modes AS (SELECT 'current' AS export_mode UNION ALL SELECT 'all')
SELECT m.export_mode, max(l.last_synced_valid_from_ts) AS last_synced_valid_from_ts,
       count(l.export_mode) AS matching_records
FROM modes m LEFT JOIN synclog l ON l.export_mode = m.export_mode
  AND l.plaid_env = 'sandbox' AND l.worksheet_name = '{WORKSHEET}'
  AND l.silver_delta_path = '{SILVER_PATH}'
GROUP BY m.export_mode""")
def q_sync_watermark(spark, sf):
    log = sync_log_of(silver_of_events(spark, sf))
    outs = [export.last_watermark_df(log, "sandbox", WORKSHEET, SILVER_PATH, m)
            .select(F.lit(m).alias("export_mode"), "*") for m in export.MODES]
    return outs[0].unionByName(outs[1]).select(
        "export_mode", "last_synced_valid_from_ts",
        F.col("matching_records").cast("bigint").alias("matching_records"))


@register("export_incremental", "WITH " + O.changelog_cte() + O.silver_ctes() + _SYNC_LOG_SQL + f"""
, wm AS (SELECT max(last_synced_valid_from_ts) AS w FROM synclog
         WHERE plaid_env = 'sandbox' AND worksheet_name = '{WORKSHEET}'
           AND silver_delta_path = '{SILVER_PATH}' AND export_mode = 'current')
SELECT {_EXPORT_COLS} FROM silver
WHERE is_current = TRUE AND valid_from_ts > (SELECT w FROM wm) {_EXPORT_ORDER}""")
def q_export_incremental(spark, sf):
    """Rows above the last logged watermark of this env/target/table/mode."""
    s = silver_of_events(spark, sf)
    wm = export.last_watermark(sync_log_of(s), "sandbox", WORKSHEET, SILVER_PATH, "current")
    return export.unsynced_rows(s, "current", wm)


ALIGN_HEADER = [c for c in schemas.EXPORT_COLUMNS if c != "city"] + ["notes"]


def _sql_text(c: str) -> str:
    kinds = {f.name: f.dataType.simpleString() for f in schemas.SILVER.fields}
    k = kinds.get(c)
    if c == "notes":
        return "'' AS notes"
    if k == "boolean":
        return f"CASE WHEN {c} THEN 'True' WHEN NOT {c} THEN 'False' ELSE '' END AS {c}"
    if k in ("bigint", "double"):
        return f"coalesce(CAST({c} AS VARCHAR), '') AS {c}"
    return f"coalesce({c}, '') AS {c}"


@register("export_aligned", O.with_silver(
    "SELECT " + ", ".join(_sql_text(c) for c in ALIGN_HEADER) +
    " FROM silver WHERE is_current = TRUE"))
def q_export_aligned(spark, sf):
    """Export rows aligned to a target header that lacks ``city`` and has a
    user column ``notes``; every cell as text."""
    rows = export.unsynced_rows(silver_of_events(spark, sf), "current", None)
    return export.stringify(export.align_to_header(rows, ALIGN_HEADER))


@register("export_missed_rows", "WITH " + O.changelog_cte() + O.silver_ctes() + """,
cl_early AS (SELECT * FROM cl WHERE event_type <> 'removed')""" + O.silver_ctes(
    "cl_early", "silver_early", "he") + f"""
, wm AS (SELECT max(valid_from_ts) AS w FROM silver_early)
SELECT {O.SILVER_COLS} FROM silver s
WHERE s.valid_from_ts <= (SELECT w FROM wm)
  AND NOT EXISTS (SELECT 1 FROM silver_early t WHERE t.item_id = s.item_id
                  AND t.transaction_id = s.transaction_id AND t.version = s.version)""")
def q_export_missed(spark, sf):
    """Rows never exported: the target got every version built before the
    removals arrived (late); later versions at or below its watermark are
    missed (strict ``>``), re-numbered versions included."""
    full = silver_of_events(spark, sf)
    early_bronze = C.events_changelog(spark, sf).filter(F.col("event_type") != "removed")
    target = export.export_projection(
        silver.silver_from_bronze(early_bronze, built_at=C.BUILT_AT))
    wm = target.agg(F.max("valid_from_ts")).first()[0]
    return export.missed_rows(full, target, wm, mode="all")


# ------------------------------------------------------------ audit

@register("page_log", "WITH " + O.pages_cte() + """
SELECT run_id, page_no AS page, institution, item_id, cursor_in, cursor_out,
       n_added AS added, n_modified AS modified, n_removed AS removed, has_more, page_path
FROM pset""")
def q_page_log(spark, sf):
    return audit.page_log(C.events_pages(spark, sf))


@register("page_counts", "WITH " + O.changelog_cte() + """
SELECT institution, item_id, run_id, page_path,
       count(*) FILTER (WHERE event_type = 'added') AS added,
       count(*) FILTER (WHERE event_type = 'modified') AS modified,
       count(*) FILTER (WHERE event_type = 'removed') AS removed
FROM cl GROUP BY institution, item_id, run_id, page_path""")
def q_page_counts(spark, sf):
    return audit.page_counts(C.events_changelog(spark, sf))


@register("run_summary", "WITH " + O.pages_cte() + """
SELECT institution, item_id, run_id, count(*) AS pages, CAST(sum(n_added) AS BIGINT) AS added,
       CAST(sum(n_modified) AS BIGINT) AS modified, CAST(sum(n_removed) AS BIGINT) AS removed,
       arg_min(cursor_in, page_no) AS cursor_start, arg_max(cursor_out, page_no) AS cursor_end,
       CASE WHEN arg_min(cursor_in, page_no) = '' THEN 'backfill' ELSE 'incremental' END AS mode
FROM pset GROUP BY institution, item_id, run_id""")
def q_run_summary(spark, sf):
    return audit.run_summary(C.events_pages(spark, sf))


@register("unfinished_runs", "WITH " + O.pages_cte() + """
SELECT institution, item_id, run_id, max(page_no) AS last_page,
       arg_max(cursor_out, page_no) AS cursor_end
FROM pset GROUP BY institution, item_id, run_id HAVING arg_max(has_more, page_no)""")
def q_unfinished_runs(spark, sf):
    return audit.unfinished_runs(C.events_pages(spark, sf))


@register("cursor_state", "WITH " + O.pages_cte() + """
, ranked AS (SELECT *, row_number() OVER (PARTITION BY institution, item_id
                 ORDER BY run_ts DESC, run_id DESC, page_no DESC) AS r FROM pset)
SELECT institution, item_id, run_id, cursor_out AS next_cursor, page_no AS last_page_written,
       (SELECT max(run_ts) FROM pset p WHERE p.item_id = ranked.item_id) AS updated_at
FROM ranked WHERE r = 1""")
def q_cursor_state(spark, sf):
    return audit.cursor_state(C.events_pages(spark, sf))


_CHAIN_SQL = "WITH " + O.pages_cte() + """
, chain AS (
  SELECT institution, item_id, run_id, page_no AS page, cursor_in,
         coalesce(lag(cursor_out) OVER (PARTITION BY institution, item_id
                                        ORDER BY run_ts, run_id, page_no), '')
           AS expected_cursor_in, page_path
  FROM pset)
SELECT *, cursor_in IS DISTINCT FROM expected_cursor_in AS is_gap FROM chain"""


@register("cursor_chain", _CHAIN_SQL)
def q_cursor_chain(spark, sf):
    return audit.cursor_chain(C.events_pages(spark, sf))


@register("cursor_gaps", "SELECT * FROM (" + _CHAIN_SQL + ") WHERE is_gap")
def q_cursor_gaps(spark, sf):
    return audit.cursor_gaps(C.events_pages(spark, sf))


@register("error_report", "WITH " + O.events_base() + """
SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS ts, run_id, 'events' AS institution, item_id,
       'incremental' AS mode, page_no AS page, '' AS cursor_in,
       'ApiException' AS error_type, 'sync failed: ' || props AS message,
       CAST(400 + (src_event_id % 3) * 50 AS BIGINT) AS status,
       CASE (src_event_id % 3) WHEN 0 THEN 'Bad Request' WHEN 1 THEN 'Unknown'
            ELSE 'Server Error' END AS reason,
       'TRANSACTIONS_ERROR' AS plaid_error_type,
       'E' || json_extract_string(props, '$.k') AS plaid_error_code,
       props AS plaid_error_message, CAST(NULL AS VARCHAR) AS plaid_display_message,
       substr(sha256(CAST(src_event_id AS VARCHAR)), 1, 12) AS plaid_request_id,
       CAST(NULL AS VARCHAR) AS plaid_documentation_url,
       CAST(NULL AS VARCHAR) AS plaid_suggested_action
FROM ev WHERE src_type = 'error'""")
def q_error_report(spark, sf):
    return audit.errors(C.events_runs_log(spark, sf))


# ------------------------------------------------------------ scalars

@register("scalar_slugify", r"""
SELECT 'part' AS src, p_partkey AS k, txt,
       CASE WHEN s2 = '' THEN 'unknown' ELSE s2 END AS slug
FROM (SELECT p_partkey, txt,
             regexp_replace(regexp_replace(lower(trim(txt)), '\s+', '_', 'g'),
                            '[^a-z0-9_\-]', '', 'g') AS s2
      FROM (SELECT p_partkey, ' ' || p_type || ' & ' || p_brand || '  ' AS txt FROM part))
UNION ALL
SELECT 'nation', CAST(n_nationkey AS BIGINT), n_name,
       CASE WHEN s2 = '' THEN 'unknown' ELSE s2 END
FROM (SELECT n_nationkey, n_name,
             regexp_replace(regexp_replace(lower(trim(n_name)), '\s+', '_', 'g'),
                            '[^a-z0-9_\-]', '', 'g') AS s2 FROM nation)
UNION ALL
SELECT 'customer', c_custkey, c_mktsegment, CASE WHEN c_mktsegment IS NULL OR s2 = ''
       THEN 'unknown' ELSE s2 END
FROM (SELECT c_custkey, c_mktsegment,
             regexp_replace(regexp_replace(lower(trim(coalesce(c_mktsegment, ''))), '\s+', '_', 'g'),
                            '[^a-z0-9_\-]', '', 'g') AS s2 FROM customer)""")
def q_scalar_slugify(spark, sf):
    p = C.table(spark, sf, "part").select(
        F.lit("part").alias("src"), F.col("p_partkey").alias("k"),
        F.concat(F.lit(" "), "p_type", F.lit(" & "), "p_brand", F.lit("  ")).alias("txt"))
    n = C.table(spark, sf, "nation").select(
        F.lit("nation").alias("src"), F.col("n_nationkey").cast("bigint").alias("k"),
        F.col("n_name").alias("txt"))
    c = C.table(spark, sf, "customer").select(
        F.lit("customer").alias("src"), F.col("c_custkey").alias("k"),
        F.col("c_mktsegment").alias("txt"))
    return p.unionByName(n).unionByName(c).withColumn("slug", S.slugify("txt"))


# Texts the boolean rule is tried on, picked per row by p_size.
BOOL_TEXTS = ["true", "Yes", " 0 ", "maybe", "N", "f", "1", ""]


@register("scalar_bool", f"""
SELECT p_partkey, txt,
       CASE WHEN lower(trim(txt)) IN ('true', 't', '1', 'yes', 'y') THEN TRUE
            WHEN lower(trim(txt)) IN ('false', 'f', '0', 'no', 'n') THEN FALSE END AS as_text,
       (p_size - 25) <> 0 AS as_number
FROM (SELECT p_partkey, p_size,
             list_extract({BOOL_TEXTS!r}, (p_size % {len(BOOL_TEXTS)}) + 1) AS txt FROM part)""")
def q_scalar_bool(spark, sf):
    p = C.table(spark, sf, "part")
    txt = F.element_at(F.array(*[F.lit(t) for t in BOOL_TEXTS]),
                       (F.pmod("p_size", F.lit(len(BOOL_TEXTS))) + 1).cast("int"))
    return p.select("p_partkey", txt.alias("txt"), (F.col("p_size") - 25).alias("n")).select(
        "p_partkey", "txt", S.normalize_bool("txt").alias("as_text"),
        S.normalize_bool("n", "int").alias("as_number"))


@register("scalar_iso_date", r"""
WITH d AS (
  SELECT o_orderkey, CASE o_orderkey % 5
      WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d')
      WHEN 1 THEN strftime(o_orderdate, '%Y%m%d')
      WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S')
      WHEN 3 THEN strftime(o_orderdate, '%Y')
      ELSE strftime(o_orderdate, '%Y-%-m-%-d') END AS txt
  FROM orders),
p AS (
  SELECT o_orderkey, txt, CASE
      WHEN regexp_matches(txt, '^\d{8}$')
        THEN TRY_CAST(substr(txt, 1, 4) || '-' || substr(txt, 5, 2) || '-' || substr(txt, 7, 2) AS DATE)
      WHEN regexp_matches(txt, '^\d{4}-\d{2}-\d{2}([T ].*)?$')
        THEN TRY_CAST(substr(txt, 1, 10) AS DATE) END AS d
  FROM d)
SELECT o_orderkey, txt, CAST(year(d) AS BIGINT) AS y, CAST(month(d) AS BIGINT) AS m FROM p""")
def q_scalar_iso_date(spark, sf):
    o = C.table(spark, sf, "orders")
    fmt = (F.when(F.pmod("o_orderkey", F.lit(5)) == 0, F.date_format("o_orderdate", "yyyy-MM-dd"))
           .when(F.pmod("o_orderkey", F.lit(5)) == 1, F.date_format("o_orderdate", "yyyyMMdd"))
           .when(F.pmod("o_orderkey", F.lit(5)) == 2,
                 F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
           .when(F.pmod("o_orderkey", F.lit(5)) == 3, F.date_format("o_orderdate", "yyyy"))
           .otherwise(F.date_format("o_orderdate", "yyyy-M-d")))
    d = o.select("o_orderkey", fmt.alias("txt"))
    y, m = S.iso_date_parts("txt")
    return d.select("o_orderkey", "txt", y.alias("y"), m.alias("m"))


@register("scalar_coalesce", """
SELECT c_custkey,
       coalesce(CASE WHEN trim(a) <> '' THEN a END, CASE WHEN trim(b) <> '' THEN b END,
                CASE WHEN trim(c) <> '' THEN c END) AS first_filled
FROM (SELECT c_custkey,
             CASE WHEN c_acctbal < 0 THEN '' ELSE NULL END AS a,
             CASE WHEN c_nationkey % 2 = 0 THEN '   ' ELSE c_mktsegment END AS b,
             c_name AS c
      FROM customer)""")
def q_scalar_coalesce(spark, sf):
    c = C.table(spark, sf, "customer")
    a = F.when(F.col("c_acctbal") < 0, F.lit(""))
    b = F.when(F.pmod("c_nationkey", F.lit(2)) == 0, F.lit("   ")).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", S.coalesce_blank(a, b, F.col("c_name")).alias("first_filled"))


@register("scalar_page_name", "WITH " + O.events_base() + """
SELECT DISTINCT page_path, page_name, CAST(page_no AS BIGINT) AS page, run_id FROM ev""")
def q_scalar_page_name(spark, sf):
    p = C.events_pages(spark, sf).select("page_path", "page_name")
    return p.select("page_path", "page_name", S.page_number("page_name").alias("page"),
                    S.page_run_id("page_name").alias("run_id"))



# ------------------------------------------------------------ streaming

def _scratch(spark: SparkSession, what: str) -> str:
    """A fresh folder below the shared checkpoint folder of the session."""
    import uuid
    from lakeledger.session import checkpoint_dir
    return f"{checkpoint_dir(spark).rstrip('/')}/lakeledger-{what}-{uuid.uuid4().hex[:12]}"


def _land(spark: SparkSession, sf: str, landing: str, part: str) -> None:
    """Land the events page set as JSON lines: runs before the cut-off as
    part a, the rest as part b."""
    from lakeledger.streaming.streams import PAGE_LINE
    pages = C.events_pages(spark, sf).select(*PAGE_LINE.fieldNames())
    early = F.col("run_ts") < LEDGER_CUT
    pages.filter(early if part == "a" else ~early).write.json(f"{landing}/{part}")


# All events as Bronze rows, clicks included.
_ALL_EVENTS = SQL["page_roundtrip"].replace(" WHERE src_type <> 'click'", "")


@register("bronze_stream", _ALL_EVENTS)
def q_bronze_stream(spark, sf):
    """Pages landed in two drops, ingested by an availableNow stream run
    after each drop and once more with nothing new; equals the batch result."""
    from lakeledger.streaming import streams
    base = _scratch(spark, "bronze-stream")
    for part in ("a", "b", None):
        if part:
            _land(spark, sf, f"{base}/landing", part)
        q = streams.bronze_stream(spark, f"{base}/landing", f"{base}/bronze",
                                  f"{base}/checkpoint", now=C.INGESTED_AT, layout="lines")
        q.awaitTermination()
    rows = bronze.read_bronze(spark, f"{base}/bronze")
    return rows.select(*_ROUNDTRIP_COLS,
                       F.get_json_object("raw_transaction_json", "$.transaction_id")
                       .alias("raw_id"))


@register("bronze_ingest_batch", _ALL_EVENTS)
def q_bronze_ingest_batch(spark, sf):
    """Batch ingest (F1, K1, K3, A8): the page set lands in two drops, each
    followed by an ingest run, then one more run with nothing new.  Equals
    the flattened pages; the repeat adds nothing."""
    base = _scratch(spark, "bronze-batch")
    for part in ("a", "b", None):
        if part:
            _land(spark, sf, f"{base}/landing", part)
        bronze.ingest(spark, f"{base}/landing", f"{base}/bronze", f"{base}/ledger",
                      now=C.INGESTED_AT, layout="lines")
    rows = bronze.read_bronze(spark, f"{base}/bronze")
    return rows.select(*_ROUNDTRIP_COLS,
                       F.get_json_object("raw_transaction_json", "$.transaction_id")
                       .alias("raw_id"))


@register("silver_stream", O.with_silver(f"SELECT {O.SILVER_COLS} FROM silver"))
def q_silver_stream(spark, sf):
    """foreachBatch keeps Silver current; each micro-batch rebuilds the
    keys it touched.  Equals the Silver of the batch ingest."""
    from lakeledger.streaming import streams
    base = _scratch(spark, "silver-stream")
    for part in ("a", "b"):
        _land(spark, sf, f"{base}/landing", part)
        q = streams.silver_stream(spark, f"{base}/landing", f"{base}/bronze", f"{base}/silver",
                                  f"{base}/checkpoint", now=C.INGESTED_AT,
                                  built_at=C.BUILT_AT, layout="lines")
        q.awaitTermination()
    return silver.read_silver(spark, f"{base}/silver")


@register("scd2_refresh", O.with_silver(f"SELECT {O.SILVER_COLS} FROM silver"))
def q_scd2_refresh(spark, sf):
    """Key-wise refresh: Silver of the first half of the month, then the
    second half's events; only touched keys are rebuilt.  Equals a full
    rebuild."""
    b = C.events_changelog(spark, sf)
    early = F.col("run_ts") < LEDGER_CUT
    old = silver.silver_from_bronze(b.filter(early), built_at=C.BUILT_AT)
    return silver.refresh_scd2(old, b, b.filter(~early), built_at=C.BUILT_AT)



@register("scd2_refresh_buckets", O.with_silver(f"SELECT {O.SILVER_COLS} FROM silver"))
def q_scd2_refresh_buckets(spark, sf):
    """T2 on the shared key layout: Bronze and Silver of the first half of the
    month are written, then the second half is appended and only the key
    buckets it touches are read, of both, and rebuilt (dynamic partition
    overwrite).  Equals a full rebuild."""
    base = _scratch(spark, "silver-buckets")
    b = C.events_changelog(spark, sf)
    early = F.col("run_ts") < LEDGER_CUT
    bronze.append_bronze(b.filter(early), f"{base}/bronze", 1)
    silver.write_silver(silver.silver_from_bronze(bronze.read_bronze(spark, f"{base}/bronze"), built_at=C.BUILT_AT),
                        f"{base}/silver")
    for _ in range(2):  # a lost batch that is written again counts once
        bronze.append_bronze(b.filter(~early), f"{base}/bronze", 2)
    silver.refresh_buckets(spark, f"{base}/bronze", b.filter(~early), f"{base}/silver", built_at=C.BUILT_AT)
    return silver.read_silver(spark, f"{base}/silver")


def _land_pages(pages: DataFrame, landing: str) -> int:
    """Writes each page where the puller does, one file a page at
    ``<landing>/<page_path>``; the tasks write the files."""
    spark = pages.sparkSession
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(landing)
    home = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(root).toUri().toString()
    skip = ("page_no", "page_path", "page_name")
    texts = pages.select("page_path", F.to_json(F.struct(*[c for c in pages.columns if c not in skip])).alias("text"))

    def write(batches):
        import pyarrow as pa
        from pyarrow import fs
        system, folder = fs.FileSystem.from_uri(home)
        made = set()
        for b in batches:
            for path, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at = f"{folder}/{path}".rsplit("/", 1)[0]
                if at not in made:
                    system.create_dir(at, recursive=True)
                    made.add(at)
                with system.open_output_stream(f"{folder}/{path}") as out:
                    out.write(text.encode())
            yield pa.RecordBatch.from_pydict({"n": [b.num_rows]})

    return texts.mapInArrow(write, "n long").agg(F.sum("n")).first()[0] or 0


@register("bronze_ingest_crash", _ALL_EVENTS)
def q_bronze_ingest_crash(spark, sf):
    """S1, K1, K3, F1 over page files: a first run finds only pages without
    events; a run over the first half of the month is lost after its append;
    the next run finds the second half landed, and one more finds nothing
    new.  Every event is in Bronze once and every page in the ledger."""
    base = _scratch(spark, "bronze-crash")
    paths = (f"{base}/bronze", f"{base}/ledger")
    events = C.events_pages(spark, sf).checkpoint(eager=True)  # landed in parts
    early = F.col("run_ts") < LEDGER_CUT
    empty = events.where("page_no = 0").limit(2)
    _land_pages(empty.select(
        F.lit("r0").alias("run_id"), F.lit("2023-12-31T00:00:00Z").alias("run_ts"), "institution", "item_id",
        F.concat_ws("/", "institution", "item_id", F.lit("sync_pages/page_0000_r0.json")).alias("page_path")),
        f"{base}/landing")
    bronze.ingest(spark, f"{base}/landing", *paths, now=C.INGESTED_AT)
    _land_pages(events.filter(early), f"{base}/landing")
    todo = bronze.new_pages(bronze.P.in_few_tasks(bronze.P.read_pages(spark, f"{base}/landing")),
                            bronze.processed_pages(spark, paths[1]))
    bronze.append_bronze(bronze.explode_pages(todo, C.INGESTED_AT), paths[0],
                         bronze.next_batch(spark, paths[1]))  # and no ledger line
    _land_pages(events.filter(~early), f"{base}/landing")
    for _ in range(2):
        bronze.ingest(spark, f"{base}/landing", *paths, now=C.INGESTED_AT)
    unmarked = bronze.P.list_pages(spark, f"{base}/landing").join(
        bronze.processed_pages(spark, paths[1]), "page_path", "left_anti")
    if not unmarked.isEmpty():
        raise AssertionError("a page is not in the ledger")
    rows = bronze.read_bronze(spark, paths[0])
    return rows.select(*_ROUNDTRIP_COLS,
                       F.get_json_object("raw_transaction_json", "$.transaction_id").alias("raw_id"))


# ------------------------------------------------------------ null keys

_NULL_KEYS_SPEC = silver.Scd2Spec(
    keys=("k_day", "k_flag"), event_time="run_ts", event_type="event_type",
    order=(silver.OrderItem("o_day"), silver.OrderItem("o_orderkey")), split=1)


@register("scd2_null_keys", """WITH o AS (
  SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(date_trunc('year', o_orderdate) AS DATE) END AS k_day,
         o_orderkey % 5 = 0 AS k_flag,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS o_day,
         CASE o_orderkey % 4 WHEN 0 THEN 'added' WHEN 1 THEN 'modified' WHEN 2 THEN 'removed' ELSE 'other' END AS event_type,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS run_ts
  FROM orders)""" + O.history_ctes("o", "k_day, k_flag", "o_day NULLS FIRST, o_orderkey", "run_ts") + """
SELECT k_day, k_flag, o_orderkey, version, valid_from_ts, valid_to_ts, is_current, is_deleted, is_active, change_type
FROM h""")
def q_scd2_null_keys(spark, sf):
    """History with nullable date keys and a nullable leading order column;
    a third of all rows has the null key, which is hot."""
    k = F.col("o_orderkey")
    o = C.table(spark, sf, "orders").select(
        "o_orderkey",
        F.when(k % 3 != 0, F.trunc(F.col("o_orderdate").cast("date"), "year")).alias("k_day"),
        (k % 5 == 0).alias("k_flag"),
        F.when(k % 11 != 0, F.col("o_orderdate").cast("date")).alias("o_day"),
        F.element_at(F.array(*map(F.lit, ("added", "modified", "removed", "other"))), (k % 4 + 1).cast("int"))
        .alias("event_type"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("run_ts"))
    h = silver.build_scd2(o, _NULL_KEYS_SPEC, C.BUILT_AT, hot_rows=500, segment_rows=500)
    return h.select("k_day", "k_flag", "o_orderkey", "version", "valid_from_ts", "valid_to_ts", "is_current",
                    "is_deleted", "is_active", "change_type")


# ------------------------------------------------------------ export runs

@register("export_runs", "WITH " + O.changelog_cte() + O.silver_ctes() + f""",
cl_early AS (SELECT * FROM cl WHERE run_ts < '{LEDGER_CUT}')""" + O.silver_ctes("cl_early", "silver_early", "he") + """,
w1 AS (SELECT max(valid_from_ts) AS w FROM silver_early),
second AS (SELECT * FROM silver WHERE valid_from_ts > (SELECT w FROM w1)),
w2 AS (SELECT coalesce(max(valid_from_ts), (SELECT w FROM w1)) AS w FROM second)
SELECT 'row' AS kind, item_id, transaction_id, CAST(version AS VARCHAR) AS version, valid_from_ts, CAST(NULL AS BIGINT) AS n
FROM (SELECT * FROM silver_early UNION ALL SELECT * FROM second)
UNION ALL SELECT 'log', NULL, NULL, NULL, (SELECT w FROM w1), (SELECT count(*) FROM silver_early)
UNION ALL SELECT 'log', NULL, NULL, NULL, (SELECT w FROM w2), (SELECT count(*) FROM second)
UNION ALL SELECT 'log', NULL, NULL, NULL, (SELECT w FROM w2), 0""")
def q_export_runs(spark, sf):
    """A stored Silver is exported, grows, is exported
    again, and a third time with nothing new.  The target's rows and the
    log's records."""
    base = _scratch(spark, "export-runs")
    b = C.events_changelog(spark, sf)
    for part in (b.filter(F.col("run_ts") < LEDGER_CUT), b, None):
        if part is not None:
            silver.write_silver(silver.silver_from_bronze(part, built_at=C.BUILT_AT), f"{base}/silver")
        export.incremental_export(spark, silver.read_silver(spark, f"{base}/silver"), f"{base}/target",
                                  f"{base}/log", "all", table_path=SILVER_PATH, now=C.INGESTED_AT)
    cols = ["item_id", "transaction_id", "version", "valid_from_ts"]
    rows = export.read_target(spark, f"{base}/target").select(
        F.lit("row").alias("kind"), *[F.col(c).cast("string") for c in cols], F.lit(None).cast("bigint").alias("n"))
    log = export.read_log(spark, f"{base}/log").select(
        F.lit("log").alias("kind"), *[F.lit(None).cast("string").alias(c) for c in cols[:3]],
        F.col("last_synced_valid_from_ts").alias("valid_from_ts"), F.col("rows_synced").alias("n"))
    return rows.unionByName(log)


@register("dq_bronze_broken", "WITH " + O.changelog_cte() + """,
broken AS (
  SELECT event_id, CASE WHEN pos % 7 = 0 THEN NULL ELSE item_id END AS item_id,
         CASE WHEN pos % 9 = 0 THEN NULL ELSE transaction_id END AS transaction_id,
         CASE WHEN pos % 11 = 0 THEN 'yesterday' ELSE run_ts END AS run_ts
  FROM cl UNION ALL SELECT event_id, item_id, transaction_id, run_ts FROM cl WHERE pos % 13 = 0),
ids AS (SELECT event_id, count(*) AS n FROM broken GROUP BY event_id),
counts AS (
  SELECT count(*) FILTER (WHERE item_id IS NULL) AS a, count(*) FILTER (WHERE transaction_id IS NULL) AS b,
         count(*) FILTER (WHERE run_ts = 'yesterday') AS c, count(*) - (SELECT count(*) FROM ids) AS d FROM broken)
SELECT unnest(['null_item_id', 'null_transaction_id', 'bad_run_ts', 'repeated_event_id']) AS "check",
       unnest([a, b, c, d]) AS violations, unnest([a = 0, b = 0, c = 0, d = 0]) AS passed FROM counts""")
def q_dq_bronze_broken(spark, sf):
    """Bronze broken on purpose: null keys, an unreadable run time, repeats."""
    b = C.events_changelog(spark, sf)
    pos = F.col("pos")
    bad = b.withColumns({
        "item_id": F.when(pos % 7 != 0, F.col("item_id")),
        "transaction_id": F.when(pos % 9 != 0, F.col("transaction_id")),
        "run_ts": F.when(pos % 11 == 0, F.lit("yesterday")).otherwise(F.col("run_ts"))})
    return quality.check_bronze(bad.unionByName(b.filter(pos % 13 == 0)))


from lakeledger.plans import gold as _gold, runs as _runs  # noqa: E402, F401  (register their queries)


def queries() -> dict[str, Query]:
    return dict(SPARK)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
