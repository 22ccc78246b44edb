"""Independent SQL statements of the registered queries, for DuckDB.

Each is written from the rules (the survey's formulas), not from our Spark
code: the SCD2 history uses the literal frame ``1 FOLLOWING .. UNBOUNDED
FOLLOWING``, the page set uses plain ``lag`` over the whole item.  Tables
are the pre-registered views of the given parquet files.
"""

from __future__ import annotations

from lakeledger.plans import changelog as C

KNOWN = "('added', 'modified', 'removed')"


def _type_case(unknown: tuple[str, ...] = ()) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in C.TYPE_MAP.items()
                     if k not in unknown)
    return f"CASE event_type {whens} ELSE event_type END"


def events_base(unknown: tuple[str, ...] = ()) -> str:
    return f"""
ev0 AS (
  SELECT event_id AS src_event_id, ts, user_id, value, props, event_type AS src_type,
         CAST(user_id % 10 AS VARCHAR) AS item_id,
         CAST(user_id AS VARCHAR) AS transaction_id,
         {_type_case(unknown)} AS event_type,
         strftime(ts, '%Y%m%d') || '_000000' AS run_id,
         strftime(ts, '%Y-%m-%d') || 'T00:00:00.000000Z' AS run_ts,
         event_id // {C.PAGE_SIZE} AS page_no
  FROM events),
ev1 AS (
  SELECT *, 'page_' || printf('%04d', page_no) || '_' || run_id || '.json' AS page_name
  FROM ev0),
ev AS (
  SELECT *, '{C.INSTITUTION}/' || item_id || '/sync_pages/' || page_name AS page_path,
         CAST(CASE event_type WHEN 'added' THEN 0 WHEN 'modified' THEN 1
                              WHEN 'removed' THEN 2 ELSE 1 END AS INTEGER) AS type_ord,
         src_event_id - page_no * {C.PAGE_SIZE} AS pos
  FROM ev1)"""


def changelog_cte(unknown: tuple[str, ...] = ()) -> str:
    """``events`` as the Bronze event log (all 36 columns)."""
    return events_base(unknown) + f""",
cl AS (
  SELECT '{C.PLAID_ENV}' AS plaid_env, run_id, run_ts,
         strftime(ts, '%Y-%m-%d') AS event_date,
         CAST(year(ts) AS BIGINT) AS event_year, CAST(month(ts) AS BIGINT) AS event_month,
         'incremental' AS mode, '{C.INSTITUTION}' AS institution, item_id,
         CAST(NULL AS VARCHAR) AS cursor_in, CAST(NULL AS VARCHAR) AS cursor_out,
         CAST(NULL AS BOOLEAN) AS has_more, page_path, event_type, transaction_id,
         sha256(item_id || '|' || run_id || '|' || page_path || '|' || event_type || '|'
                || transaction_id) AS event_id,
         CASE WHEN event_type <> 'removed' THEN item_id || '-' || CAST(user_id % 3 AS VARCHAR) END
           AS account_id,
         CASE WHEN event_type <> 'removed' THEN value END AS amount,
         CASE WHEN event_type <> 'removed' THEN 'USD' END AS iso_currency_code,
         CASE WHEN event_type <> 'removed' THEN strftime(ts, '%Y-%m-%d') END AS date,
         CAST(NULL AS VARCHAR) AS authorized_date,
         CASE WHEN event_type <> 'removed' THEN src_type END AS name,
         CASE WHEN event_type <> 'removed' THEN json_extract_string(props, '$.k') END
           AS merchant_name,
         CASE WHEN event_type <> 'removed' THEN value < 10 END AS pending,
         CAST(NULL AS VARCHAR) AS payment_channel, CAST(NULL AS VARCHAR) AS pfc_primary,
         CAST(NULL AS VARCHAR) AS pfc_detailed, CAST(NULL AS VARCHAR) AS pfc_confidence,
         CAST(NULL AS VARCHAR) AS city, CAST(NULL AS VARCHAR) AS region,
         CAST(NULL AS VARCHAR) AS country,
         CASE WHEN event_type <> 'removed' THEN props END AS raw_transaction_json,
         '{C.INGESTED_AT}' AS ingested_at, page_name, type_ord, pos,
         src_type
  FROM ev)"""


BRONZE_COLS = (
    "plaid_env, run_id, run_ts, event_date, event_year, event_month, mode, institution, "
    "item_id, cursor_in, cursor_out, has_more, page_path, event_type, transaction_id, "
    "event_id, account_id, amount, iso_currency_code, date, authorized_date, name, "
    "merchant_name, pending, payment_channel, pfc_primary, pfc_detailed, pfc_confidence, "
    "city, region, country, raw_transaction_json, ingested_at, page_name, type_ord, pos")

SILVER_COLS = (
    "plaid_env, institution, item_id, transaction_id, account_id, amount, "
    "iso_currency_code, date, authorized_date, name, merchant_name, pending, "
    "payment_channel, pfc_primary, pfc_detailed, pfc_confidence, city, region, country, "
    "valid_from_ts, valid_to_ts, is_current, is_active, is_deleted, change_type, version, "
    "source_event_id, source_event_type, source_run_id, source_run_ts, source_page_path, "
    "silver_built_at, txn_year, txn_month")

_STR_PAYLOAD = ["account_id", "iso_currency_code", "date", "authorized_date", "name",
                "merchant_name", "payment_channel", "pfc_primary", "pfc_detailed",
                "pfc_confidence", "city", "region", "country"]


def history_ctes(src: str, keys: str, order: str, ts: str, name: str = "h") -> str:
    """SCD2 by its definition over relation ``src``; adds ``{name}`` with
    version, valid_to_ts, is_current, is_deleted, is_active, change_type, ct."""
    return f""",
{name}0 AS (
  SELECT *, lower(trim(event_type)) AS ct, coalesce(nullif({ts}, ''), '{C.BUILT_AT}') AS vts
  FROM {src}),
{name}1 AS (
  SELECT *,
    row_number() OVER (PARTITION BY {keys} ORDER BY {order}) AS rn,
    first_value(CASE WHEN ct IN {KNOWN} THEN vts END IGNORE NULLS) OVER f AS next_known,
    last_value(vts) OVER f AS last_any,
    count(*) OVER f AS n_after
  FROM {name}0
  WINDOW f AS (PARTITION BY {keys} ORDER BY {order}
               ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
{name} AS (
  SELECT *, vts AS valid_from_ts,
    CASE WHEN n_after > 0 THEN coalesce(next_known, last_any) END AS valid_to_ts,
    n_after = 0 AS is_current, ct = 'removed' AS is_deleted,
    n_after = 0 AND ct <> 'removed' AS is_active, ct AS change_type,
    CAST(rn AS BIGINT) AS version
  FROM {name}1 WHERE ct IN {KNOWN})"""


BRONZE_ORDER = "run_ts, ingested_at, page_name, type_ord, pos, event_id"


def silver_ctes(src: str = "cl", out: str = "silver", h: str = "h") -> str:
    """Silver (34 columns) from a Bronze-shaped relation ``src``."""
    payload = ",\n    ".join(
        f"CASE WHEN NOT is_deleted THEN nullif({c}, '') END AS {c}" for c in _STR_PAYLOAD)
    return history_ctes(src, "item_id, transaction_id", BRONZE_ORDER, "run_ts", h) + f""",
{out} AS (
  SELECT plaid_env, institution, item_id, transaction_id,
    {payload},
    CASE WHEN NOT is_deleted THEN amount END AS amount,
    CASE WHEN NOT is_deleted THEN pending END AS pending,
    valid_from_ts, valid_to_ts, is_current, is_active, is_deleted, change_type, version,
    event_id AS source_event_id, event_type AS source_event_type,
    run_id AS source_run_id, run_ts AS source_run_ts, page_path AS source_page_path,
    '{C.BUILT_AT}' AS silver_built_at,
    CASE WHEN NOT is_deleted THEN CAST(year(CAST(date AS DATE)) AS BIGINT) END AS txn_year,
    CASE WHEN NOT is_deleted THEN CAST(month(CAST(date AS DATE)) AS BIGINT) END AS txn_month
  FROM {h})"""


def with_silver(select: str, unknown: tuple[str, ...] = ()) -> str:
    return "WITH " + changelog_cte(unknown) + silver_ctes() + "\n" + select


def pages_cte() -> str:
    """The page set of ``events`` with chained cursors."""
    return events_base() + f""",
pg0 AS (
  SELECT item_id, run_id, run_ts, page_no, page_name, page_path,
    count(*) FILTER (WHERE event_type = 'added') AS n_added,
    count(*) FILTER (WHERE event_type = 'modified') AS n_modified,
    count(*) FILTER (WHERE event_type = 'removed') AS n_removed,
    arg_max(src_type, pos) AS last_type,
    'c-' || item_id || '-' || run_id || '-' || printf('%04d', page_no) AS cursor_out
  FROM ev GROUP BY item_id, run_id, run_ts, page_no, page_name, page_path),
rn0 AS (
  SELECT item_id, run_id, max(page_no) AS last_page,
         arg_max(cursor_out, page_no) AS last_out, arg_max(last_type, page_no) AS run_last_type
  FROM pg0 GROUP BY item_id, run_id),
rn1 AS (
  SELECT item_id, run_id, last_page,
    CASE WHEN lag(last_out) OVER w IS NULL OR lag(run_last_type) OVER w = 'error' THEN ''
         ELSE lag(last_out) OVER w END AS run_cursor
  FROM rn0 WINDOW w AS (PARTITION BY item_id ORDER BY run_id)),
pset AS (
  SELECT p.*, '{C.INSTITUTION}' AS institution,
    coalesce(lag(p.cursor_out) OVER (PARTITION BY p.item_id, p.run_id ORDER BY p.page_no),
             r.run_cursor) AS cursor_in,
    p.page_no < r.last_page OR p.last_type = 'error' AS has_more,
    CASE WHEN r.run_cursor = '' THEN 'backfill' ELSE 'incremental' END AS mode
  FROM pg0 p JOIN rn1 r USING (item_id, run_id))"""
