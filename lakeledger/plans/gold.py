"""Registered queries of what is built on Silver: reports kept current, budget
alerts, the merge with an edited export, schema checks and collapsed history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeledger import schemas
from lakeledger.operators import budgets, export, jsonschema, merge, reports, silver
from lakeledger.operators.upsert import UpsertTable
from lakeledger.plans import changelog as C
from lakeledger.plans import oracle as O
from lakeledger.plans.queries import LEDGER_CUT, _scratch, _sql_text, hot_key_changelog, register

# ------------------------------------------------------------ reports
REPORT_CUTS = ["2024-01-11T00:00:00.000000Z", "2024-01-21T00:00:00.000000Z"]
ORDER_CUTS = ["1996-07-01T00:00:00Z", "1997-12-01T00:00:00Z"]
_LEVELS = [("month+category", "month, category"), ("week+category", "week, category"), ("month", "month"),
           ("week", "week"), ("category", "category"), ("all", "")]


def kept_current(events: DataFrame, history, keys: list[str], cuts: list[str], spec: reports.ReportSpec,
                 base: str) -> DataFrame:
    """A report of a history that grows in refreshes at ``cuts``: each takes
    the touched keys' rows as stored before it and as rebuilt, and writes what
    they add and retract."""
    spark = events.sparkSession
    seen = None
    for i, cut in enumerate([*cuts, None], 1):
        upto = events if cut is None else events.where(F.col("run_ts") < cut)
        if seen is None:
            history(upto).write.parquet(f"{base}/history-{i}")
            change = reports.totals(spark.read.parquet(f"{base}/history-{i}"), spec)
        else:
            touched = upto.where(F.col("run_ts") >= seen).select(*keys).distinct()
            old = spark.read.parquet(f"{base}/history-{i - 1}")
            (history(upto.join(touched, keys, "left_semi")).unionByName(old.join(touched, keys, "left_anti"))
             .write.parquet(f"{base}/history-{i}"))
            new = spark.read.parquet(f"{base}/history-{i}")
            change = reports.difference(old.join(touched, keys, "left_semi"), new.join(touched, keys, "left_semi"), spec)
        for _ in range(i):  # a lost job that is run again counts once
            reports.add(change, f"{base}/report", i)
        seen = cut
    out = reports.roll_up(reports.read_report(spark, f"{base}/report"))
    return out.withColumn("amount", F.col("amount").cast("double"))


def _report_sql(rows: str) -> str:
    """Grouping sets over (day, category, amount) of relation ``rows``."""
    sets = ", ".join(f"({s})" for _, s in _LEVELS)
    case = " ".join(f"WHEN {sum(1 << (2 - i) for i, c in enumerate(reports.GROUP) if c not in s.split(', '))} THEN '{n}'"
                    for n, s in _LEVELS)
    return f""",
dated AS (SELECT coalesce(strftime(day, '%Y-%m'), 'none') AS month, CAST(date_trunc('week', day) AS DATE) AS week,
                 coalesce(nullif(category, ''), 'none') AS category, CAST(coalesce(amount, 0) AS DECIMAL(20, 4)) AS amount
          FROM {rows})
SELECT CASE grouping(month, week, category) {case} END AS level, month, week, category, count(*) AS n,
       CAST(sum(amount) AS DOUBLE) AS amount
FROM dated GROUP BY GROUPING SETS ({sets})"""


@register("spend_report", "WITH " + O.changelog_cte() + O.silver_ctes() + """,
counted AS (SELECT CAST(date AS DATE) AS day, name AS category, amount FROM silver WHERE is_active)"""
          + _report_sql("counted"))
def q_spend_report(spark, sf):
    """Weekly, monthly and category totals after two refreshes of the
    events' history, equal to a full recount."""
    return kept_current(C.events_changelog(spark, sf), lambda b: silver.silver_from_bronze(b, built_at=C.BUILT_AT),
                        ["item_id", "transaction_id"], REPORT_CUTS, reports.ReportSpec(category="name"),
                        _scratch(spark, "spend-report"))


@register("spend_report_orders", """WITH o AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderpriority,
         CASE o_orderstatus WHEN 'O' THEN 'added' WHEN 'P' THEN 'modified'
              WHEN 'F' THEN 'removed' ELSE o_orderstatus END AS event_type,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS run_ts FROM orders)"""
          + O.history_ctes("o", "o_custkey", "o_orderdate, o_orderkey", "run_ts") + """,
counted AS (SELECT CAST(o_orderdate AS DATE) AS day, o_orderpriority AS category, o_totalprice AS amount
            FROM h WHERE is_active)""" + _report_sql("counted"))
def q_spend_report_orders(spark, sf):
    """X3 over orders of several years: a customer's next order retracts the
    one before it from its own month."""
    return kept_current(C.orders_changelog(spark, sf), lambda o: silver.build_scd2(o, C.ORDERS_SPEC, C.BUILT_AT),
                        ["o_custkey"], ORDER_CUTS,
                        reports.ReportSpec("o_orderdate", "o_totalprice", "o_orderpriority"),
                        _scratch(spark, "spend-orders"))


# ------------------------------------------------------------ budgets
_BUDGET_SQL = """
tx AS (SELECT o_orderkey AS id, CAST(o_orderdate AS DATE) AS day, CAST(o_totalprice AS DECIMAL(20, 4)) AS amount,
              CASE WHEN o_orderkey % 3 = 0 THEN 'shared' ELSE o_orderpriority END AS category FROM orders),
budget AS (
  SELECT DISTINCT category || '/' || year(day) AS budget_id, category, make_date(year(day), 3, 1) AS valid_from,
         make_date(year(day) + 1, 2, 15) AS valid_to, 2000000.0 * (1 + year(day) % 3) AS budget_limit
  FROM tx WHERE category != 'shared'
  UNION ALL SELECT DISTINCT 'shared', category, CAST(NULL AS DATE), CAST(NULL AS DATE), 300000000.0 FROM tx WHERE category = 'shared'
  UNION ALL SELECT 'all', CAST(NULL AS VARCHAR), DATE '1995-01-20', DATE '1997-06-10', 250000000.0)"""


def budget_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Orders as transactions, a third of them of one category, and budgets for
    each category and year, for the common category and for everything."""
    tx = C.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_totalprice").alias("amount"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("shared")).otherwise(F.col("o_orderpriority")).alias("category"))
    year = F.year("day")
    each = tx.where("category != 'shared'").select(
        F.concat("category", F.lit("/"), year.cast("string")).alias("budget_id"), "category",
        F.make_date(year, F.lit(3), F.lit(1)).alias("valid_from"), F.make_date(year + 1, F.lit(2), F.lit(15)).alias("valid_to"),
        (2_000_000.0 * (1 + year % 3)).alias("budget_limit")).distinct()
    rest = spark.createDataFrame([("shared", "shared", None, None, 300_000_000.0),
                                  ("all", None, "1995-01-20", "1997-06-10", 250_000_000.0)],
                                 "budget_id string, category string, a string, b string, budget_limit double")
    rest = rest.select("budget_id", "category", F.col("a").cast("date").alias("valid_from"),
                       F.col("b").cast("date").alias("valid_to"), "budget_limit")
    return tx, each.unionByName(rest)


@register("budget_alerts", "WITH " + _BUDGET_SQL + """,
met AS (
  SELECT budget_id, budget_limit, id, day, sum(amount) OVER (PARTITION BY budget_id ORDER BY day, id) AS spent
  FROM tx JOIN budget b ON (b.category IS NULL OR b.category = tx.category)
    AND (valid_from IS NULL OR day >= valid_from) AND (valid_to IS NULL OR day < valid_to)),
shares AS (SELECT unnest([0.5, 0.8, 1.0]) AS share),
hit AS (SELECT budget_id, share, id, day, spent FROM met, shares
        WHERE spent >= CAST(budget_limit AS DECIMAL(20, 4)) * CAST(share AS DECIMAL(6, 4)))
SELECT budget_id, CAST(share AS DOUBLE) AS share, day, id, CAST(spent AS DOUBLE) AS spent FROM hit
QUALIFY row_number() OVER (PARTITION BY budget_id, share ORDER BY day, id) = 1""")
def q_budget_alerts(spark, sf):
    """The order with which each budget reaches half, four fifths and all of
    its limit; one budget holds a third of all orders, in several segments."""
    tx, limits = budget_input(spark, sf)
    out = budgets.alerts(tx, limits, segment_rows=5000)
    return out.withColumn("spent", F.col("spent").cast("double"))


# ------------------------------------------------------------ merge
_KEYS = list(merge.KEYS)
_SHEET = [c for c in schemas.EXPORT_COLUMNS if c not in _KEYS + ["city"]] + ["notes"]


def sheet_input(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The export of the month's first half, that sheet after people edited
    it, and the present rows."""
    b = C.events_changelog(spark, sf_dir)

    def texts(events):
        rows = silver.silver_from_bronze(events, built_at=C.BUILT_AT)
        return export.stringify(export.export_projection(rows))
    base, ours = texts(b.where(F.col("run_ts") < LEDGER_CUT)), texts(b)
    t = F.col("transaction_id").cast("bigint") + F.col("version").cast("bigint")
    edited = base.where(t % 11 != 0).withColumns({
        "merchant_name": F.when(t % 5 == 0, F.concat(F.lit("mine "), "merchant_name")).otherwise(F.col("merchant_name")),
        "is_current": F.when(t % 7 == 0, F.lit("False")).otherwise(F.col("is_current")),
        "valid_to_ts": F.when(t % 13 == 0, F.lit("2030")).otherwise(F.col("valid_to_ts")),
        "notes": F.when(t % 3 == 0, F.lit("seen")).otherwise(F.lit(""))}).drop("city")
    own = edited.where(t % 17 == 0).withColumn("transaction_id", F.concat(F.lit("own-"), "transaction_id"))
    again = edited.where(t % 19 == 0)
    return base, edited.unionByName(own).unionByName(again), ours


_SHEET_SQL = "WITH " + O.changelog_cte() + O.silver_ctes() + f""",
cl_early AS (SELECT * FROM cl WHERE run_ts < '{LEDGER_CUT}')""" + O.silver_ctes("cl_early", "silver_early", "he") + """,
base AS (SELECT {texts}, '' AS notes FROM silver_early),
ours AS (SELECT {texts}, '' AS notes FROM silver),
edit0 AS (SELECT * REPLACE (
    CASE WHEN t % 5 = 0 THEN 'mine ' || merchant_name ELSE merchant_name END AS merchant_name,
    CASE WHEN t % 7 = 0 THEN 'False' ELSE is_current END AS is_current,
    CASE WHEN t % 13 = 0 THEN '2030' ELSE valid_to_ts END AS valid_to_ts,
    CASE WHEN t % 3 = 0 THEN 'seen' ELSE '' END AS notes)
  FROM (SELECT *, CAST(transaction_id AS BIGINT) + CAST(version AS BIGINT) AS t FROM base) WHERE t % 11 <> 0),
sheet AS (SELECT * EXCLUDE t FROM edit0
  UNION ALL SELECT * EXCLUDE t REPLACE ('own-' || transaction_id AS transaction_id) FROM edit0 WHERE t % 17 = 0
  UNION ALL SELECT * EXCLUDE t FROM edit0 WHERE t % 19 = 0),
sheet_n AS (SELECT *, count(*) OVER (PARTITION BY {keys}) AS times FROM sheet),
met AS (SELECT {coalesced}, b.version IS NOT NULL AS in_b, t.version IS NOT NULL AS in_t, o.version IS NOT NULL AS in_o,
               {cells}
        FROM base b FULL JOIN (SELECT * FROM sheet_n WHERE times = 1) t USING ({keys}) FULL JOIN ours o USING ({keys})
        WHERE ({keys}) NOT IN (SELECT ({keys}) FROM sheet_n WHERE times > 1))""".format(
    texts=", ".join(_sql_text(c) for c in _KEYS + _SHEET if c != "notes"), keys=", ".join(_KEYS),
    coalesced=", ".join(_KEYS), cells=", ".join(f"b.{c} AS b_{c}, t.{c} AS t_{c}, o.{c} AS o_{c}" for c in _SHEET))


def _cell_sql(c: str) -> str:
    o = f"coalesce(b_{c}, '')" if c == "notes" else f"o_{c}"
    return f"""SELECT {", ".join(_KEYS)}, '{c}' AS "column",
  CASE WHEN t = o AND o = b THEN 'same' WHEN t = o THEN 'both' WHEN o = b THEN 'theirs' WHEN t = b THEN 'ours'
       ELSE 'conflict' END AS class, b AS base, t AS theirs, o AS ours,
  CASE WHEN t = o OR o = b THEN t WHEN t = b THEN o ELSE t END AS value
FROM (SELECT {", ".join(_KEYS)}, coalesce(b_{c}, '') AS b, t_{c} AS t, {o} AS o FROM met WHERE in_t AND in_o)"""


@register("sheet_merge_cells", _SHEET_SQL + ", cell AS (" + "\nUNION ALL ".join(map(_cell_sql, _SHEET))
          + ")\nSELECT * FROM cell WHERE class <> 'same'")
def q_sheet_merge_cells(spark, sf):
    """Each cell that people, Silver or both changed since the last export."""
    return merge.changed_cells(merge.three_way(*sheet_input(spark, sf)))


@register("sheet_merge_rows", _SHEET_SQL + f"""
SELECT {", ".join(_KEYS)}, {", ".join(
    (f"CASE WHEN in_t AND in_o THEN CASE WHEN t_{c} = o_{c} OR o_{c} = coalesce(b_{c}, '') THEN t_{c} "
     f"WHEN t_{c} = coalesce(b_{c}, '') THEN o_{c} ELSE t_{c} END WHEN in_t THEN t_{c} ELSE o_{c} END AS {c}"
     if c != "notes" else "coalesce(t_notes, '') AS notes") for c in _SHEET)}
FROM met WHERE (in_t AND in_o) OR (in_t AND NOT in_b AND NOT in_o) OR (in_o AND NOT in_b AND NOT in_t)
UNION ALL SELECT {", ".join(_KEYS + _SHEET)} FROM sheet_n WHERE times > 1""")
def q_sheet_merge_rows(spark, sf):
    """The sheet after the merge; conflicts keep what people wrote."""
    base, sheet, ours = sheet_input(spark, sf)
    return merge.merged_rows(merge.three_way(base, sheet, ours), sheet)


# ------------------------------------------------------------ schema checks
SCHEMA = {
    "type": "object",
    "required": ["transaction_id", "amount", "date"],
    "additionalProperties": False,
    "properties": {
        "transaction_id": {"type": "string", "minLength": 2, "maxLength": 3},
        "amount": {"type": "number", "minimum": 5, "exclusiveMaximum": 95},
        "date": {"type": "string", "format": "date"},
        "name": {"enum": ["click", "view", "purchase", None]},
        "pending": {"type": ["boolean", "null"]},
        "tags": {"type": "array", "minItems": 1, "maxItems": 3, "items": {"type": "integer", "maximum": 40}},
        "lines": {"type": "array", "items": {"type": "array", "items": {
            "type": "object", "required": ["k"], "properties": {"k": {"type": "string", "pattern": "^[a-z]+$"}}}}},
    },
}

#: One element of a page for each event, in SQL that both engines read.
_ELEMENT = """CASE WHEN event_id % 29 = 0 THEN '{"transaction_id":' WHEN event_id % 31 = 0 THEN '[1]' ELSE concat('{',
  CASE WHEN event_id % 13 = 0 THEN '' WHEN event_id % 17 = 0 THEN '"transaction_id":7,'
       ELSE concat('"transaction_id":"', CAST(user_id AS STRING), '",') END,
  '"amount":', CASE WHEN event_id % 11 = 0 THEN '"12"' ELSE CAST(CAST(FLOOR(value) AS BIGINT) AS STRING) END,
  ',"date":"', CASE event_id % 7 WHEN 0 THEN '2024-02-30' WHEN 1 THEN 'soon' ELSE '2024-01-31' END, '"',
  ',"name":', CASE WHEN event_id % 19 = 0 THEN 'null' ELSE concat('"', event_type, '"') END,
  ',"pending":', CASE event_id % 5 WHEN 0 THEN 'null' WHEN 1 THEN '1' ELSE 'true' END,
  CASE event_id % 4 WHEN 0 THEN ',"tags":[]' WHEN 1 THEN concat(',"tags":[1,', CAST(user_id % 50 AS STRING), ',"x",2.5]')
       WHEN 2 THEN ',"tags":[2.0]' ELSE '' END,
  CASE event_id % 6 WHEN 0 THEN concat(',"lines":[[{"k":"', event_type, '"},{"k":"A1"}],[{"j":1}],3]') ELSE '' END,
  CASE WHEN event_id % 23 = 0 THEN ',"extra":1' ELSE '' END, '}') END"""

_VIOLATIONS_SQL = f"""WITH el AS (
  SELECT CAST(event_id AS VARCHAR) AS page_path, {_ELEMENT.replace("STRING", "VARCHAR")} AS text FROM events),
j AS MATERIALIZED (SELECT page_path, text, CASE WHEN json_valid(text) THEN CAST(text AS JSON) END AS v FROM el),
ob AS MATERIALIZED (SELECT *, json_type(v) AS kind,
         v->'transaction_id' AS id, v->'amount' AS amount, v->'date' AS day, v->'name' AS name,
         v->'pending' AS pending, v->'tags' AS tags, v->'lines' AS lines FROM j WHERE v IS NOT NULL),
o AS (SELECT * FROM ob WHERE kind = 'OBJECT'),
tag AS (SELECT page_path, i, json_extract(tags, '$[' || i || ']') AS x
        FROM (SELECT page_path, tags, unnest(range(CAST(json_array_length(tags) AS BIGINT))) AS i FROM o WHERE tags IS NOT NULL)),
line AS (SELECT page_path, i, json_extract(lines, '$[' || i || ']') AS x
         FROM (SELECT page_path, lines, unnest(range(CAST(json_array_length(lines) AS BIGINT))) AS i FROM o WHERE lines IS NOT NULL)),
cell AS (SELECT page_path, i, k, json_extract(x, '$[' || k || ']') AS x
         FROM (SELECT page_path, i, x, unnest(range(CAST(json_array_length(x) AS BIGINT))) AS k FROM line WHERE json_type(x) = 'ARRAY'))
SELECT page_path, 'modified' AS "array", 0 AS pos, '$' AS path, 'json' AS rule FROM j WHERE v IS NULL
UNION ALL SELECT page_path, 'modified', 0, '$', 'type' FROM ob WHERE kind <> 'OBJECT'
UNION ALL SELECT page_path, 'modified', 0, '$.transaction_id', 'required' FROM o WHERE id IS NULL
UNION ALL SELECT page_path, 'modified', 0, '$.transaction_id', 'type' FROM o WHERE json_type(id) <> 'VARCHAR'
UNION ALL SELECT page_path, 'modified', 0, '$.transaction_id', 'minLength' FROM o WHERE json_type(id) = 'VARCHAR' AND length(id->>'$') < 2
UNION ALL SELECT page_path, 'modified', 0, '$.transaction_id', 'maxLength' FROM o WHERE json_type(id) = 'VARCHAR' AND length(id->>'$') > 3
UNION ALL SELECT page_path, 'modified', 0, '$.amount', 'type' FROM o WHERE json_type(amount) = 'VARCHAR'
UNION ALL SELECT page_path, 'modified', 0, '$.amount', 'minimum' FROM o WHERE json_type(amount) <> 'VARCHAR' AND CAST(amount AS DOUBLE) < 5
UNION ALL SELECT page_path, 'modified', 0, '$.amount', 'exclusiveMaximum' FROM o WHERE json_type(amount) <> 'VARCHAR' AND CAST(amount AS DOUBLE) >= 95
UNION ALL SELECT page_path, 'modified', 0, '$.date', 'format' FROM o WHERE TRY_CAST((day->>'$') AS DATE) IS NULL
UNION ALL SELECT page_path, 'modified', 0, '$.name', 'enum' FROM o WHERE json_type(name) <> 'NULL' AND (name->>'$') NOT IN ('click', 'view', 'purchase')
UNION ALL SELECT page_path, 'modified', 0, '$.pending', 'type' FROM o WHERE json_type(pending) NOT IN ('BOOLEAN', 'NULL')
UNION ALL SELECT page_path, 'modified', 0, '$.tags', 'minItems' FROM o WHERE json_array_length(tags) < 1
UNION ALL SELECT page_path, 'modified', 0, '$.tags', 'maxItems' FROM o WHERE json_array_length(tags) > 3
UNION ALL SELECT page_path, 'modified', 0, '$.tags[' || i || ']', 'type' FROM tag
  WHERE json_type(x) = 'VARCHAR' OR CAST(x AS DOUBLE) <> floor(CAST(x AS DOUBLE))
UNION ALL SELECT page_path, 'modified', 0, '$.tags[' || i || ']', 'maximum' FROM tag WHERE json_type(x) <> 'VARCHAR' AND CAST(x AS DOUBLE) > 40
UNION ALL SELECT page_path, 'modified', 0, '$.lines[' || i || ']', 'type' FROM line WHERE json_type(x) <> 'ARRAY'
UNION ALL SELECT page_path, 'modified', 0, '$.lines[' || i || '][' || k || '].k', 'required' FROM cell WHERE (x->'k') IS NULL
UNION ALL SELECT page_path, 'modified', 0, '$.lines[' || i || '][' || k || '].k', 'pattern' FROM cell
  WHERE (x->'k') IS NOT NULL AND NOT regexp_full_match((x->>'k'), '[a-z]+')
UNION ALL SELECT page_path, 'modified', 0, '$.extra', 'additionalProperties' FROM o WHERE (v->'extra') IS NOT NULL"""


@register("page_schema_violations", _VIOLATIONS_SQL)
def q_page_schema_violations(spark, sf):
    """Page elements with every kind of violation, the path of each."""
    pages = C.table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("page_path"), F.array(F.expr(_ELEMENT)).alias("modified"),
        F.array().cast("array<string>").alias("added"))
    return jsonschema.element_violations(pages, SCHEMA).drop("found").withColumn("pos", F.col("pos").cast("int"))


# ------------------------------------------------------------ collapsed history
TRACKED = ("name", "merchant_name", "pending")


@register("scd2_collapsed", "WITH " + O.changelog_cte() + f""",
cl_hot AS (
  SELECT * REPLACE (
    CASE WHEN CAST(transaction_id AS BIGINT) % 3 = 0 THEN '0' ELSE item_id END AS item_id,
    CASE WHEN CAST(transaction_id AS BIGINT) % 3 = 0 THEN '0' ELSE transaction_id END AS transaction_id)
  FROM cl),
state AS (SELECT *, CASE WHEN event_type = 'removed' THEN 'removed'
                         ELSE concat_ws('|', name, coalesce(merchant_name, '?'), coalesce(CAST(pending AS VARCHAR), '?')) END AS st FROM cl_hot),
changed AS (SELECT * FROM state QUALIFY st IS DISTINCT FROM lag(st) OVER (
  PARTITION BY item_id, transaction_id ORDER BY {O.BRONZE_ORDER}))""" + O.silver_ctes("changed")
          + f"\nSELECT {O.SILVER_COLS} FROM silver")
def q_scd2_collapsed(spark, sf):
    """Q15: one version for each run of events equal in the tracked columns;
    the hot key lies in several range segments."""
    b = silver.collapse_unchanged(hot_key_changelog(spark, sf), TRACKED, segment_rows=1000)
    return silver.silver_from_bronze(b, built_at=C.BUILT_AT)


# ------------------------------------------------------------ upsert tables
def upserted(events: DataFrame, keys: list[str], order: list[str], deleted: str, cuts: list[str]) -> DataFrame:
    """The feed in three deltas, of which the second comes last, and twice."""
    table = UpsertTable(events.sparkSession, keys, order, deleted)
    at = F.col("run_ts")
    parts = [events.where(at < cuts[0]), events.where((at >= cuts[0]) & (at < cuts[1])), events.where(at >= cuts[1])]
    for delta in (parts[0], parts[2], parts[1], parts[1]):
        table.apply(delta)
    return table.read()


@register("upsert_transactions", "WITH " + O.changelog_cte() + f"""
SELECT {O.BRONZE_COLS} FROM cl
QUALIFY row_number() OVER (PARTITION BY item_id, transaction_id
  ORDER BY run_ts DESC, page_name DESC, type_ord DESC, pos DESC, event_id DESC) = 1 AND event_type <> 'removed'""")
def q_upsert_transactions(spark, sf):
    """Transactions by id after three deltas with deletes."""
    return upserted(C.events_changelog(spark, sf), ["item_id", "transaction_id"],
                    ["run_ts", "page_name", "type_ord", "pos", "event_id"], "event_type = 'removed'", REPORT_CUTS)


@register("upsert_accounts", """WITH o AS (
  SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice, o_orderpriority,
         CASE o_orderstatus WHEN 'O' THEN 'added' WHEN 'P' THEN 'modified' WHEN 'F' THEN 'removed' ELSE o_orderstatus END AS event_type,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS run_ts FROM orders)
SELECT * FROM o QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY run_ts DESC, o_orderkey DESC) = 1
  AND event_type <> 'removed'""")
def q_upsert_accounts(spark, sf):
    """customers' accounts by id, with the last order, after three deltas
    with deletes."""
    return upserted(C.orders_changelog(spark, sf), ["o_custkey"], ["run_ts", "o_orderkey"], "event_type = 'removed'", ORDER_CUTS)
