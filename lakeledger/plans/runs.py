"""Registered queries of whole runs: exports that are lost or late, ingests of
one folder, raw values that do not cast, cursors of runs without a name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger import schemas
from lakeledger.functions import scalars as S
from lakeledger.operators import audit, bronze, export, jobs, quality, silver
from lakeledger.plans import changelog as C
from lakeledger.plans import oracle as O
from lakeledger.plans.queries import LEDGER_CUT, SILVER_PATH, _land_pages, _scratch, register
from lakeledger.sources import pages as P
from lakeledger.sources import tables

# ------------------------------------------------------------ exports
_EARLY = f""",
cl_early AS (SELECT * FROM cl WHERE run_ts < '{LEDGER_CUT}')""" + O.silver_ctes("cl_early", "silver_early", "he")
_KEYS = ", ".join(export.ROW_KEYS)


def _odd_name(c: str = "name"):
    """Names with line ends, quotes and commas, as people write them."""
    return F.when(F.col("version") % 3 == 0, F.concat(F.col(c), F.lit('\nsecond, "line"'))).otherwise(F.col(c))


@register("export_crash", "WITH " + O.changelog_cte() + O.silver_ctes() + _EARLY + f""",
target AS (SELECT {_KEYS}, name, is_current FROM silver_early UNION ALL SELECT {_KEYS}, name, is_current FROM silver
           WHERE ({_KEYS}) NOT IN (SELECT ({_KEYS}) FROM silver_early))
SELECT item_id, transaction_id, CAST(version AS VARCHAR) AS version,
       CASE WHEN version % 3 = 0 THEN name || chr(10) || 'second, "line"' ELSE name END AS name,
       CASE WHEN is_current THEN 'True' ELSE 'False' END AS is_current FROM target
UNION ALL SELECT 'runs', state, NULL, NULL, NULL FROM (SELECT unnest(['begun', 'begun', 'begun', 'done', 'done']) AS state)""")
def q_export_crash(spark, sf):
    """A run is lost between its append and its record; the next one
    neither repeats nor skips rows, and one more finds nothing.  Names hold line
    ends.  The target's rows and the log's states."""
    base = _scratch(spark, "export-crash")
    b = C.events_changelog(spark, sf)

    def rows(events):
        s = silver.silver_from_bronze(events, built_at=C.BUILT_AT)
        return s.withColumn("name", _odd_name())
    export.log_run(spark, f"{base}/log", {
        "timestamp": C.INGESTED_AT, "plaid_env": "sandbox", "silver_delta_path": SILVER_PATH,
        "worksheet_name": "transactions", "export_mode": "all", "export_id": 1, "state": "begun"})
    export.append_aligned(spark, export.unsynced_rows(rows(b.where(F.col("run_ts") < LEDGER_CUT)), "all", None),
                          f"{base}/target")  # and no further record
    for _ in range(2):
        export.incremental_export(spark, rows(b), f"{base}/target", f"{base}/log", "all", table_path=SILVER_PATH,
                                  now=C.INGESTED_AT)
    target = export.read_target(spark, f"{base}/target").select(*export.ROW_KEYS, "name", "is_current")
    log = export.read_log(spark, f"{base}/log", begun=True).select(
        F.lit("runs").alias("item_id"), F.col("state").alias("transaction_id"),
        *[F.lit(None).cast("string").alias(c) for c in ("version", "name", "is_current")])
    return target.unionByName(log)


@register("export_feed", "WITH " + O.changelog_cte() + O.silver_ctes() + """,
cl_some AS (SELECT * FROM cl WHERE pos % 5 <> 0)""" + O.silver_ctes("cl_some", "silver_some", "hs") + f""",
late AS (SELECT * FROM silver WHERE ({_KEYS}) NOT IN (SELECT ({_KEYS}) FROM silver_some))
SELECT 'row' AS kind, item_id, transaction_id, CAST(version AS VARCHAR) AS version, valid_from_ts, CAST(NULL AS BIGINT) AS n
FROM silver_some
UNION ALL SELECT 'row', item_id, transaction_id, CAST(version AS VARCHAR), valid_from_ts, NULL FROM late
UNION ALL SELECT 'log', NULL, NULL, NULL, NULL, (SELECT count(*) FROM silver_some)
UNION ALL SELECT 'log', NULL, NULL, NULL, NULL, (SELECT count(*) FROM late)
UNION ALL SELECT 'log', NULL, NULL, NULL, NULL, 0
UNION ALL SELECT 'missed', NULL, NULL, NULL, NULL, 0""")
def q_export_feed(spark, sf):
    """A fifth of the events arrives late, below the watermark; a
    refresh rebuilds their keys and the feed of builds exports what they add.
    The target's rows, the runs' numbers and how many rows were missed."""
    base = _scratch(spark, "export-feed")
    b = C.events_changelog(spark, sf)
    late = F.col("pos") % 5 == 0
    first = silver.silver_from_bronze(b.where(~late), built_at=C.BUILT_AT)
    first.write.parquet(f"{base}/silver-1")
    first = spark.read.parquet(f"{base}/silver-1")
    silver.refresh_scd2(first, b, b.where(late), built_at="2024-02-03T00:00:00.000000Z").write.parquet(f"{base}/silver-2")
    second = spark.read.parquet(f"{base}/silver-2")
    for s in (first, second, second):
        export.incremental_export(spark, s, f"{base}/target", f"{base}/log", "all", table_path=SILVER_PATH,
                                  now=C.INGESTED_AT, mark="built")
    target = export.read_target(spark, f"{base}/target")
    missed = export.missed_rows(second, target, None)
    none = [F.lit(None).cast("string").alias(c) for c in (*export.ROW_KEYS, "valid_from_ts")]
    return target.select(F.lit("row").alias("kind"), *export.ROW_KEYS, "valid_from_ts", F.lit(None).cast("bigint").alias("n")) \
        .unionByName(export.read_log(spark, f"{base}/log").select(
            F.lit("log").alias("kind"), *none, F.col("rows_synced").alias("n"))) \
        .unionByName(missed.agg(F.count(F.lit(1)).alias("n")).select(F.lit("missed").alias("kind"), *none, "n"))


_MIXED = """CASE version % 3 WHEN 0 THEN source_run_ts[1:10] || 'T00:00:47Z'
  WHEN 1 THEN source_run_ts[1:10] || 'T00:00:47.5Z' ELSE source_run_ts[1:10] || 'T01:00:47.250000+01:00' END"""


def mixed_times(rows: DataFrame) -> DataFrame:
    """Times of one second in three ISO forms, whose texts do not sort by time."""
    day = F.substring("source_run_ts", 1, 10)
    v = F.col("version") % 3
    return rows.withColumn("valid_from_ts", F.when(v == 0, F.concat(day, F.lit("T00:00:47Z"))).when(
        v == 1, F.concat(day, F.lit("T00:00:47.5Z"))).otherwise(F.concat(day, F.lit("T01:00:47.250000+01:00"))))


@register("export_typed", "WITH " + O.changelog_cte() + O.silver_ctes() + f""",
mixed AS (SELECT * REPLACE ({_MIXED} AS valid_from_ts) FROM silver),
parts AS (SELECT *, source_run_ts < '{LEDGER_CUT}' AND NOT (source_run_ts[1:10] = '2024-01-15' AND version % 3 <> 0) AS early FROM mixed)
SELECT item_id, transaction_id, CAST(version AS VARCHAR) AS version, valid_from_ts, CAST(1 AS BIGINT) AS copies FROM parts
UNION ALL SELECT 'log', CAST(count(*) FILTER (WHERE early) AS VARCHAR), NULL, '2024-01-15T00:00:47.000000Z', NULL FROM parts
UNION ALL SELECT 'log', CAST(count(*) FILTER (WHERE NOT early) AS VARCHAR), NULL,
  strftime(max(CAST(source_run_ts[1:10] AS DATE)), '%Y-%m-%d') || 'T00:00:47.500000Z', NULL FROM parts""")
def q_export_typed(spark, sf):
    """Q9: a first export ends at an instant whose text sorts behind later
    ones; by the typed mark every row is exported once.  The target's rows with
    their copies, and the log's marks as order-preserving texts."""
    base = _scratch(spark, "export-typed")
    mixed = mixed_times(silver.silver_from_bronze(C.events_changelog(spark, sf), built_at=C.BUILT_AT))
    day = F.substring("source_run_ts", 1, 10)
    early = (F.col("source_run_ts") < LEDGER_CUT) & ~((day == "2024-01-15") & (F.col("version") % 3 != 0))
    for rows in (mixed.where(early), mixed):
        export.incremental_export(spark, rows, f"{base}/target", f"{base}/log", "all", table_path=SILVER_PATH,
                                  now=C.INGESTED_AT, mark="typed")
    target = export.read_target(spark, f"{base}/target").groupBy(*export.ROW_KEYS, "valid_from_ts").agg(
        F.count(F.lit(1)).alias("copies"))
    log = export.read_log(spark, f"{base}/log").select(
        F.lit("log").alias("item_id"), F.col("rows_synced").cast("string").alias("transaction_id"),
        F.lit(None).cast("string").alias("version"), F.col("last_synced_key").alias("valid_from_ts"),
        F.lit(None).cast("bigint").alias("copies"))
    return target.unionByName(log)


# ------------------------------------------------------------ cursors
_NULLED = """nulled AS (
  SELECT * REPLACE (CASE WHEN item_id = '1' THEN NULL ELSE institution END AS institution,
                    CASE WHEN item_id = '2' THEN NULL ELSE item_id END AS item_id,
                    CASE WHEN run_id = '20240105_000000' THEN NULL ELSE run_id END AS run_id) FROM pset)"""


@register("cursor_chain_nulls", "WITH " + O.pages_cte() + ", " + _NULLED + """,
chain AS (
  SELECT institution, item_id, run_id, page_no AS page, cursor_in,
         coalesce(lag(cursor_out) OVER (PARTITION BY institution, item_id
                                        ORDER BY run_ts, run_id, page_no), '') AS expected_cursor_in, page_path
  FROM nulled)
SELECT *, cursor_in IS DISTINCT FROM expected_cursor_in AS is_gap FROM chain""")
def q_cursor_chain_nulls(spark, sf):
    """V9, R4 where an institution, an item and a run have no name: no page of
    them is lost."""
    p = C.events_pages(spark, sf)
    nulled = p.withColumns({
        "institution": F.when(F.col("item_id") != "1", F.col("institution")),
        "item_id": F.when(F.col("item_id") != "2", F.col("item_id")),
        "run_id": F.when(F.col("run_id") != "20240105_000000", F.col("run_id"))})
    return audit.cursor_chain(nulled)


# ------------------------------------------------------------ raw values
@register("dq_bronze_raw", "WITH " + O.events_base() + """,
el AS (SELECT * FROM ev WHERE event_type <> 'removed'),
kept AS (SELECT * FROM el WHERE src_event_id % 8 NOT IN (0, 1)),
counts AS (SELECT (SELECT count(*) FROM el WHERE src_event_id % 7 = 0) AS amount,
                  (SELECT count(*) FROM el WHERE src_event_id % 9 = 0) AS pending,
                  (SELECT count(*) - count(DISTINCT (item_id, run_id, page_path, event_type, transaction_id)) FROM kept) AS again,
                  (SELECT count(*) FROM kept) AS n,
                  (SELECT count(*) FROM kept WHERE src_event_id % 7 <> 0) AS amounts,
                  (SELECT count(*) FROM kept WHERE src_event_id % 9 <> 0) AS pendings)
SELECT unnest(['null_item_id', 'null_transaction_id', 'bad_run_ts', 'repeated_event_id', 'bad_amount', 'bad_pending',
               'rows', 'rows_with_amount', 'rows_with_pending']) AS "check",
       CAST(unnest([0, 0, 0, again, amount, pending, n, amounts, pendings]) AS BIGINT) AS violations FROM counts""")
def q_dq_bronze_raw(spark, sf):
    """Page elements whose amount or pending does not cast, and
    elements with an empty id or none, which are no events."""
    e = C.events_base(spark, sf).where("event_type != 'removed'")
    n = F.col("src_event_id")
    text = F.to_json(F.struct(
        F.when(n % 8 == 0, F.lit("")).when(n % 8 != 1, F.col("transaction_id")).alias("transaction_id"),
        F.when(n % 7 == 0, F.lit("much")).otherwise(F.col("value").cast("string")).alias("amount"),
        F.when(n % 9 == 0, F.lit("maybe")).when(n % 2 == 0, F.lit("yes")).otherwise(F.lit("0")).alias("pending")))
    pages = e.groupBy("item_id", "run_id", "run_ts", "page_name", "page_path").agg(
        *[F.collect_list(F.when(F.col("event_type") == t, text)).alias(t) for t in ("added", "modified")])
    pages = schemas.conform(pages.withColumn("removed", F.array().cast("array<variant>")), P.PAGE_LINE)
    rows = bronze.explode_pages(pages, C.INGESTED_AT)
    checks = quality.check_bronze(rows, bronze.raw_payload_failures(pages)).select("check", "violations")
    told = rows.agg(F.count(F.lit(1)).alias("rows"), F.count("amount").alias("rows_with_amount"),
                    F.count("pending").alias("rows_with_pending"))
    return checks.unionByName(told.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("check"), F.col(c).alias("violations")) for c in told.columns])).alias("r")).select("r.*"))


# ------------------------------------------------------------ ingest of a folder
@register("ingest_totals", "WITH " + O.events_base() + """,
item0 AS (SELECT count(*) AS n, count(DISTINCT page_path) AS p FROM ev WHERE item_id = '0'),
rest AS (SELECT count(*) AS n, count(DISTINCT page_path) AS p FROM ev WHERE item_id <> '0')
SELECT 'item 0' AS run, p AS pages, n AS "rows" FROM item0
UNION ALL SELECT 'no such folder', 0, 0
UNION ALL SELECT 'the rest', p, n FROM rest
UNION ALL SELECT 'again', 0, 0
UNION ALL SELECT 'silver', item0.n + rest.n, item0.n + rest.n FROM item0, rest
UNION ALL SELECT 'no table', 0, 1
UNION ALL SELECT 'columns missing', 0, 1""")
def q_ingest_totals(spark, sf):
    """The folder of one item, a folder that does not
    exist, then everything, with the totals each job reports; a table that is
    not there and one without its columns are refused."""
    base = _scratch(spark, "ingest-totals")
    _land_pages(C.events_pages(spark, sf), f"{base}/landing")
    paths = (f"{base}/landing", f"{base}/bronze", f"{base}/ledger")
    out = [(name, m["pages"], m["rows"]) for name, m in [
        (name, jobs.run_bronze(spark, *paths, now=C.INGESTED_AT, institution=where, item_id=item))
        for name, where, item in (("item 0", C.INSTITUTION, "0"), ("no such folder", "nobody", None),
                                  ("the rest", None, None), ("again", None, None))]]
    m = jobs.run_silver(spark, paths[1], f"{base}/silver", C.BUILT_AT)
    out.append(("silver", m["bronze_rows"], m["silver_rows"]))
    for name, job in (("no table", lambda: jobs.run_silver(spark, f"{base}/none", f"{base}/silver")),
                      ("columns missing", lambda: schemas.require_columns(
                          bronze.read_bronze(spark, paths[1]).drop("event_id"), {"event_id"}))):
        try:
            job()
            out.append((name, 0, 0))
        except (tables.TableNotFound, ValueError):
            out.append((name, 0, 1))
    return spark.createDataFrame(out, "run string, pages long, rows long")


# ------------------------------------------------------------ scalars
@register("scalar_page_path", """
SELECT p_partkey, 'raw/' || p_type || '/' || p_name || '+' || p_brand || '%.json' AS page_path FROM part""")
def q_scalar_page_path(spark, sf):
    """C14: the path below the landing root out of a file's URI, whose blanks,
    signs and letters are percent-encoded."""
    p = C.table(spark, sf, "part")
    name = F.concat("p_type", F.lit("/"), "p_name", F.lit("+"), "p_brand", F.lit("%.json"))
    quoted = F.replace(F.replace(F.replace(name, F.lit("%"), F.lit("%25")), F.lit(" "), F.lit("%20")), F.lit("#"), F.lit("%23"))
    uri = F.concat(F.when(F.col("p_partkey") % 2 == 0, F.lit("file:///land ing/")).otherwise(F.lit("file:/land ing/")), quoted)
    return p.select("p_partkey", S.relative_path(uri, "file:/land ing", "raw/").alias("page_path"))


@register("scalar_bool_words", """
WITH w AS (SELECT lower(trim(w, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13), chr(160)))) AS w
           FROM (SELECT unnest(string_split(text, ' ')) AS w FROM documents WHERE text IS NOT NULL)),
v AS (SELECT w, CASE WHEN w IN ('true', 't', '1', 'yes', 'y') THEN TRUE WHEN w IN ('false', 'f', '0', 'no', 'n') THEN FALSE END AS v
      FROM w)
SELECT v AS "value", count(*) AS n, count(DISTINCT w) AS forms FROM v GROUP BY v""")
def q_scalar_bool_words(spark, sf):
    """C8 over all words of the documents: how many mean true, false, neither."""
    w = C.table(spark, sf, "documents").where("text IS NOT NULL").select(F.explode(F.split("text", " ")).alias("w"))
    return w.select(S.normalize_bool("w").alias("value"), F.lower(S.strip("w")).alias("w")).groupBy("value").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("w").alias("forms"))


@register("scalar_iso_date_tails", r"""
WITH d AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderkey % 8 AS k FROM orders),
t AS (SELECT o_orderkey, k, day, day || CASE k WHEN 0 THEN 'T' WHEN 1 THEN ' noon' WHEN 2 THEN 'T25' WHEN 3 THEN 'T10:00:00Z'
        WHEN 4 THEN ' 10:00' WHEN 5 THEN 'T10:00:00.123456+02:00' WHEN 6 THEN 'x' ELSE 'T10:00:00 UTC' END AS txt FROM d),
p AS (SELECT o_orderkey, txt, CASE WHEN k IN (2, 3, 4, 5) THEN CAST(day AS DATE) END AS d FROM t)
SELECT o_orderkey, txt, CAST(year(d) AS BIGINT) AS y, CAST(month(d) AS BIGINT) AS m FROM p""")
def q_scalar_iso_date_tails(spark, sf):
    """What may stand behind a date, and what makes it none.  (The time of
    day has its form, and its range plays no part.)"""
    k = F.col("o_orderkey") % 8
    tails = ["T", " noon", "T25", "T10:00:00Z", " 10:00", "T10:00:00.123456+02:00", "x", "T10:00:00 UTC"]
    tail = F.element_at(F.array(*map(F.lit, tails)), (k + 1).cast("int"))
    d = C.table(spark, sf, "orders").select("o_orderkey", F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), tail).alias("txt"))
    y, m = S.iso_date_parts("txt")
    return d.select("o_orderkey", "txt", y.alias("y"), m.alias("m"))


# ------------------------------------------------------------ keyed state
@register("version_stream", O.with_silver(f"SELECT {O.SILVER_COLS} FROM silver", unknown=("view",)))
def q_version_stream(spark, sf):
    """T2, T4 with keyed state: the first and last third of the month land,
    then the middle one, late; each is a trigger of its own, after a restart
    from the checkpoint.  ``view`` is an unknown type.  Equals batch Silver."""
    from lakeledger.streaming import versions
    base = _scratch(spark, "versions")
    rows = C.events_changelog(spark, sf, ("view",))
    at = F.col("run_ts")
    third = F.when(at < "2024-01-11", 0).when(at < "2024-01-21", 2).otherwise(1)
    for k in range(3):
        rows.where(third == k).write.mode("append").parquet(f"{base}/landing")
        stream = spark.readStream.schema(schemas.BRONZE).parquet(f"{base}/landing")
        versions.version_stream(stream, f"{base}/bronze", f"{base}/feed", f"{base}/checkpoint",
                                C.BUILT_AT).awaitTermination()
    return versions.read_history(spark, f"{base}/feed")
