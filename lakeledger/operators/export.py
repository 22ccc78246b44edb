"""Incremental export of Silver driven by a stored high-water mark.

The target is a table whose column list is its header (a CSV folder with a
header row); people may add own columns to it.  Each run exports the rows
above the last logged mark, appends them aligned to the target's header and
logs the new mark.  Marks:

  text    ``valid_from_ts`` as text (the default)
  typed   ``valid_from_ts`` as an instant, so texts with and without fractions
          or offsets compare by time; its order-preserving text is logged too
  built   a feed of changes: rows of builds at or after the last exported one
          that the target does not hold yet, by key and version.  Late rows,
          whose time lies below the mark, are exported as well

A run logs that it has begun before it appends.  A run that finds such a record
without its end knows that the run before was lost, maybe after its append: it
leaves out what the target holds already, by key and version.  So a crash
neither repeats rows nor loses any.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.errors import AnalysisException

from lakeledger import schemas
from lakeledger.functions import scalars as S
from lakeledger.operators.silver import now_iso
from lakeledger.session import checkpoint_dir
from lakeledger.sources import pages as P

MODES = ("current", "all")
MARKS = ("text", "typed", "built")
ROW_KEYS = ["item_id", "transaction_id", "version"]
WATERMARK_COL = "valid_from_ts"
# Fixed value: the export order.
EXPORT_ORDER = ["valid_from_ts", "institution", "item_id", "transaction_id", "version"]


def mode_predicate(mode: str) -> Column | None:
    mode = (mode or "").strip().lower()
    if mode not in MODES:
        raise ValueError("export mode must be 'current' or 'all'")
    # 'current' keeps tombstones (is_current), unlike the view 'current'.
    return F.col("is_current") == F.lit(True) if mode == "current" else None


def select_mode(df: DataFrame, mode: str) -> DataFrame:
    p = mode_predicate(mode)
    return df if p is None else df.filter(p)


def instant_key(c) -> Column:
    """An ISO time as a text that sorts like the instant (UTC, microseconds);
    null when it is no such time."""
    return S.iso_text(S.parse_iso(c))


def unsynced_predicate(mode: str, watermark: str | None, mark: str = "text") -> Column:
    """Conjunction of the optional predicates (mode, watermark), built as
    Column objects, never as SQL text.  Above a typed watermark are later
    instants only, not texts that are no times."""
    preds = [p for p in [mode_predicate(mode)] if p is not None]
    if watermark is not None:
        preds.append({"text": F.col(WATERMARK_COL) > F.lit(watermark),
                      "typed": instant_key(WATERMARK_COL) > F.lit(watermark),
                      "built": F.col("silver_built_at") >= F.lit(watermark)}[mark])
    return functools.reduce(operator.and_, preds) if preds else F.lit(True)


def export_projection(df: DataFrame) -> DataFrame:
    return df.select(*schemas.EXPORT_COLUMNS)


def export_order(df: DataFrame) -> DataFrame:
    """Export order; nulls sort last (ANSI engines' ascending default)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in EXPORT_ORDER])


def unsynced_rows(silver: DataFrame, mode: str, watermark: str | None) -> DataFrame:
    """Rows to export: filter (pushed to the Parquet scan), projection, order."""
    return export_order(export_projection(
        silver.filter(unsynced_predicate(mode, watermark))))


# ------------------------------------------------------------------ the log
def log_matches(log: DataFrame, env: str, worksheet: str, table_path: str,
                mode: str) -> DataFrame:
    """Records of this env, target, table and mode (``spreadsheet_id`` is not
    part of the match)."""
    return log.filter((F.col("plaid_env") == env) & (F.col("worksheet_name") == worksheet)
                      & (F.col("silver_delta_path") == table_path)
                      & (F.col("export_mode") == mode))


def _done(log: DataFrame) -> DataFrame:
    """Records of runs that ended (older logs hold no others)."""
    return log.where(F.coalesce("state", F.lit("done")) == "done") if "state" in log.columns else log


def last_watermark_df(log: DataFrame, env: str, worksheet: str, table_path: str,
                      mode: str) -> DataFrame:
    """One row: the greatest logged watermark (text order), null when none."""
    m = _done(log_matches(log, env, worksheet, table_path, mode))
    wm = F.when(F.col("last_synced_valid_from_ts") != "", F.col("last_synced_valid_from_ts"))
    return m.agg(F.max(wm).alias("last_synced_valid_from_ts"),
                 F.count(F.lit(1)).alias("matching_records"))


def last_watermark(log: DataFrame, env: str, worksheet: str, table_path: str,
                   mode: str) -> str | None:
    return last_watermark_df(log, env, worksheet, table_path, mode).first()[0]


def last_mark(log: DataFrame, env: str, worksheet: str, table_path: str, mode: str,
              mark: str = "text") -> str | None:
    """The greatest logged mark of a kind.  Typed marks of records without
    one are taken from their text; without a build, all builds are new."""
    if mark == "text":
        return last_watermark(log, env, worksheet, table_path, mode)
    m = _done(log_matches(log, env, worksheet, table_path, mode))
    of = {"typed": F.coalesce("last_synced_key", instant_key("last_synced_valid_from_ts")),
          "built": F.col("last_built_at")}[mark]
    return m.agg(F.max(of)).first()[0]


def run_numbers(log: DataFrame, env: str, worksheet: str, table_path: str, mode: str) -> tuple[int, bool]:
    """The next run's number, and whether a run began and did not end (since
    when, every run has to look at the target)."""
    m = log_matches(log, env, worksheet, table_path, mode).groupBy(F.coalesce("export_id", F.lit(0)).alias("n")).agg(
        F.count_if(F.col("state") == "begun").alias("begun"),
        F.count_if(F.coalesce("state", F.lit("done")) == "done").alias("done"))
    row = m.agg(F.max("n").alias("last"), F.max(F.when(F.col("done") > 0, F.col("n"))).alias("ended")).first()
    return (row["last"] or 0) + 1, (row["last"] or 0) > (row["ended"] or 0)


def read_log(spark: SparkSession, path: str, begun: bool = False) -> DataFrame:
    """The log's records: one for each run that ended, or also that it began."""
    log = P.read_jsonl_log(spark, path, schemas.SYNC_LOG)
    return log if begun else _done(log)


def log_run(spark: SparkSession, path: str, record: dict) -> None:
    row = {f: record.get(f) for f in schemas.SYNC_LOG.fieldNames()}
    spark.createDataFrame([row], schemas.SYNC_LOG).coalesce(1).write.mode("append").json(path)


# --------------------------------------------------------- target alignment
def align_to_header(df: DataFrame, header: list[str]) -> DataFrame:
    """Header order; header columns the data lacks are ''; data columns not
    in the header are dropped."""
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit("").alias(c) for c in header])


def _stringify(c: str, kind: str) -> Column:
    col = F.col(c)
    if kind == "boolean":
        v = F.when(col, F.lit("True")).when(~col, F.lit("False"))
    elif kind in ("double", "float"):
        # Spark writes 1.0E7 where Python writes 10000000.0: between 1e7 and
        # 1e16 go through a decimal and strip the padding zeros.
        big = (F.abs(col) >= 1e7) & (F.abs(col) < 1e16)
        dec = F.regexp_replace(col.cast("decimal(38,10)").cast("string"), "0+$", "")
        dec = F.regexp_replace(dec, r"\.$", ".0")
        v = F.when(F.isnan(col), F.lit(None)).when(big, dec).otherwise(col.cast("string"))
    else:
        v = col.cast("string")
    return F.coalesce(v, F.lit("")).alias(c)


def stringify(df: DataFrame) -> DataFrame:
    """Every cell as text: True/False, numbers as Python prints them, null ''."""
    kinds = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.select(*[_stringify(c, kinds[c]) for c in df.columns])


def read_target(spark: SparkSession, target: str) -> DataFrame | None:
    """The target as it is now, texts that hold line ends included; None when
    nothing is there."""
    from lakeledger.sources.tables import path_exists
    if not path_exists(spark, target):
        return None
    try:
        df = spark.read.option("header", True).option("multiLine", True).csv(target)
    except AnalysisException:
        return None
    return df if df.columns else None


def target_header(spark: SparkSession, target: str) -> list[str] | None:
    df = read_target(spark, target)
    return None if df is None else df.columns


def append_aligned(spark: SparkSession, df: DataFrame, target: str) -> list[str]:
    """Append ``df`` to the CSV table ``target``: a new target takes the
    data's columns as header; an existing one keeps its own header."""
    header = target_header(spark, target) or list(df.columns)
    out = stringify(align_to_header(df, header))
    out.write.mode("append").option("header", True).csv(target)
    return header


def not_in(rows: DataFrame, target: DataFrame | None) -> DataFrame:
    """The rows that the target does not hold, by key and version."""
    if target is None or not set(ROW_KEYS) <= set(target.columns):
        return rows
    t = target.select(*[F.col(k).try_cast(rows.schema[k].dataType).alias(k) for k in ROW_KEYS])
    return rows.join(t, ROW_KEYS, "left_anti")


def missed_rows(silver: DataFrame, target: DataFrame, watermark: str | None,
                mode: str = "all") -> DataFrame:
    """Rows never exported and never to be: not in the target (key and
    version) yet at or below the watermark (late arrivals, strict ``>``)."""
    cand = select_mode(silver, mode)
    if watermark is not None:
        cand = cand.filter(F.col(WATERMARK_COL) <= F.lit(watermark))
    return not_in(cand, target)


def incremental_export(spark: SparkSession, silver: DataFrame, target: str, log_path: str,
                       mode: str = "current", env: str = "sandbox",
                       worksheet: str = "transactions", table_path: str = "",
                       spreadsheet_id: str = "", now: str | None = None, mark: str = "text") -> dict:
    """One export run by a ``mark`` (see above); returns {rows, watermark}.
    An empty run is logged too, with the previous watermark."""
    if mark not in MARKS:
        raise ValueError(f"mark must be one of {MARKS}")
    now = now or now_iso()
    mode = mode.strip().lower()
    log = read_log(spark, log_path, begun=True)
    which = (env, worksheet, table_path, mode)
    wm, at = last_watermark(log, *which), last_mark(log, *which, mark)
    number, lost = run_numbers(log, *which)
    record = {"timestamp": now, "plaid_env": env, "silver_delta_path": table_path,
              "spreadsheet_id": spreadsheet_id, "worksheet_name": worksheet, "export_mode": mode, "export_id": number}
    # The run's rows, pinned in the shared folder: what is appended and what is
    # logged are the same, even if Silver changes meanwhile.
    checkpoint_dir(spark)
    rows = export_projection(silver.filter(unsynced_predicate(mode, at, mark))).checkpoint(eager=True)
    seen = rows.agg(F.max(WATERMARK_COL).alias("wm"), F.max(instant_key(WATERMARK_COL)).alias("key"),
                    F.max("silver_built_at").alias("built"), F.count(F.lit(1)).alias("n")).first()
    n = seen.n
    if lost or mark == "built":
        rows = not_in(rows, read_target(spark, target)).checkpoint(eager=True)
        n = rows.count()
    log_run(spark, log_path, record | {"state": "begun"})
    append_aligned(spark, export_order(rows.select(*schemas.EXPORT_COLUMNS)), target)
    top = max((x for x in (wm, seen.wm) if x is not None), default=None)
    if mark == "typed" and seen.key:
        top = seen.wm
    log_run(spark, log_path, record | {
        "state": "done", "rows_synced": n, "last_synced_valid_from_ts": top,
        "last_synced_key": seen.key or (at if mark == "typed" else None),
        "last_built_at": seen.built or (at if mark == "built" else None)})
    return {"rows": n, "watermark": top, "previous_watermark": wm}
