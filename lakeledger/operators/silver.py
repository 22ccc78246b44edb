"""Silver: SCD2 history from an event log.

Per key, events in a total order become versions.  Each event closes the
version before it; an event of an unknown type closes but adds no version
(and uses up a version number); ``removed`` adds a tombstone.

Formulas (keys = spec.keys, ord = spec.order, ts = event time text):

  version     = position of the event in its key's order (1, 2, ...)
  valid_to_ts = ts of the next event of a known type after it, else ts of the
                last event after it (an unknown type), else null
  is_current  = no event after it
  is_active   = is_current and not a tombstone

Forms, all equal in result (tests check it):

  "definition"  frame ``1 FOLLOWING .. UNBOUNDED FOLLOWING``; the literal
                definition, O(n^2) per key in Spark: small inputs only.
  "fast"        the same frame read backwards (``UNBOUNDED PRECEDING ..
                1 PRECEDING`` over the reversed order), evaluated
                incrementally: one exchange, one sort.
  "lead"        ``lead(ts)``; valid only when every type is known.
  "auto"        (default) "fast" for ordinary keys and "range" for all with
                more than HOT_ROWS events, found by one partially aggregated
                count per key.
  "range"       "split" with segments cut by range partitioning on (key,
                order): sampled bounds cut even one key into pieces of about
                SEGMENT_ROWS events, whatever the order's columns hold; the
                partition number, monotone along the order, is the segment
                (``segments.ranged`` puts many small ones into a partition).
  "split"       two levels.  Segments cut a key's chain into contiguous
                pieces; level 1 is a window per (key, segment), level 2 a
                window over one summary row per segment.  Here the order's
                leading ``spec.split`` columns are the segments (for the event
                log: one page of one run), so level 2 has a row for each page
                of a key; "range" bounds it by size / SEGMENT_ROWS.
"""

from __future__ import annotations

import datetime as _dt
import functools
import operator
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeledger import schemas
from lakeledger.functions import scalars as S
from lakeledger.operators import segments
from lakeledger.sources import layout, tables

FORMS = ("auto", "split", "range", "fast", "definition", "lead")

# Routing of the "auto" form: all keys with more events than HOT_ROWS take the
# range form, all others the fast form.  Both are exact for every key.
HOT_ROWS = 2_000_000
# Hot keys up to which their list is broadcast; beyond it Spark chooses.
HOT_SEND = 10_000
# Target size of one range segment of a hot key (events).
SEGMENT_ROWS = 1_000_000
# Rows that a task sorts or joins, about, where the shuffle partitions of the
# session would hold more (a key stays whole).
TASK_ROWS = 250_000


@dataclass(frozen=True)
class OrderItem:
    """One component of the event order (a SQL expression over the input
    columns), ascending, nulls first."""
    expr: str


@dataclass(frozen=True)
class Scd2Spec:
    keys: tuple[str, ...] = ("item_id", "transaction_id")
    event_time: str = "run_ts"           # text; also the version's valid_from_ts
    event_type: str = "event_type"
    order: tuple[OrderItem, ...] = ()
    upsert_types: tuple[str, ...] = ("added", "modified")
    delete_types: tuple[str, ...] = ("removed",)
    # number of leading order items that cut a key into segments ("split")
    split: int = 0

    @property
    def known_types(self) -> tuple[str, ...]:
        return self.upsert_types + self.delete_types


# The event log's order (rule Q3 of the survey): run time, ingestion time, then
# page name, added < modified < removed, array position, event id.
BRONZE_SPEC = Scd2Spec(
    order=(
        OrderItem("try_to_timestamp(run_ts)"),
        OrderItem("try_to_timestamp(ingested_at)"),
        OrderItem("page_name"),
        OrderItem("type_ord"),
        OrderItem("pos"),
        OrderItem("event_id"),
    ),
    split=3,
)


def now_iso() -> str:
    return _dt.datetime.now(_dt.UTC).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


# ---------------------------------------------------------------- core build
def _prepare(df: DataFrame, spec: Scd2Spec, built_at: str) -> tuple[DataFrame, list[str]]:
    ords = [f"__o{i}" for i in range(len(spec.order))]
    cols = [F.col(c) for c in df.columns]
    cols += [F.expr(o.expr).alias(n) for o, n in zip(spec.order, ords)]
    cols += [
        S.normalize_type(spec.event_type).alias("__ct"),
        F.coalesce(F.nullif(F.col(spec.event_time).cast("string"), F.lit("")),
                   F.lit(built_at)).alias("__ts"),
    ]
    out = df.select(*cols)
    out = out.withColumn("__known", F.col("__ct").isin(list(spec.known_types)))
    return out, ords


def _asc(ords):
    return [F.col(c).asc_nulls_first() for c in ords]


def _desc(ords):
    return [F.col(c).desc_nulls_last() for c in ords]


def _known_ts() -> Column:
    return F.when(F.col("__known"), F.col("__ts"))


def _finish(df: DataFrame, spec: Scd2Spec) -> DataFrame:
    """From (__version, __n_after, __next_known, __last_any) to the SCD2
    columns; rows of unknown types are dropped only here (after the window)."""
    is_current = F.col("__n_after") == 0
    is_deleted = F.col("__ct").isin(list(spec.delete_types))
    keep = [c for c in df.columns if not c.startswith("__")]
    out = df.filter(F.col("__known")).select(
        *keep,
        F.col("__ts").alias("valid_from_ts"),
        F.when(~is_current, F.coalesce(F.col("__next_known"), F.col("__last_any")))
        .alias("valid_to_ts"),
        is_current.alias("is_current"),
        is_deleted.alias("is_deleted"),
        (is_current & ~is_deleted).alias("is_active"),
        F.col("__ct").alias("change_type"),
        F.col("__version").cast("bigint").alias("version"))
    return out


def _definition(df, spec, ords):
    w = Window.partitionBy(*spec.keys).orderBy(*_asc(ords))
    f = w.rowsBetween(1, Window.unboundedFollowing)
    return (df.withColumn("__version", F.row_number().over(w))
            .withColumn("__next_known", F.first(_known_ts(), ignorenulls=True).over(f))
            .withColumn("__last_any", F.last("__ts").over(f))
            .withColumn("__n_after", F.count(F.lit(1)).over(f)))


def _fast(df, spec, ords):
    d = Window.partitionBy(*spec.keys).orderBy(*_desc(ords))
    r = d.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns({
        "__rn": F.row_number().over(d),
        "__n": F.count(F.lit(1)).over(Window.partitionBy(*spec.keys)),
        "__next_known": F.last(_known_ts(), ignorenulls=True).over(r),
        "__last_any": F.first("__ts").over(r)})
    return df.withColumns({"__version": F.col("__n") - F.col("__rn") + 1,
                           "__n_after": F.col("__rn") - 1})


def _lead(df, spec, ords):
    w = Window.partitionBy(*spec.keys).orderBy(*_asc(ords))
    nxt = F.lead("__ts").over(w)
    return (df.withColumn("__version", F.row_number().over(w))
            .withColumn("__next_known", nxt)
            .withColumn("__last_any", F.lit(None).cast("string"))
            .withColumn("__n_after", F.when(nxt.isNull(), 0).otherwise(1)))


def _split(df, spec, ords, segments: list[str] | None = None):
    # Keys and order columns may hold nulls.  Inside a struct, which is never
    # null itself, nulls are values like others for windows, groups, joins
    # and comparisons (nulls first), so a null and the lowest value differ.
    parts = [F.col(c) for c in (segments or ords[:spec.split])]
    # The segment is one struct column: window partitioning and join keys are
    # the same attributes, and no field can be dropped from one of them.
    df = df.withColumns({
        "__key": F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(spec.keys)]),
        "__seg": F.struct(*[c.alias(f"s{i}") for i, c in enumerate(parts)])})
    gkeys = ["__key", "__seg"]

    # Level 1: inside one segment, read backwards in the full order.
    d = Window.partitionBy(*gkeys).orderBy(*_desc(ords))
    r = d.rowsBetween(Window.unboundedPreceding, -1)
    rows = (df.withColumn("__rn_g", F.row_number().over(d))
            .withColumn("__nk_g", F.last(_known_ts(), ignorenulls=True).over(r))
            .withColumn("__la_g", F.first("__ts").over(r)))

    # One summary row per segment (size, first known ts, last ts) by an
    # aggregation: partial aggregation in the map tasks means only about one
    # row per segment and task is shuffled, not the rows themselves.
    order_struct = F.struct(*[F.col(c) for c in ords])
    summ = df.groupBy(*gkeys).agg(
        F.count(F.lit(1)).alias("__n_s"),
        F.min_by(F.col("__ts"), F.when(F.col("__known"), order_struct)).alias("__fk_g"),
        F.max_by(F.col("__ts"), order_struct).alias("__last_g"))

    # Level 2: segments of one key, read backwards.
    d2 = Window.partitionBy("__key").orderBy(F.col("__seg").desc())
    r2 = d2.rowsBetween(Window.unboundedPreceding, -1)
    summ = (summ
            .withColumn("__after_g", F.coalesce(F.sum("__n_s").over(r2), F.lit(0)))
            .withColumn("__total", F.sum("__n_s").over(Window.partitionBy("__key")))
            .withColumn("__nk_after", F.last("__fk_g", ignorenulls=True).over(r2))
            .withColumn("__la_after", F.first("__last_g").over(r2)))
    summ = summ.select(*gkeys, "__n_s", "__after_g", "__total", "__nk_after", "__la_after")

    j = rows.join(summ, on=gkeys, how="inner")
    before = F.col("__total") - F.col("__after_g") - F.col("__n_s")
    return (j.withColumn("__version", before + F.col("__n_s") - F.col("__rn_g") + 1)
            .withColumn("__n_after", F.col("__rn_g") - 1 + F.col("__after_g"))
            .withColumn("__next_known", F.coalesce("__nk_g", "__nk_after"))
            .withColumn("__last_any", F.coalesce("__la_after", "__la_g")))


def _range(df, spec, ords, rows: int, segment_rows: int):
    """Two levels with range segments.  The segment assignment is pinned in
    the shared checkpoint folder, so every later branch and any recomputed
    task sees the same segments."""
    order = ([F.col(k).asc_nulls_first() for k in spec.keys]
             + [F.col(o).asc_nulls_first() for o in ords])
    return _split(segments.ranged(df, rows, segment_rows, order, "__rseg"), spec, ords, segments=["__rseg"])


def spread(df: DataFrame, rows: int, keys: list[str]) -> DataFrame:
    """``df`` of ``rows`` rows dealt by key to more tasks than the session's
    shuffle partitions where these would get more than ``TASK_ROWS`` each."""
    n = -(-rows // TASK_ROWS)
    few = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *[F.col(k) for k in keys]) if n > few else df


def _auto(df, spec, ords, hot_rows: int, segment_rows: int):
    """All keys with more than ``hot_rows`` events to the range form, in
    segments of about ``segment_rows``, the rest to the one-window form.
    Their list stays distributed."""
    from lakeledger.session import checkpoint_dir
    checkpoint_dir(df.sparkSession)
    keys = list(spec.keys)
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__cnt"))
    is_hot = F.col("__cnt") > hot_rows
    n_hot, total, rows = sizes.agg(F.count_if(is_hot), F.sum(F.when(is_hot, F.col("__cnt"))), F.sum("__cnt")).first()
    if not n_hot:
        return _fast(spread(df, rows or 0, keys), spec, ords)
    hot = sizes.filter(is_hot).checkpoint(eager=True)  # a short list, read by both sides
    if n_hot <= HOT_SEND:
        hot = F.broadcast(hot)
    hot = hot.select(*[F.col(k).alias(f"__h{i}") for i, k in enumerate(keys)], F.lit(True).alias("__hot"))
    cond = functools.reduce(operator.and_, [F.col(k).eqNullSafe(F.col(f"__h{i}")) for i, k in enumerate(keys)])
    cols = df.columns + ["__version", "__n_after", "__next_known", "__last_any"]
    cold = _fast(spread(df.join(hot, cond, "left_anti"), rows - total, keys), spec, ords).select(*cols)
    warm = _range(df.join(hot, cond, "left_semi"), spec, ords, total, segment_rows).select(*cols)
    return cold.unionByName(warm)


def build_scd2(df: DataFrame, spec: Scd2Spec = BRONZE_SPEC, built_at: str | None = None,
               form: str = "auto", hot_rows: int = HOT_ROWS,
               segment_rows: int | None = None) -> DataFrame:
    """Versions of every key of ``df``.

    Returns the input columns plus valid_from_ts, valid_to_ts, is_current,
    is_deleted, is_active, change_type, version.  ``built_at`` is the event
    time of events without one (default: now, taken once on the driver);
    ``segment_rows`` is the size of a hot key's segments (``SEGMENT_ROWS``).
    """
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}")
    built_at = built_at or now_iso()
    prepared, ords = _prepare(df, spec, built_at)
    if form == "split" and spec.split <= 0:
        form = "range"
    if form == "auto":
        body = _auto(prepared, spec, ords, hot_rows, segment_rows or SEGMENT_ROWS)
    elif form == "range":
        n = int(prepared.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        body = _range(prepared, spec, ords, n, 1)  # a segment for each shuffle partition
    else:
        body = {"definition": _definition, "fast": _fast, "lead": _lead,
                "split": _split}[form](prepared, spec, ords)
    return _finish(body, spec)


# ------------------------------------------------------------ event log form
_STR_PAYLOAD = [c for c in schemas.PAYLOAD_COLUMNS if c not in ("amount", "pending")]


def _astype_str(c: str) -> Column:
    """Key and type columns as text; a null becomes the text 'None'."""
    return F.coalesce(F.col(c).cast("string"), F.lit("None"))


def silver_from_bronze(bronze: DataFrame, built_at: str | None = None,
                       form: str = "auto", hot_rows: int = HOT_ROWS,
                       segment_rows: int | None = None) -> DataFrame:
    """Silver table (schema ``SILVER``) from the Bronze event log."""
    built_at = built_at or now_iso()
    schemas.require_columns(bronze, {"item_id", "transaction_id", "event_type",
                                     "run_ts", "event_id"})
    b = schemas.conform(bronze, schemas.BRONZE) if set(bronze.columns) != set(
        schemas.BRONZE.fieldNames()) else bronze
    # Only the columns Silver needs: raw JSON and cursors are never read.
    need = (["plaid_env", "institution", "item_id", "transaction_id", "event_type",
             "event_id", "run_id", "run_ts", "page_path", "ingested_at", "page_name",
             "type_ord", "pos"] + schemas.PAYLOAD_COLUMNS)
    b = b.select(*need)
    b = (b.withColumn("item_id", _astype_str("item_id"))
         .withColumn("transaction_id", _astype_str("transaction_id"))
         .withColumn("event_id", _astype_str("event_id"))
         .withColumn("event_type", _astype_str("event_type")))
    return silver_rows(build_scd2(b, BRONZE_SPEC, built_at, form, hot_rows, segment_rows), built_at)


def silver_rows(h: DataFrame, built_at: str) -> DataFrame:
    """Versions of events with their payload, in the columns of Silver;
    tombstones carry no payload."""
    tomb = F.col("is_deleted")
    payload = [F.when(~tomb, S.safe_str(c)).alias(c) for c in _STR_PAYLOAD]
    amount = F.when(~tomb, F.nanvl(F.col("amount"), F.lit(None).cast("double")))
    pending = F.when(~tomb, F.col("pending"))
    h = h.withColumn("__d", S.iso_date(F.when(~tomb, S.safe_str("date"))))
    year, month = F.year("__d").cast("bigint"), F.month("__d").cast("bigint")
    out = h.select(
        S.safe_str("plaid_env").alias("plaid_env"),
        S.safe_str("institution").alias("institution"),
        F.col("item_id"), F.col("transaction_id"),
        *payload, amount.alias("amount"), pending.alias("pending"),
        "valid_from_ts", "valid_to_ts", "is_current", "is_active", "is_deleted",
        "change_type", "version",
        S.safe_str("event_id").alias("source_event_id"),
        F.col("event_type").alias("source_event_type"),
        S.safe_str("run_id").alias("source_run_id"),
        S.safe_str("run_ts").alias("source_run_ts"),
        S.safe_str("page_path").alias("source_page_path"),
        F.lit(built_at).alias("silver_built_at"),
        year.alias("txn_year"), month.alias("txn_month"),
    )
    return schemas.conform(out, schemas.SILVER)


def collapse_unchanged(bronze: DataFrame, tracked=None, segment_rows: int | None = None) -> DataFrame:
    """Events without those that change nothing: an event of a known type
    whose row would equal, in the ``tracked`` payload columns (all by default)
    and in being a tombstone or not, the one of the key's event before it.
    An event of an unknown type closes a version, so what follows it stays.
    History built from the rest has one version for each run of equal rows.

    Gaps and islands over a hash of the payload: the hash before each event is
    carried over the borders of range segments, so a hot key is cut as well.
    """
    tracked = list(schemas.PAYLOAD_COLUMNS if tracked is None else tracked)
    own, built = bronze.columns, [o.expr for o in BRONZE_SPEC.order]
    bronze = bronze.withColumns({f.name: F.lit(None).cast(f.dataType) for f in schemas.BRONZE.fields
                                 if f.name not in own})
    kind = S.normalize_type("event_type")
    tomb = kind.isin(list(BRONZE_SPEC.delete_types))
    cells = [F.coalesce(S.safe_str(c) if c in _STR_PAYLOAD else F.col(c).cast("string"), F.lit("\x00"))
             for c in tracked]
    state = (F.when(tomb, F.lit("removed")).when(
        kind.isin(list(BRONZE_SPEC.upsert_types)), F.sha2(F.concat_ws("\x1f", *cells), 256)).otherwise(F.lit("?")))
    keyed = bronze.withColumns({"event_type": _astype_str("event_type"), "__k0": _astype_str("item_id"),
                                "__k1": _astype_str("transaction_id")})
    rows = segments.previous(keyed.withColumn("__state", state), ["__k0", "__k1"],
                             [F.expr(e) for e in built], F.col("__state"), "__before",
                             segment_rows or SEGMENT_ROWS)
    stays = (F.col("__state") == "?") | ~F.col("__state").eqNullSafe(F.col("__before"))
    return rows.where(stays).select(*own)


# --------------------------------------------------------------- table I/O
def write_silver(df: DataFrame, path: str, buckets: int | None = None) -> str:
    """Silver as Parquet in the key layout (``sources.layout``), each bucket
    replaced as a whole (dynamic partition overwrite) and sorted by the year of
    the transactions.  Keys never leave Bronze, so no bucket is left over.
    ``df`` may not read the table itself; see ``refresh_buckets``.  Readers may
    see the swap of a bucket folder while the job commits."""
    spark = df.sparkSession
    n = layout.number(spark, path, buckets)
    w = layout.dealt(df, n).sortWithinPartitions(layout.column(n), "txn_year").write.mode("overwrite")
    if _complete(spark, path):
        w = w.option("partitionOverwriteMode", "dynamic")
    w.partitionBy(layout.column(n)).parquet(path)
    return path


def _complete(spark, path: str) -> bool:
    """Whether a first write has ended: Spark's own mark of it is there."""
    return tables.path_exists(spark, f"{path.rstrip('/')}/_SUCCESS")


def read_silver(spark, path: str, where: Column | None = None) -> DataFrame:
    """Stored Silver; one whose first write did not end is no table."""
    if not _complete(spark, path):
        raise tables.TableNotFound(f"no complete table at: {path}")
    return tables.read_table(spark, path, schemas.SILVER, where=where)


def _keyed(df: DataFrame) -> DataFrame:
    return (df.withColumn("item_id", _astype_str("item_id"))
            .withColumn("transaction_id", _astype_str("transaction_id")))


def refresh_scd2(old_silver: DataFrame | None, bronze: DataFrame, changed: DataFrame,
                 built_at: str | None = None, form: str = "auto") -> DataFrame:
    """Silver after new events: keys touched by ``changed`` (any frame with
    item_id, transaction_id) are rebuilt from their whole Bronze history (a
    late event re-numbers later versions); other keys keep their rows.
    Equal to a full rebuild up to ``silver_built_at`` of untouched keys."""
    keys = ["item_id", "transaction_id"]
    ck = _keyed(changed.select(*keys)).distinct()
    rebuilt = silver_from_bronze(_keyed(bronze).join(ck, keys, "left_semi"), built_at, form)
    if old_silver is None:
        return rebuilt
    kept = old_silver.join(ck, keys, "left_anti")
    return kept.unionByName(rebuilt)


def refresh_buckets(spark, bronze: DataFrame | str, changed: DataFrame, path: str,
                    built_at: str | None = None, buckets: int | None = None,
                    form: str = "auto") -> int:
    """Refresh a stored Silver in place for the keys of ``changed``.

    Only the buckets that hold such keys are read, of Silver and, given the
    path of a Bronze in the same layout, of Bronze as well (partition filters
    on both scans), and only they are rewritten (dynamic partition overwrite).
    The touched bucket numbers are at most that many ints.  The new rows are
    staged as Parquet in the shared folder first, since a job may not overwrite
    files it reads, and the stage is removed.  Returns the number of buckets
    rewritten."""
    from lakeledger.operators.bronze import read_bronze
    from lakeledger.session import checkpoint_dir
    if not _complete(spark, path):
        raise tables.TableNotFound(f"no complete table at: {path}")
    n = layout.number(spark, path, buckets)
    keys = ["item_id", "transaction_id"]
    ck = _keyed(changed.select(*keys)).distinct()
    touched = layout.touched(ck, n)
    if not touched:
        return 0
    here = layout.in_buckets(n, touched)
    if isinstance(bronze, str):
        same = layout.stored(spark, bronze) == n
        bronze = read_bronze(spark, bronze, here if same else None)
    old, bronze = (spread(t, t.count(), keys) for t in (read_silver(spark, path, here), _keyed(bronze)))
    old = old.join(ck, keys, "left_anti")
    rebuilt = silver_from_bronze(bronze.join(ck, keys, "left_semi"), built_at, form)
    stage = f"{checkpoint_dir(spark).rstrip('/')}/refresh-{uuid.uuid4().hex}"
    old.unionByName(rebuilt).write.parquet(stage)
    write_silver(spark.read.schema(schemas.SILVER).parquet(stage), path, n)
    tables.remove(spark, stage)
    return len(touched)
