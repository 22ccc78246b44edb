"""Bronze: the append-only event log built from sync pages.

Batch ingest reads the page set once, keeps pages not yet processed, turns
each page into rows with a single ``explode`` (no per-page loop), appends one
partitioned batch and then records the pages in the ledger.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeledger import schemas
from lakeledger.functions import scalars as S
from lakeledger.operators import jsonschema
from lakeledger.operators.silver import now_iso
from lakeledger.session import checkpoint_dir
from lakeledger.sources import layout as L
from lakeledger.sources import pages as P
from lakeledger.sources import tables as T

# Event types of a page and their order inside one page.
EVENT_ARRAYS = [("added", 0), ("modified", 1), ("removed", 2)]


def bad_run_ts(c="run_ts") -> Column:
    """Whether a page's run time is given but cannot be read as a time."""
    t = F.nullif(F.col(c), F.lit(""))
    return t.isNotNull() & S.parse_iso(t).isNull()


def page_header(pages: DataFrame, now, default_env: str = "sandbox") -> list[Column]:
    """Header columns shared by all events of a page.  ``now`` (text or a
    column) is the run time of pages without one; a run time that cannot be
    read fails the job."""
    now = now if isinstance(now, Column) else F.lit(now)
    refuse = F.raise_error(F.concat(F.lit("unreadable run_ts in page "), F.coalesce("page_path", F.lit("?")),
                                    F.lit(": "), F.col("run_ts"))).cast("string")
    run_ts = F.when(bad_run_ts(), refuse).otherwise(F.coalesce(F.nullif(F.col("run_ts"), F.lit("")), now))
    # The run's own calendar day (as written, whatever its offset).
    day = S.iso_date(run_ts)
    return [
        S.coalesce_blank(F.col("plaid_env"), F.lit(default_env)).alias("plaid_env"),
        F.col("run_id"),
        run_ts.alias("run_ts"),
        F.date_format(day, "yyyy-MM-dd").alias("event_date"),
        F.year(day).cast("bigint").alias("event_year"),
        F.month(day).cast("bigint").alias("event_month"),
        F.col("mode"), F.col("institution"), F.col("item_id"),
        F.col("cursor_in"), F.col("cursor_out"),
        F.coalesce(F.col("has_more"), F.lit(False)).alias("has_more"),
        F.col("page_path"), F.col("page_name"),
    ]


def _elements(pages: DataFrame) -> Column:
    """All elements of a page as one array of (event_type, type_ord, pos, j,
    id, tx): ``j`` is the element's JSON text, ``tx`` its parse (objects
    only).  Parsing inside the array, before the explode, makes every
    element's JSON parsed exactly once.  ``removed`` is an array of variants,
    or of ids for pages that are not read from JSON."""
    typed = "variant" in pages.schema["removed"].dataType.simpleString()

    def tag(name: str, ord_: int):
        def element(x, i):
            if name != "removed":
                j, id_ = x, F.lit(None).cast("string")
            elif typed:
                j, id_ = F.lit(None).cast("string"), S.variant_id(x)
            else:
                j, id_ = F.lit(None).cast("string"), S.json_id(x)
            tx = F.from_json(F.when(S.is_json_object(j), j), schemas.TX)
            return F.struct(F.lit(name).alias("event_type"), F.lit(ord_).alias("type_ord"),
                            i.cast("bigint").alias("pos"), j.alias("j"), id_.alias("id"), tx.alias("tx"))
        return element

    parts = [F.transform(F.coalesce(F.col(n), F.array().cast(pages.schema[n].dataType)), tag(n, o))
             for n, o in EVENT_ARRAYS]
    return F.concat(*parts)


def explode_pages(pages: DataFrame, now=None, default_env: str = "sandbox") -> DataFrame:
    """Pages -> Bronze rows (schema ``BRONZE``): added, modified, removed in
    that order, skipping non-objects in added/modified and elements without
    an id.  Removed rows carry no payload and no raw JSON.  ``now`` is a text
    or a column."""
    return exploder(pages, now, default_env)(pages)


def exploder(pages: DataFrame, now=None, default_env: str = "sandbox") -> Callable[[DataFrame], DataFrame]:
    """``explode_pages`` for all pages of the same columns as ``pages``.  Its
    expressions are built here, once, and not for each batch."""
    now = now_iso() if now is None else now
    j, tx = F.col("e.j"), F.col("e.tx")
    removed = F.col("e.event_type") == "removed"
    # removed: an object's id or a string; added/modified: objects only
    tx_id = F.when(removed, F.col("e.id")).otherwise(tx["transaction_id"])
    payload = {
        "account_id": tx["account_id"], "amount": tx["amount"].try_cast("double"),
        "iso_currency_code": tx["iso_currency_code"], "date": tx["date"],
        "authorized_date": tx["authorized_date"], "name": tx["name"],
        "merchant_name": tx["merchant_name"],
        "pending": S.normalize_bool(tx["pending"]),
        "payment_channel": tx["payment_channel"],
        "pfc_primary": tx["personal_finance_category"]["primary"],
        "pfc_detailed": tx["personal_finance_category"]["detailed"],
        "pfc_confidence": tx["personal_finance_category"]["confidence_level"],
        "city": tx["location"]["city"], "region": tx["location"]["region"],
        "country": tx["location"]["country"],
    }
    elements = [*page_header(pages, now, default_env), F.explode(_elements(pages)).alias("e")]
    with_id = [F.col("*"), tx_id.alias("transaction_id")]
    has_id = F.col("transaction_id").isNotNull() & (F.col("transaction_id") != "")
    header = [c for c in pages.select(*elements).columns if c != "e"]
    columns = [
        *header, "transaction_id",
        F.col("e.event_type").alias("event_type"),
        S.event_id("item_id", "run_id", "page_path", F.col("e.event_type"),
                   "transaction_id").alias("event_id"),
        *[F.when(~removed, v).alias(k) for k, v in payload.items()],
        F.when(~removed, j).alias("raw_transaction_json"),
        (now if isinstance(now, Column) else F.lit(now)).alias("ingested_at"),
        F.col("e.type_ord").alias("type_ord"),
        F.col("e.pos").alias("pos"),
    ]

    def explode(some: DataFrame) -> DataFrame:
        ev = some.select(*elements).select(*with_id).filter(has_id)
        return schemas.conform(ev.select(*columns), schemas.BRONZE)

    return explode


def raw_payload_failures(pages: DataFrame) -> DataFrame:
    """Per page: elements whose amount or pending text did not cast."""
    ev = pages.select("page_path", F.explode(_elements(pages)).alias("e"))
    tx = F.col("e.tx")
    bad_amount = tx["amount"].isNotNull() & tx["amount"].try_cast("double").isNull()
    bad_pending = tx["pending"].isNotNull() & S.normalize_bool(tx["pending"]).isNull()
    return ev.groupBy("page_path").agg(
        F.count_if(bad_amount).alias("bad_amount"),
        F.count_if(bad_pending).alias("bad_pending"))


def _ledger(spark: SparkSession, ledger_path: str) -> DataFrame:
    return P.read_jsonl_log(spark, ledger_path, schemas.LEDGER)


def processed_pages(spark: SparkSession, ledger_path: str) -> DataFrame:
    """Page paths already processed.  What a lost run appended without its
    ledger lines is not among them: the next run replaces that batch."""
    return _ledger(spark, ledger_path).where("page_path != ''").select("page_path")


def next_batch(spark: SparkSession, ledger_path: str) -> int:
    """The number of the next batch: one more than the last in the ledger.  A
    run that was lost before its ledger lines is followed by one with the same
    number."""
    return (_ledger(spark, ledger_path).agg(F.max("batch")).first()[0] or 0) + 1


def new_pages(pages: DataFrame, processed: DataFrame) -> DataFrame:
    """Pages whose path is not yet processed (anti join; AQE broadcasts the
    processed set only when its measured size is under the threshold)."""
    return pages.join(processed.select("page_path"), "page_path", "left_anti")


def append_bronze(df: DataFrame, path: str, batch: int, buckets: int | None = None,
                  counted: Observation | None = None) -> None:
    """One batch in a folder of its own, in the key layout that Silver shares
    and by event year below it.  A repetition replaces the folder, so a batch
    whose writer was lost does not count twice, and nothing else is read.
    ``counted`` gets the number of ``rows``."""
    _append(df, path, batch, L.number(df.sparkSession, path, buckets), counted)


def _append(df: DataFrame, path: str, batch: int, n: int, counted: Observation | None) -> None:
    """``append_bronze`` to a table that has, or gets, ``n`` buckets."""
    df = L.dealt(df, n)
    if counted is not None:
        df = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    (df.write.mode("overwrite").partitionBy(L.column(n), "event_year")
     .parquet(f"{path.rstrip('/')}/batch_id={int(batch)}"))


def mark_pages(pages: DataFrame, ledger_path: str, now: str | None = None, batch: int = 0) -> None:
    """Append ledger records (ts, run_id, page_path, batch) for the given pages."""
    now = now or now_iso()
    (pages.select(F.lit(now).alias("ts"),
                  F.coalesce("run_id", F.lit("unknown")).alias("run_id"), "page_path",
                  F.lit(int(batch)).cast("bigint").alias("batch"))
     .write.mode("append").json(ledger_path))


def _mark_files(files: DataFrame, ledger_path: str, now: str) -> None:
    """Files of JSON lines that are read to the end and need not be opened again."""
    files.select(F.lit(now).alias("ts"), F.col("path").alias("source")).write.mode("append").json(ledger_path)


def read_bronze(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Bronze with the declared columns (also those that only later files
    have), or its rows ``where``, such as those of some key buckets.  ``ingested_at`` is the run time where the table has no such
    column; a null stays null and sorts first."""
    try:
        found = T.read_table(spark, path)
    except AnalysisException as e:
        if "UNABLE_TO_INFER_SCHEMA" not in str(e):
            raise
        return spark.createDataFrame([], schemas.BRONZE)  # only empty batches so far
    schemas.require_columns(found, {"item_id", "transaction_id", "event_type",
                                    "run_ts", "event_id"})
    df = T.read_table(spark, path, schemas.BRONZE, int_partitions=("event_year",), where=where)
    if "ingested_at" not in found.columns:
        df = df.withColumn("ingested_at", F.col("run_ts"))
    return schemas.conform(df, schemas.BRONZE)


def _quarantine(spark: SparkSession, bad: DataFrame, path: str, now: str) -> int:
    """Records malformed pages once; returns how many are new."""
    seen = P.read_jsonl_log(spark, path, schemas.QUARANTINE, required="page_path").select("page_path")
    q = (bad.select(F.lit(now).alias("ts"), "page_path", F.col("run_id"), F.col(P.CORRUPT).alias("content"))
         .join(seen, "page_path", "left_anti"))
    checkpoint_dir(spark)
    q = q.checkpoint(eager=True)
    n = q.count()
    if n:
        q.select(*schemas.QUARANTINE.fieldNames()).write.mode("append").json(path)
    return n


def _in_batches(new: DataFrame, most: int) -> Iterator[tuple[DataFrame, int]]:
    """The pinned listing ``new`` in the order of paths, in parts of ``most``
    files, with the bytes that a part is known to hold.  Parts lie in the
    checkpoint folder, so a batch reads its own part only."""
    size = F.sum("size") if "size" in new.columns else F.lit(0)
    n, total = new.agg(F.count(F.lit(1)), size).first()
    if n <= most:
        if n:
            yield new, total
        return
    spark = new.sparkSession
    ranges = max(-(-n // most), 4 * spark.sparkContext.defaultParallelism)
    at = (new.repartitionByRange(ranges, "path").sortWithinPartitions("path")
          .select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("id")).checkpoint(eager=True))
    # A row's number: those in the ranges before its own, and before it in its own.
    before, rows = {}, 0
    for r in at.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).orderBy("part").collect():
        before[r.part], rows = rows - r.id, rows + r.n
    number = F.element_at(F.create_map(*[F.lit(x) for kv in before.items() for x in kv]), F.col("part")) + F.col("id")
    at = at.select(*new.columns, F.floor(number / most).cast("int").alias("batch"))
    home = f"{checkpoint_dir(spark).rstrip('/')}/listing-{uuid.uuid4().hex}"
    at.write.partitionBy("batch").parquet(home)
    sizes = {r.batch: r.bytes for r in at.groupBy("batch").agg(size.alias("bytes")).collect()}
    for batch in sorted(sizes):
        yield spark.read.schema(new.schema).parquet(f"{home}/batch={batch}"), sizes[batch]
    T.remove(spark, home)


def ingest(spark: SparkSession, root: str, bronze_path: str, ledger_path: str,
           now: str | None = None, prefix: str = "", default_env: str = "sandbox",
           mode: str = "FAILFAST", quarantine_path: str | None = None,
           layout: str = "files", institution: str | None = None,
           item_id: str | None = None, files_per_batch: int = 20_000,
           element_schema: dict | None = None) -> dict:
    """New pages below ``root`` -> Bronze append -> ledger.

    Only paths are listed to find new files, and only new files are opened,
    at most ``files_per_batch`` in one batch; ``institution`` and ``item_id``
    narrow the listing to a folder (``files`` layout) or the pages.  With the
    ``lines`` layout the ledger also keeps which files were read to the end;
    a file is not written to after it landed.

    Idempotent: a second run over the same pages adds nothing.  A batch has a
    folder and a number; after a crash between the append and the ledger write
    the next run takes the same number and replaces the folder, and no table is
    read for that.  Pages without events are marked all the same.  A malformed
    page, or one whose run time cannot be read, fails the batch (``FAILFAST``);
    with ``mode="PERMISSIVE"``, which needs a ``quarantine_path``, it is
    recorded there once, left out and not marked, so a repaired file is taken
    next time.  With an ``element_schema`` (JSON Schema, see ``jsonschema``) pages
    with elements that break it are malformed too, and their violations are what
    is recorded.  Returns counts.
    """
    kind, permissive = layout, mode.upper() == "PERMISSIVE"
    if permissive and not quarantine_path:
        raise ValueError("PERMISSIVE needs a quarantine_path: malformed pages may not get lost")
    if element_schema is not None and not permissive:
        raise ValueError("an element_schema needs PERMISSIVE and a quarantine_path")
    if kind not in ("files", "lines"):
        raise ValueError("layout must be 'files' or 'lines'")
    now = now or now_iso()
    checkpoint_dir(spark)
    ledger = _ledger(spark, ledger_path).checkpoint(eager=True)
    done = ledger.where("page_path != ''").select("page_path")
    number = (ledger.agg(F.max("batch")).first()[0] or 0) + 1
    out = {"pages": 0, "rows": 0} | ({"quarantined": 0} if quarantine_path else {})
    if kind == "files":
        new = new_pages(P.list_pages(spark, root, prefix, institution, item_id), done).select("path", "mark", "size")
    else:
        read = ledger.where("source != ''").select(F.col("source").alias("path"))
        new = P.list_lines(spark, root).join(read, "path", "left_anti").select("path")
    scope = P.scope_of(root, institution, item_id)
    in_tasks, scan = kind == "files" and P.in_tasks(spark, scope), None
    few = 4 * spark.sparkContext.defaultParallelism
    explode = buckets = None
    for some, size in _in_batches(new.checkpoint(eager=True), files_per_batch):
        if in_tasks:
            pages = P.read_pages(spark, root, prefix, mode, scan=some.repartition(max(few, size >> 27), "path"))
        elif kind == "files":
            scan = P.scan_pages(spark, scope, mode) if scan is None else scan
            pages = P.in_few_tasks(P.read_pages(spark, root, prefix, mode, marks=[r.mark for r in some.collect()], scan=scan), size)
        else:
            files = [r.path for r in some.collect()]
            pages = P.read_pages(spark, root, prefix, mode, institution, item_id, kind, files)
        bad = None
        if permissive:
            broken = F.col(P.CORRUPT).isNotNull() | bad_run_ts()
            bad = pages.filter(broken).withColumn(P.CORRUPT, F.coalesce(
                P.CORRUPT, F.concat(F.lit("unreadable run_ts: "), "run_ts")))
            out["quarantined"] += _quarantine(spark, bad, quarantine_path, now)
            pages = pages.filter(~F.coalesce(broken, F.lit(False))).drop(P.CORRUPT)
            if element_schema is not None:
                pages, invalid = jsonschema.valid_pages(pages, element_schema)
                invalid = invalid.withColumn(P.CORRUPT, F.to_json("violations")).drop("violations")
                out["quarantined"] += _quarantine(spark, invalid, quarantine_path, now)
                bad = bad.unionByName(invalid)
        # The pages of this batch, pinned in the shared folder: rows and
        # ledger cover the same pages.  A path that tasks listed is one file's
        # and not in the ledger.
        chosen = pages if in_tasks else new_pages(pages, done)
        if kind == "files":  # small files are opened once, and their pages pinned
            chosen = chosen.checkpoint(eager=True)
        pinned = chosen.select("page_path", "run_id").groupBy("page_path").agg(
            F.max("run_id").alias("run_id"), F.count(F.lit(1)).alias("copies"))
        if not in_tasks:
            pinned = pinned.checkpoint(eager=True)
        n, most = pinned.agg(F.count(F.lit(1)), F.max("copies")).first()
        if n:
            obs = Observation()
            if kind == "lines":
                chosen = pages.join(pinned.select("page_path"), "page_path", "left_semi")
            if most > 1:  # a page that landed again in this batch
                chosen = one_of_each_path(chosen)
            explode = explode or exploder(chosen, now, default_env)
            buckets = buckets or L.number(spark, bronze_path)
            _append(explode(chosen), bronze_path, number, buckets, obs)
            mark_pages(pinned, ledger_path, now, number)
            if not in_tasks:
                done = done.unionByName(pinned.select("page_path"))
            number += 1
            out["pages"] += n
            out["rows"] += obs.get.get("rows", 0)
        if kind == "lines" and institution is None and item_id is None:
            whole = spark.createDataFrame([(f,) for f in files], "path string")
            if bad is not None:
                whole = whole.join(bad.select(F.col("source").alias("path")), "path", "left_anti")
            _mark_files(whole, ledger_path, now)
    return out


def one_of_each_path(pages: DataFrame) -> DataFrame:
    """One page for each page_path: of the same page landed several times in
    one batch, one copy (they are equal but for the file they stand in)."""
    return pages.dropDuplicates(["page_path"])
