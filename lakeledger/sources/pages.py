"""Page files and JSON-lines logs.

Page files are many and small.  On a file system that the machines mount
(``file:``) tasks list their folders and open them, so neither their number nor
their paths pass through the driver.  On others, globs included, Spark's own
readers do, whose file index is on the driver.
"""

from __future__ import annotations

import fnmatch
import re
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType
from pyspark.errors import AnalysisException

from lakeledger import schemas
from lakeledger.functions import scalars as S

PAGE_GLOB = "page_*.json"
CORRUPT = "_corrupt_record"
#: Entries of folders after which a task that looks for folders leaves the rest to others.
ENTRIES = 20_000


def _qualified(spark: SparkSession, path: str):
    """``path`` as the file system that serves it names it (a path without a
    scheme goes to the session's default file system)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p)


def root_uri(spark: SparkSession, root: str) -> str:
    """The form ``_metadata.file_path`` gives for files under ``root``."""
    return re.sub("^file:/+", "file:/", _qualified(spark, root).toUri().toString().rstrip("/"))


# A page set stored as JSON lines carries its own name and path.
PAGE_LINE = StructType(schemas.PAGE.fields + [StructField("page_name", StringType()),
                                              StructField("page_path", StringType())])


def in_few_tasks(files: DataFrame, size: int = 0) -> DataFrame:
    """``files`` read by a few tasks a core, and by more where they hold
    ``size`` bytes that ask for it.  A scan of small files has a task for each
    32 of them, which costs more than its files, also as a part of a
    checkpoint or a shuffle."""
    few = 4 * files.sparkSession.sparkContext.defaultParallelism
    return files.coalesce(max(few, size >> 27))


def _escaped(path: str) -> str:
    """A file's path as a pattern that means that file."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def _with_corrupt(schema: StructType, mode: str) -> StructType:
    if mode.upper() == "PERMISSIVE":
        return StructType(schema.fields + [StructField(CORRUPT, StringType())])
    return schema


def list_lines(spark: SparkSession, root: str) -> DataFrame:
    """(path) of the files of JSON lines below ``root``; none is opened."""
    from lakeledger.sources.tables import path_exists
    if not path_exists(spark, root):
        return spark.createDataFrame([], "path string")
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.json")
             .option("recursiveFileLookup", True).load(root))
    return in_few_tasks(files).select(F.regexp_replace("path", "^file:/+", "file:/").alias("path"))


def read_page_lines(spark: SparkSession, root: str, mode: str = "FAILFAST",
                    files: list[str] | None = None) -> DataFrame:
    """Pages stored as JSON lines (one page per line, with page_name and
    page_path fields), e.g. as a landing zone written by another job, below
    ``root`` or in the given ``files``; ``source`` is the file.  With
    ``mode="PERMISSIVE"`` a malformed line is a row whose ``_corrupt_record``
    holds its text and whose page_path names the file and the text's hash."""
    df = (spark.read.schema(_with_corrupt(PAGE_LINE, mode)).option("mode", mode)
          .option("columnNameOfCorruptRecord", CORRUPT)
          .option("pathGlobFilter", "*.json").option("recursiveFileLookup", True)
          .json(root if files is None else [_escaped(f) for f in files]))
    df = df.withColumn("source", F.url_decode(F.replace(F.regexp_replace(
        "_metadata.file_path", "^file:/+", "file:/"), F.lit("+"), F.lit("%2B"))))
    if CORRUPT in df.columns:
        bad = F.concat(F.col("_metadata.file_name"), F.lit("#"), F.sha2(F.col(CORRUPT), 256))
        df = df.withColumn("page_path", F.when(F.col(CORRUPT).isNotNull(), F.coalesce("page_path", bad))
                           .otherwise(F.col("page_path")))
    return df


def scope_of(root: str, institution: str | None, item_id: str | None) -> str:
    """The folder of one institution, or one item, below the landing root."""
    parts = [root.rstrip("/")]
    if institution is not None:
        parts.append(slug(institution))
        if item_id is not None:
            parts.append(item_id)
    return "/".join(parts)


def slug(text: str) -> str:
    """``scalars.slugify`` for one value."""
    s = re.sub(r"\s+", "_", text.strip().lower())
    return re.sub(r"[^a-z0-9_\-]", "", s) or "unknown"


def _mark() -> Column:
    return F.xxhash64("_metadata.file_path")


def in_tasks(spark: SparkSession, folder: str) -> bool:
    """Whether ``folder`` is one that Python tasks can list and read themselves."""
    p = _qualified(spark, folder)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return p.toUri().getScheme() == "file" and fs.exists(p) and fs.getFileStatus(p).isDirectory()


def _folders(spark: SparkSession, folder: str) -> DataFrame:
    """(path) of ``folder`` and all folders below it that Spark's readers would
    look into.  A task that has seen ``ENTRIES`` leaves the folders it found to
    the tasks of the next round."""
    from lakeledger.session import checkpoint_dir
    from lakeledger.sources.tables import path_exists
    kept, most = f"{checkpoint_dir(spark).rstrip('/')}/folders-{uuid.uuid4().hex}", ENTRIES
    few = 4 * spark.sparkContext.defaultParallelism

    def below(batches):
        import os
        import pyarrow as pa
        for b in batches:
            todo, seen, seen_in = b.column(0).to_pylist(), 0, []
            while todo and (seen < most or not seen_in):
                at = todo.pop()
                seen_in.append(at)
                try:
                    with os.scandir(at) as entries:
                        for e in entries:
                            seen += 1
                            hidden = e.name.startswith(".") or e.name.startswith("_") and "=" not in e.name
                            if not hidden and not e.name.endswith("._COPYING_") and e.is_dir():
                                todo.append(e.path)
                except FileNotFoundError:  # gone since it was found, as for Spark
                    pass
            yield pa.RecordBatch.from_pydict({"path": pa.array(seen_in + todo, pa.string()),
                                              "open": pa.array([False] * len(seen_in) + [True] * len(todo))})

    found, done = spark.createDataFrame([(_qualified(spark, folder).toUri().getPath(),)], "path string"), []
    while True:
        at = f"{kept}/{len(done)}"
        found.mapInArrow(below, "path string, open boolean").write.partitionBy("open").parquet(at)
        done.append(f"{at}/open=false")
        if not path_exists(spark, f"{at}/open=true"):
            return spark.read.schema("path string").parquet(*done)
        found = spark.read.schema("path string").parquet(f"{at}/open=true").repartition(few, "path")
        most *= 2


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, size) of the page files below ``folder``, in a few tasks a core."""
    name = fnmatch.translate(PAGE_GLOB)

    def inside(batches):
        import os
        import re
        import pyarrow as pa
        fits = re.compile(name).match

        def rows(found):
            paths, sizes = zip(*found) if found else ((), ())
            return pa.RecordBatch.from_pydict({"path": pa.array(paths, pa.string()), "size": pa.array(sizes, pa.int64())})

        for b in batches:
            found = []
            for at in b.column(0).to_pylist():
                try:
                    with os.scandir(at) as entries:
                        for e in entries:
                            if fits(e.name) and e.is_file():
                                found.append((f"file:{e.path}", e.stat().st_size))
                            if len(found) == 10_000:
                                yield rows(found)
                                found = []
                except FileNotFoundError:
                    pass
            yield rows(found)

    few = 4 * spark.sparkContext.defaultParallelism
    return _folders(spark, folder).repartition(few, "path").mapInArrow(inside, "path string, size long")


def scan_pages(spark: SparkSession, folder: str, mode: str = "FAILFAST") -> DataFrame:
    """The page files below ``folder``, listed now and opened where ``read_pages``
    reads them: their listing, or the pages as Spark's reader gives them."""
    if in_tasks(spark, folder):
        listed = list_pages(spark, folder).select("path", "mark", "size").checkpoint(eager=True)
        n, size = listed.agg(F.count(F.lit(1)), F.sum("size")).first()
        few = 4 * spark.sparkContext.defaultParallelism
        return listed.repartition(max(1, min(-(-n // 32), 16 * few), (size or 0) >> 27), "path")
    return (spark.read.schema(_with_corrupt(schemas.PAGE, mode))
            .option("multiLine", True)
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("pathGlobFilter", PAGE_GLOB)
            .option("recursiveFileLookup", True)
            .option("mode", mode)
            .json(folder))


def open_files(files: DataFrame, mode: str = "FAILFAST") -> DataFrame:
    """The pages in ``files`` (path), their path and page_name (the file's name in
    a URI, as ``_metadata.file_name``), as Spark's reader of JSON files gives them: one for an object, one for each element of an array, none
    for an empty file.  With ``mode="PERMISSIVE"`` ``_corrupt_record`` holds the
    text of a file that is malformed or has a value of another type.

    What is no text where the page has texts, such as an element, is kept as it
    is written.  ``from_json`` would write it anew, so tasks make it a text
    before; files that are no strict JSON (single quotes) are left to it."""
    of_type = {f.name: f.dataType.simpleString() for f in schemas.PAGE.fields}

    def texts(batches):
        import json
        import re
        import unicodedata
        import pyarrow as pa
        from urllib.parse import quote
        blank, decode = re.compile(r"[ \t\n\r]*").match, json.JSONDecoder(parse_float=str, parse_int=str).scan_once
        plain = re.compile(r"[\w.!~'()*,;:$&+=@-]*", re.ASCII).fullmatch

        def after(text, i):
            return blank(text, i).end() if text[i] in " \t\n\r" else i

        def following(text, i, close):
            """Where the next member begins, or ``close`` stands."""
            i = after(text, i)
            if text[i] == ",":
                i = after(text, i + 1)
                if text[i] != close:
                    return i
            elif text[i] == close:
                return i
            raise ValueError("no JSON")

        def value(text, i, found):
            """The end of a value, which is ``found`` if it is no text."""
            what, end = decode(text, i)
            if text[i] != '"' and what is not None:
                found.append((i, end))
            return end

        def page(text, i, found):
            if text[i] != "{":
                return decode(text, i)[1]
            i = after(text, i + 1)
            while text[i] != "}":
                if text[i] != '"':
                    raise ValueError("no JSON")
                name, i = decode(text, i)
                i = after(text, i)
                if text[i] != ":":
                    raise ValueError("no JSON")
                i, kind = after(text, i + 1), of_type.get(name)
                if kind == "string":
                    i = value(text, i, found)
                elif kind == "array<string>" and text[i] == "[":
                    i = after(text, i + 1)
                    while text[i] != "]":
                        i = following(text, value(text, i, found), "]")
                    i += 1
                else:
                    i = decode(text, i)[1]
                i = following(text, i, "}")
            return i + 1

        def as_written(text):
            """``text`` with texts in the place of other values."""
            found, parts, last = [], [], 0
            try:
                i = blank(text, 0).end()
                if text[i] == "[":
                    i = after(text, i + 1)
                    while text[i] != "]":
                        i = following(text, page(text, i, found), "]")
                else:
                    page(text, i, found)
            except (ValueError, IndexError, StopIteration, RecursionError):
                return text
            for i, end in found:
                parts += text[last:i], json.dumps(text[i:end], ensure_ascii=False)
                last = end
            return "".join((*parts, text[last:]))

        def in_uri(path):
            name = path.rsplit("/", 1)[-1]
            return name if plain(name) else "".join(c if c > "\x7f" and unicodedata.category(c) not in ("Cc", "Zs", "Zl", "Zp") else
                                                    quote(c, safe="!~'()*,;:$&+=@") for c in name)

        def rows(paths, read, valid):
            return pa.RecordBatch.from_pydict({"path": paths, "page_name": [in_uri(p) for p in paths], "text": read, "written": [
                as_written(text) if ok else "{" for text, ok in zip(read, valid)]})

        for b in batches:
            paths, read, valid, size = [], [], [], 0
            for p in b.column(0).to_pylist():
                with open(p.removeprefix("file:"), "rb") as f:
                    data = f.read()
                try:
                    text, ok = data.decode(json.detect_encoding(data)), True
                except UnicodeDecodeError:
                    text, ok = data.decode(errors="replace"), False
                paths.append(p)
                read.append(text)
                valid.append(ok)
                size += len(data)
                if size > 1 << 22:
                    yield rows(paths, read, valid)
                    paths, read, valid, size = [], [], [], 0
            if paths:
                yield rows(paths, read, valid)

    dropped = mode.upper() == "DROPMALFORMED"
    kept = "PERMISSIVE" if dropped else mode
    schema, options = _with_corrupt(schemas.PAGE, kept), {"mode": kept, "columnNameOfCorruptRecord": CORRUPT}
    listed = F.when(F.ltrim("written", F.lit(" \t\r\n")).startswith("["), F.from_json("written", "array<string>"))
    pages = F.transform(F.coalesce(listed, F.array("written")),
                        lambda t: F.from_json(F.coalesce(t, F.lit("null")), schema, options))
    names = ("path", "page_name")
    read = files.select("path").mapInArrow(texts, "path string, page_name string, text string, written string").select(
        *names, "text", F.filter(pages, lambda r: r.isNotNull()).alias("pages"))
    if CORRUPT not in schema.fieldNames():
        return read.select(F.inline("pages"), *names)
    broken = F.exists("pages", lambda r: r[CORRUPT].isNotNull())
    read = read.select(*names, F.when(broken, F.col("text")).alias("broken"), "pages").select(F.inline("pages"), *names, "broken")
    if dropped:
        return read.where("broken IS NULL").drop("broken", CORRUPT)
    return read.withColumn(CORRUPT, F.col("broken")).drop("broken")


def list_pages(spark: SparkSession, root: str, prefix: str = "", institution: str | None = None,
               item_id: str | None = None) -> DataFrame:
    """(path, mark, size, page_path) of the page files below ``root``; no file is
    opened.  A folder that does not exist has no pages.  By its mark
    ``read_pages`` finds a file in the folder's listing."""
    from lakeledger.sources.tables import path_exists
    folder = scope_of(root, institution, item_id)
    if not path_exists(spark, folder):
        return spark.createDataFrame([], "path string, mark long, size long, page_path string")
    if in_tasks(spark, folder):
        files = _files(spark, folder).select("path", F.xxhash64("path").alias("mark"), "size")
    else:
        files = in_few_tasks(spark.read.format("binaryFile").option("pathGlobFilter", PAGE_GLOB)
                             .option("recursiveFileLookup", True).load(folder)
                             .select("path", _mark().alias("mark"), F.col("_metadata.file_size").alias("size")))
    return files.select("path", "mark", "size", _page_path(spark, root, prefix).alias("page_path"))


def _page_path(spark: SparkSession, root: str, prefix: str) -> Column:
    """The path of a listed file relative to ``root``, with ``prefix``."""
    base = re.sub("^file:/+", "file:/", _qualified(spark, root).toString().rstrip("/") + "/")
    # Local files are listed as file:/x by some readers and file:///x by others.
    path = F.regexp_replace("path", "^file:/+", "file:/")
    rel = F.substring(path, len(base) + 1, 1 << 20)
    return F.concat(F.lit(prefix), F.when(path.startswith(base), rel).otherwise(path))


def read_pages(spark: SparkSession, root: str, prefix: str = "",
               mode: str = "FAILFAST", institution: str | None = None,
               item_id: str | None = None, layout: str = "files",
               files: list[str] | None = None, marks: list[int] | None = None,
               scan: DataFrame | None = None) -> DataFrame:
    """One row per page file found anywhere below ``root`` (or for the given
    ``files`` of JSON lines, or the page files with the given ``marks``; those
    of a ``scan_pages`` below it, or of a part of the listing, which is then
    not listed again).  Other files are dropped from the listing by the mark
    and not opened; a file whose mark is equal by chance is read too.

    Columns: the ``PAGE`` fields, ``page_name`` (file name) and ``page_path``
    (path relative to ``root``, percent-decoded, with ``prefix`` in front: the
    text that goes into event ids and the ledger).  A bad file fails the
    read by default; with ``mode="PERMISSIVE"`` it becomes a row whose
    ``_corrupt_record`` holds the file text (see ``bronze.ingest``'s
    quarantine).
    """
    listed = False
    if layout == "lines":
        df = read_page_lines(spark, root, mode, files)
    elif layout == "files":
        df = scan_pages(spark, root, mode) if scan is None else scan
        listed = "mark" in df.columns
        if marks is not None:  # as text: a literal at a time takes seconds
            mark = "mark" if listed else "xxhash64(_metadata.file_path)"
            df = df.where(f"{mark} IN ({', '.join(f'{int(m)}L' for m in marks)})")
        if listed:
            df = open_files(df, mode)
    else:
        raise ValueError("layout must be 'files' or 'lines'")
    if institution is not None:
        df = df.filter(S.slugify("institution") == S.slugify(F.lit(institution)))
    if item_id is not None:
        df = df.filter(F.col("item_id") == item_id)
    if layout == "lines":
        return df
    if listed:
        return df.withColumn("page_path", _page_path(spark, root, prefix)).drop("path")
    return df.select(
        "*",
        F.col("_metadata.file_name").alias("page_name"),
        S.relative_path(F.col("_metadata.file_path"), root_uri(spark, root), prefix)
        .alias("page_path"),
    )


def read_jsonl_log(spark: SparkSession, path: str, schema: StructType,
                   required: str | None = None) -> DataFrame:
    """Tolerant JSON-lines read: an absent log is empty; blank and malformed
    lines are dropped (a malformed line parses to an all-null row); with
    ``required`` set, records without that field are dropped too."""
    from lakeledger.sources.tables import path_exists
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    try:
        df = spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return spark.createDataFrame([], schema)
        raise
    if required:
        df = df.filter(F.col(required).isNotNull() & (F.col(required) != ""))
    else:
        df = df.filter(F.greatest(*[F.col(c).isNotNull() for c in schema.fieldNames()]))
    return df
