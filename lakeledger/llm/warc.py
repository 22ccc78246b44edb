"""Web archives (WARC 1.1) with revisit resolution.

Writing.  Header rows (digest, page id) are shuffled by payload digest and
reduced, already in the map tasks, to the smallest page id of each digest that
occurs more than once.  Pages are joined with these on the digest, a join that
Spark can split where one payload is very common.  The page with the smallest
id becomes the ``response``; the others become ``revisit`` records without the
payload, with fresh headers that refer to it.  Archives are gzip text files
whose line end is the blank lines that end a record; a task writes one.

Reading.  Archives are streamed piece by piece; a record is put together by
its Content-Length, so a payload may hold blank lines, and memory holds one
record.  Payload size and digest are computed from the bytes read.  Revisits
are joined with the response they refer to, by record id.

Defined results: a null payload is empty.  Payloads under ``MIN_BYTES`` are
all responses.  Rows equal in page id and payload share one role (each gets a
record).  Rows without a page id never serve as the original; they revisit one
if there is one.  Line ends in a URL are percent-encoded; a null URL is
written as ``about:blank`` and read as null.  Payloads of any length are written
whole.  Other columns play no part, whatever their names.  Empty tables give
archives without records, which read as no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Payloads of fewer bytes are always written in full.
MIN_BYTES = 100

_END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

RECORD = ("page_id bigint, url string, record_type string, record_id string, refers_to_id string, "
          "refers_to bigint, payload_bytes bigint, payload_digest string, digest_ok boolean")


def _record_id(page_id: Column, digest: Column) -> Column:
    h = F.md5(F.concat_ws("|", F.coalesce(page_id.cast("string"), F.lit("null")), digest).cast("binary"))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def originals(headers: DataFrame) -> DataFrame:
    """(digest, first): the smallest page id of every payload that several
    rows hold and that is long enough."""
    return (headers.where(F.col("bytes") >= MIN_BYTES).groupBy("digest")
            .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
            .where("n > 1 and first is not null").select("digest", "first"))


def write_archives(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url",
                   payload: str = "html") -> None:
    """Writes one record for each row of ``pages``."""
    body = F.coalesce(F.col(f"`{payload}`").cast("string"), F.lit(""))
    base = pages.select(F.col(f"`{page_id}`").cast("bigint").alias("page_id"),
                        F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("about:blank")).alias("url"),
                        body.alias("body"), F.sha2(body, 256).alias("digest"))
    headers = pages.select(F.col(f"`{page_id}`").cast("bigint").alias("page_id"),
                           F.sha2(body, 256).alias("digest"), F.octet_length(body).alias("bytes"))
    rows = base.join(originals(headers), "digest", "left")
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    head = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.octet_length("body").cast("string"), F.lit(_END))
    block = F.concat(head, F.when(revisit, F.lit("")).otherwise(F.col("body")))
    clean_url = F.replace(F.replace(F.col("url"), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    lines = [
        F.lit("WARC/1.1"),
        F.concat(F.lit("WARC-Type: "), F.when(revisit, "revisit").otherwise("response")),
        F.concat(F.lit("WARC-Record-ID: "), _record_id(F.col("page_id"), F.col("digest"))),
        F.concat(F.lit("WARC-Date: "), F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss'Z'")),
        F.concat(F.lit("WARC-Target-URI: "), clean_url),
        F.concat(F.lit("WARC-Payload-Digest: sha256:"), F.col("digest")),
        F.when(revisit, F.concat(F.lit(f"WARC-Profile: {_PROFILE}\r\nWARC-Refers-To: "),
                                 _record_id(F.col("first"), F.col("digest")))),
        F.concat(F.lit("X-Page-Id: "), F.col("page_id").cast("string")),
        F.when(revisit, F.concat(F.lit("X-Refers-To-Page-Id: "), F.col("first").cast("string"))),
        F.lit("Content-Type: application/http; msgtype=response"),
        F.concat(F.lit("Content-Length: "), F.octet_length("block").cast("string")),
    ]
    rows = rows.withColumn("block", block)
    value = F.concat(F.concat_ws("\r\n", *lines), F.lit(_END), F.col("block"))
    (rows.select(value.alias("value")).write.option("lineSep", _END).option("compression", "gzip").text(path))


def parse_header(raw: bytes) -> dict[str, str]:
    """Fields of a header block, names in lower case."""
    out = {}
    for line in raw.decode("utf-8", "replace").split("\r\n")[1:]:
        name, _, value = line.partition(":")
        out[name.strip().lower()] = value.strip()
    return out


def records(pieces: Iterable[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """(header, block) of the records whose text, cut at blank lines, comes
    piece by piece.  A block that ends in a line end is cut two bytes early;
    what a piece holds beyond the Content-Length is the blank lines after the
    block and the next header."""
    end = _END.encode()
    header, parts, have, need = None, [], 0, 0
    for piece in pieces:
        if header is not None:
            parts.append(piece)
            have += 4 + len(piece)
            if have < need:
                continue
            whole = end.join(parts)
            piece = whole[need:]
            if piece and not piece.startswith(end):
                raise ValueError("a record is longer than its Content-Length")
            yield header, whole[:need]
            header, piece = None, piece[4:]
        if not piece:
            continue
        if not piece.startswith(b"WARC/"):
            raise ValueError("not the start of a record")
        header, parts, have = parse_header(piece), [], -4
        need = int(header["content-length"])
        if need == 0:
            yield header, b""
            header = None
    if header is not None:
        raise ValueError("the archive ends inside a record")


def _row(header: dict[str, str], block: bytes) -> tuple:
    kind = header.get("warc-type", "")
    page, first = header.get("x-page-id"), header.get("x-refers-to-page-id")
    url = header.get("warc-target-uri")
    said = header.get("warc-payload-digest", "").removeprefix("sha256:")
    size = digest = ok = None
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2] if block.startswith(b"HTTP/") else block
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
        ok = digest == said
    return (int(page) if page else None, None if url == "about:blank" else url, kind, header.get("warc-record-id"),
            header.get("warc-refers-to"), int(first) if first else None, size, digest if digest else said, ok)


_ARROW = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()),
                    ("record_id", pa.string()), ("refers_to_id", pa.string()), ("refers_to", pa.int64()),
                    ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("digest_ok", pa.bool_())])


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records' headers, with size and digest of the payload as read
    (null and as declared for revisits)."""
    def run(batches):
        def pieces():
            for b in batches:
                yield from b.column(0).to_pylist()
        rows = []
        for header, block in records(pieces()):
            rows.append(_row(header, block))
            if len(rows) == 1000:
                yield pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, r)) for r in rows], _ARROW)
                rows = []
        if rows:
            yield pa.RecordBatch.from_pylist([dict(zip(_ARROW.names, r)) for r in rows], _ARROW)

    text = spark.read.option("lineSep", _END).schema("value string").text(path)
    return text.select(F.col("value").cast("binary").alias("piece")).mapInArrow(run, RECORD)


def resolve(recs: DataFrame) -> DataFrame:
    """Records with revisits resolved: payload size and digest come from the
    response a revisit refers to (``resolved`` is false if it is missing or
    its payload is another)."""
    known = (recs.where("record_type = 'response'").groupBy("record_id")
             .agg(F.min("payload_bytes").alias("__bytes"), F.min("payload_digest").alias("__digest")))
    revisits = recs.where("record_type = 'revisit'").join(
        known.withColumnRenamed("record_id", "refers_to_id"), "refers_to_id", "left")
    rest = recs.where("record_type != 'revisit'")
    cols = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest"]
    ok = F.coalesce(F.col("__digest") == F.col("payload_digest"), F.lit(False))
    done = revisits.select("page_id", "url", "record_type", "refers_to", F.col("__bytes").alias("payload_bytes"),
                           "payload_digest", ok.alias("resolved"))
    return rest.select(*cols, F.coalesce("digest_ok", F.lit(False)).alias("resolved")).unionByName(done)


def archive(pages: DataFrame, path: str, page_id: str = "page_id", url: str = "url",
            payload: str = "html") -> DataFrame:
    """Writes the archives and reads them back, revisits resolved."""
    write_archives(pages, path, page_id, url, payload)
    return resolve(read_archives(pages.sparkSession, path))


ORACLE = """
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
g AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
o AS (SELECT payload_digest, min(page_id) AS first_id FROM g WHERE payload_bytes >= 100
      GROUP BY payload_digest HAVING count(*) > 1)
SELECT g.page_id, g.payload_bytes, g.payload_digest,
       CASE WHEN o.first_id IS NOT NULL AND g.page_id IS DISTINCT FROM o.first_id
            THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.page_id IS DISTINCT FROM o.first_id THEN o.first_id END AS refers_to
FROM g LEFT JOIN o USING (payload_digest)
"""
