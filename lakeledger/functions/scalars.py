"""Scalar column functions.

Every rule is a composition of built-in Spark expressions, so it runs inside
whole-stage codegen; none of these is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "strip", "slugify", "parse_iso", "event_id", "coalesce_blank", "safe_str",
    "normalize_bool", "normalize_type", "iso_date_parts", "is_iso_date",
    "page_number", "page_run_id", "relative_path", "json_id", "variant_id", "is_json_object",
    "iso_text", "iso_date",
]

# The vocabulary of truthy and falsy texts.
TRUE_TEXTS = ["true", "t", "1", "yes", "y"]
FALSE_TEXTS = ["false", "f", "0", "no", "n"]

# Accepted date texts: ISO date with an optional time of day and offset, or
# eight digits.
ISO_DATE_RE = (r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:?\d{2}(:?\d{2}([.,]\d{1,9})?)?)?"
               r"\s?(Z|z|[+-]\d{2}(:?\d{2})?)?)?$")
BASIC_DATE_RE = r"^\d{8}$"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# The characters Python's ``str.strip()`` removes: every code point whose
# ``isspace()`` is true (derived from that rule, not listed by hand).
WHITESPACE = "".join(ch for ch in map(chr, range(0x110000)) if ch.isspace())


def strip(c) -> Column:
    """Remove leading and trailing Unicode white space (``trim`` alone
    removes blanks only).  Most values have none: the two end characters
    are looked up in the set first, and only then is ``btrim`` run."""
    col = _c(c)
    ws = F.lit(WHITESPACE)
    # position('' in ws) is 1: an empty text also takes btrim, harmlessly
    ends = (F.position(F.substring(col, 1, 1), ws) > 0) | \
        (F.position(F.substring(col, -1, 1), ws) > 0)
    return F.when(ends, F.btrim(col, ws)).otherwise(col)


def slugify(c) -> Column:
    """null -> ''; strip, lower; white-space runs -> '_'; keep only
    ``[a-z0-9_-]``; empty -> 'unknown'."""
    s = F.lower(strip(F.coalesce(_c(c), F.lit(""))))
    s = F.regexp_replace(s, r"(?U)\s+", "_")
    s = F.regexp_replace(s, r"[^a-z0-9_\-]", "")
    return F.when(s == "", F.lit("unknown")).otherwise(s)


def parse_iso(c) -> Column:
    """ISO-8601 text (trailing Z or offset) -> timestamp; null when unparsable.
    Relies on the session time zone being UTC for texts without offset."""
    return F.try_to_timestamp(_c(c))


def iso_text(ts) -> Column:
    """Timestamp -> ISO text with microseconds and Z (UTC session)."""
    return F.date_format(_c(ts), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def event_id(item_id, run_id, page_path, event_type, transaction_id) -> Column:
    """SHA-256 hex of ``item|run|page_path|type|id``.  A null item hashes as
    '', a null or empty run as 'unknown'.  ``concat_ws`` drops nulls, hence
    the explicit coalesces."""
    return F.sha2(F.concat_ws(
        "|",
        F.coalesce(_c(item_id), F.lit("")),
        F.coalesce(F.nullif(_c(run_id), F.lit("")), F.lit("unknown")),
        F.coalesce(_c(page_path), F.lit("")),
        F.coalesce(_c(event_type), F.lit("")),
        F.coalesce(_c(transaction_id), F.lit("")),
    ), 256)


def coalesce_blank(*cols) -> Column:
    """First value that is neither null nor blank text."""
    return F.coalesce(*[F.when(strip(_c(c)) != "", _c(c)) for c in cols])


def safe_str(c) -> Column:
    """Text of a value; null and '' -> null."""
    return F.nullif(_c(c).cast("string"), F.lit(""))


def normalize_bool(c, kind: str = "string") -> Column:
    """Boolean from a value of Spark type ``kind``: booleans pass, numbers are
    ``<> 0`` (NaN -> null), texts are looked up after strip+lower in the
    vocabulary below; any other text -> null."""
    col = _c(c)
    if kind == "boolean":
        return col
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return col != 0
    if kind in ("float", "double"):
        return F.when(~F.isnan(col), col != 0)
    s = F.lower(strip(col.cast("string")))
    return (F.when(s.isin(TRUE_TEXTS), F.lit(True))
            .when(s.isin(FALSE_TEXTS), F.lit(False)))


def normalize_type(c) -> Column:
    """Event type for matching: lower(strip(x))."""
    return F.lower(strip(_c(c)))


def is_iso_date(c) -> Column:
    col = _c(c)
    return col.rlike(ISO_DATE_RE) | col.rlike(BASIC_DATE_RE)


def iso_date(c) -> Column:
    """The date written in an ISO date or date-time text (its own calendar
    day, whatever the offset); null when the text is not such a date."""
    return _as_date(c)


def _as_date(c) -> Column:
    col = _c(c)
    basic = F.concat_ws("-", F.substring(col, 1, 4), F.substring(col, 5, 2),
                        F.substring(col, 7, 2))
    return (F.when(col.rlike(BASIC_DATE_RE), basic.try_cast("date"))
            .when(col.rlike(ISO_DATE_RE), F.substring(col, 1, 10).try_cast("date")))


def iso_date_parts(c) -> tuple[Column, Column]:
    """(year, month) as bigint of an ISO date text; null when not a date."""
    d = _as_date(c)
    return F.year(d).cast("bigint"), F.month(d).cast("bigint")


def page_number(page_name) -> Column:
    """Page number from ``page_{n:04d}_{run}.json``."""
    return F.regexp_extract(_c(page_name), r"^page_(\d+)_", 1).try_cast("bigint")


def page_run_id(page_name) -> Column:
    """Run id from ``page_{n:04d}_{run}.json``."""
    return F.regexp_extract(_c(page_name), r"^page_\d+_(.*)\.json$", 1)


def relative_path(uri, root_uri: str, prefix: str = "") -> Column:
    """Path of a file relative to the scanned root, percent-decoded (a ``+``
    stays), with an optional prefix.  ``_metadata.file_path`` and the root
    are URIs in the form Hadoop gives them."""
    root = root_uri.rstrip("/") + "/"
    # Local files are file:/x for some readers and file:///x for others.
    full = F.regexp_replace(_c(uri), "^file:/+", "file:/")
    rel = F.when(F.startswith(full, F.lit(root)), F.substr(full, F.lit(len(root) + 1))).otherwise(full)
    return F.concat(F.lit(prefix), F.url_decode(F.replace(rel, F.lit("+"), F.lit("%2B"))))


def is_json_object(c) -> Column:
    return F.ltrim(_c(c)).startswith("{")


def variant_id(v, field: str = "transaction_id") -> Column:
    """Id of an element of unknown type: a string itself, or the named field
    of an object; null for numbers, booleans, arrays and nulls."""
    kind = F.schema_of_variant(_c(v))
    return (F.when(kind == "STRING", F.try_variant_get(_c(v), "$", "string"))
            .when(kind.startswith("OBJECT"), F.try_variant_get(_c(v), f"$.{field}", "string")))


def json_id(c, field: str = "transaction_id") -> Column:
    """Id of an element: the named field of an object, the text itself for a
    bare string; null otherwise."""
    col = _c(c)
    return F.when(is_json_object(col), F.get_json_object(col, f"$.{field}")) \
        .otherwise(col)
