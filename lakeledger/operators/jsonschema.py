"""JSON Schema as column expressions: which rule a value breaks, and where.

``violations`` turns a schema into one expression over a VARIANT; it runs with
built-in functions and gives an array of (path, rule, found).  Known keywords:

  type (one or several of object array string number integer boolean null),
  enum and const of plain values, required, properties, additionalProperties
  (true or false), items, minItems, maxItems, minLength, maxLength, pattern,
  minimum, maximum, exclusiveMinimum, exclusiveMaximum, format (date, date-time)

Annotations (title, description, default, examples, $id, $schema, $comment) are
allowed and ignored.  Any other keyword is refused, since a rule that is not
checked would pass unseen.

A rule for another type than the value's does not apply, and a missing property
breaks ``required`` only, as the standard says; numbers are compared as doubles
and 1.0 is an integer.  A value that is missing altogether breaks nothing.
Patterns are those of Java, found anywhere in the text.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeledger.functions import scalars as S

FOUND = "array<struct<path:string,rule:string,found:string>>"
_TYPES = ("object", "array", "string", "number", "integer", "boolean", "null")
_NOTES = {"title", "description", "default", "examples", "$id", "$schema", "$comment"}
_PLAIN = (str, int, float, bool, type(None))


def _kind(v: Column) -> Column:
    """The JSON type of a variant; numbers without a fraction are integers."""
    t = F.schema_of_variant(v)
    n = F.try_variant_get(v, "$", "double")
    return (F.when(t == "STRING", "string").when(t == "BOOLEAN", "boolean").when(t == "VOID", "null")
            .when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array")
            .when(t == "BIGINT", "integer").when(n == F.floor(n), "integer").otherwise("number"))


def _plain(values: list) -> list[str]:
    """Plain values as ``to_json`` writes them, numbers as doubles."""
    return [json.dumps(x, ensure_ascii=False) for x in values if isinstance(x, (str, bool)) or x is None]


def _step(name: str) -> str:
    if any(c in name for c in "'\"\\[]"):
        raise ValueError(f"a property's name may not hold quotes, brackets or backslashes: {name}")
    return f"$['{name}']"


def violations(value: Column, schema: dict, path: str | Column = "$") -> Column:
    """Array of (path, rule, found) of a VARIANT column; empty if it is valid,
    also where the value is SQL null (missing)."""
    path = F.lit(path) if isinstance(path, str) else path
    return F.flatten(F.array(F.array().cast(FOUND), *_node(value, schema, path)))


def _node(v: Column, schema: dict, path: Column) -> list[Column]:
    kind = _kind(v)
    number = F.try_variant_get(v, "$", "double")
    text = F.try_variant_get(v, "$", "string")
    out: list[Column] = []

    def rule(name: str, holds: Column, of: str | None = None, found: Column | None = None) -> None:
        wrong = v.isNotNull() & ~F.coalesce(holds, F.lit(False))
        if of == "number":
            wrong = wrong & kind.isin("number", "integer")
        elif of:
            wrong = wrong & (kind == of)
        one = F.struct(path.alias("path"), F.lit(name).alias("rule"),
                       (F.to_json(v) if found is None else found).alias("found"))
        out.append(F.when(wrong, F.array(one)).otherwise(F.array()).cast(FOUND))

    checks: dict[str, Callable] = {
        "minimum": lambda x: rule("minimum", number >= x, "number"),
        "maximum": lambda x: rule("maximum", number <= x, "number"),
        "exclusiveMinimum": lambda x: rule("exclusiveMinimum", number > x, "number"),
        "exclusiveMaximum": lambda x: rule("exclusiveMaximum", number < x, "number"),
        "minLength": lambda x: rule("minLength", F.char_length(text) >= x, "string"),
        "maxLength": lambda x: rule("maxLength", F.char_length(text) <= x, "string"),
        "pattern": lambda x: rule("pattern", text.rlike(x), "string"),
    }
    elements = F.try_variant_get(v, "$", "array<variant>")
    for name, x in schema.items():
        if name in _NOTES:
            continue
        if name in checks:
            checks[name](x)
        elif name == "type":
            kinds = [x] if isinstance(x, str) else list(x)
            if not kinds or set(kinds) - set(_TYPES):
                raise ValueError(f"unknown type: {x}")
            if "number" in kinds:
                kinds.append("integer")
            rule("type", kind.isin(kinds), found=kind)
        elif name in ("enum", "const"):
            values = list(x) if name == "enum" else [x]
            if any(not isinstance(y, _PLAIN) for y in values):
                raise ValueError(f"{name} takes plain values only")
            numbers = [float(y) for y in values if isinstance(y, (int, float)) and not isinstance(y, bool)]
            same = F.to_json(v).isin(_plain(values)) if _plain(values) else F.lit(False)
            if numbers:
                same = F.when(kind.isin("number", "integer"), number.isin(numbers)).otherwise(same)
            rule(name, same)
        elif name == "format":
            if x == "date":
                good = text.rlike(r"^\d{4}-\d{2}-\d{2}$") & S.iso_date(text).isNotNull()
            elif x == "date-time":
                good = text.rlike(r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}") & F.try_to_timestamp(text).isNotNull()
            else:
                raise ValueError(f"unknown format: {x}")
            rule("format", good, "string")
        elif name in ("minItems", "maxItems"):
            rule(name, F.size(elements) >= x if name == "minItems" else F.size(elements) <= x, "array",
                 F.size(elements).cast("string"))
        elif name == "items":
            each = F.transform(elements, lambda e, i: violations(
                e, x, F.concat(path, F.lit("["), i.cast("string"), F.lit("]"))))
            out.append(F.coalesce(F.flatten(each), F.array().cast(FOUND)))
        elif name == "required":
            for key in x:
                there = F.try_variant_get(v, _step(key), "variant").isNotNull()
                missing = v.isNotNull() & (kind == "object") & ~there
                one = F.struct(F.concat(path, F.lit(f".{key}")).alias("path"), F.lit("required").alias("rule"),
                               F.lit(None).cast("string").alias("found"))
                out.append(F.when(missing, F.array(one)).otherwise(F.array()).cast(FOUND))
        elif name == "properties":
            for key, below in x.items():
                out.extend(_node(F.try_variant_get(v, _step(key), "variant"), below, F.concat(path, F.lit(f".{key}"))))
        elif name == "additionalProperties":
            if x is True:
                continue
            if x is not False:
                raise ValueError("additionalProperties is true or false")
            names = F.map_keys(F.try_variant_get(v, "$", "map<string,variant>"))
            known = F.array(*[F.lit(k) for k in schema.get("properties", {})]).cast("array<string>")
            extra = F.array_sort(F.array_except(names, known))
            out.append(F.coalesce(F.transform(extra, lambda k: F.struct(
                F.concat(path, F.lit("."), k).alias("path"), F.lit("additionalProperties").alias("rule"),
                k.alias("found"))), F.array().cast(FOUND)))
        else:
            raise ValueError(f"the keyword {name} is not known")
    return out


#: The element of ``added`` and ``modified`` that Bronze reads without loss.
TRANSACTION = {
    "type": "object",
    "required": ["transaction_id", "account_id", "amount", "date"],
    "properties": {
        "transaction_id": {"type": "string", "minLength": 1},
        "account_id": {"type": "string", "minLength": 1},
        "amount": {"type": "number"},
        "iso_currency_code": {"type": ["string", "null"], "pattern": "^[A-Z]{3}$"},
        "date": {"type": "string", "format": "date"},
        "authorized_date": {"type": ["string", "null"], "format": "date"},
        "pending": {"type": "boolean"},
    },
}


def element_violations(pages: DataFrame, schema: dict | None = None,
                       arrays: tuple[str, ...] = ("added", "modified")) -> DataFrame:
    """(page_path, array, pos, path, rule, found) of the elements of pages (JSON
    texts) that break ``schema``; a text that is no JSON breaks rule ``json``."""
    schema = TRANSACTION if schema is None else schema
    each = pages.select("page_path", F.explode(F.array(*[
        F.struct(F.lit(a).alias("array"), F.col(a).alias("texts")) for a in arrays])).alias("a"))
    each = each.select("page_path", "a.array", F.posexplode("a.texts").alias("pos", "text"))
    each = each.withColumn("v", F.try_parse_json("text"))
    no_json = F.array(F.struct(F.lit("$").alias("path"), F.lit("json").alias("rule"), F.col("text").alias("found")))
    wrong = F.when(F.col("text").isNotNull() & F.col("v").isNull(), no_json.cast(FOUND)).otherwise(
        violations(F.col("v"), schema))
    return each.select("page_path", "array", F.col("pos").cast("bigint").alias("pos"), F.explode(wrong).alias("w")) \
        .select("page_path", "array", "pos", "w.*")


def valid_pages(pages: DataFrame, schema: dict | None = None,
                arrays: tuple[str, ...] = ("added", "modified")) -> tuple[DataFrame, DataFrame]:
    """``pages`` whose elements are all valid, and the others with
    ``violations`` (of all their elements), for a quarantine."""
    schema = TRANSACTION if schema is None else schema
    def checked(a: str) -> Column:
        def of(text, i):
            at = F.concat(F.lit(f"$.{a}["), i.cast("string"), F.lit("]"))
            v = F.try_parse_json(text)
            no_json = F.array(F.struct(at.alias("path"), F.lit("json").alias("rule"), text.alias("found"))).cast(FOUND)
            return F.when(text.isNotNull() & v.isNull(), no_json).otherwise(violations(v, schema, at))
        return F.flatten(F.transform(F.coalesce(F.col(a), F.array().cast("array<string>")), of))

    judged = pages.withColumn("violations", F.flatten(F.array(*map(checked, arrays))))
    return judged.where(F.size("violations") == 0).drop("violations"), judged.where(F.size("violations") > 0)
