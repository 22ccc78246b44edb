"""Personal data: base expressions, and contextual extraction by bootstrapping.

The base expressions find emails, IP addresses, card and phone numbers.  These
are the seeds.  Every occurrence of a seed, or of a candidate (a run of digits
or a token with an at sign that no base expression took), lies between words
which give patterns: the two words before it, and the word on either side.
Patterns and instances form a graph, which Spark scores in rounds until one
accepts nothing new (accepted instances keep their score, so rounds end):

* a pattern's confidence for a kind is f / (f + conflicts + 1), where f is the
  sum of its instances' scores for the kind and conflicts are its seeds of
  other kinds and its candidates whose form rules the kind out; candidates that
  may be of the kind count neither way, however many there are.  It needs
  ``SUPPORT``;
* a candidate's score is the chance that at least one of its confident
  patterns is right; above ``ACCEPT`` it becomes an instance of the kind, if
  its form allows that, and supports further patterns in the next round.

An occurrence of an accepted instance next to a confident pattern is a span;
the base spans always stay.  Patterns, instances and edges stay distributed;
very common ones are reduced in the map tasks or joined by joins that Spark
can split.

Defined results: null and empty texts have no spans.  Offsets are code points,
ends exclusive.  Rows are told apart by a digest of their text, of which the
spans are a function; repeated rows and null ids each keep a row.  Texts of any
length are read whole; of a pattern's words the first 40 characters count, of the
text around an occurrence 120 before it and 80 behind.  Between kinds that start
at one place the order of ``KINDS`` decides.  Columns of the input keep their names
and values; those added replace columns of the same names.  An empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType

from lakeledger.llm.util import claim, cut

#: Kinds in the order of ties.
KINDS = ("email", "ip", "card", "phone")
#: Sum of scores a pattern needs, least confidence of a pattern, and least
#: score of an accepted candidate.
SUPPORT, CONFIDENT, ACCEPT = 5.0, 0.75, 0.9
#: Texts with found spans up to which these are sent to every task.
SEND = 100_000

# The base expressions.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

_DIGIT = re.compile(r"[0-9]")
_RUN = re.compile(r"[0-9](?:[ ().:/-]{0,2}[0-9])+")
_AT = re.compile(r"[^\s@]+@[^\s@]+")
_WORD_BEFORE = re.compile(r"(\S+)\s+(\S+)\s*$|(\S+)\s*$")
_WORD_AFTER = re.compile(r"\s*(\S+)")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    """By the at signs: the run of local characters before one reaches back to
    the last match at most, so long runs are read once."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = done + len(text[done:at].rstrip(_LOCAL))
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
        # Local characters hold no at sign: the next run begins behind this one.
        done = m.end() if m else at + 1
        at = text.find("@", done)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind."""
    out = []
    if "@" in text:
        out += [("email", a, b) for a, b in emails(text)]
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".")):
                out.append(("ip", *m.span()))
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 12:
                digits = m.group().replace(" ", "").replace("-", "")
                if 12 <= len(digits) <= 19 and luhn(digits):
                    out.append(("card", *m.span()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= sum(c.isdigit() for c in m.group()) <= 15:
                    out.append(("phone", *m.span()))
    out.sort(key=lambda s: (s[1], KINDS.index(s[0])))
    return out


def candidate_spans(text: str, taken: list[tuple[str, int, int]]) -> list[tuple[int, int]]:
    """Runs of at least five digits, and tokens with an at sign, that stand
    alone and touch no base span."""
    found = []
    if _DIGIT.search(text):
        found = [m.span() for m in _RUN.finditer(text) if sum(c.isdigit() for c in m.group()) >= 5]
    if "@" in text:
        for m in _AT.finditer(text):
            a, b = m.span()
            while b > a and not text[b - 1].isalnum():
                b -= 1
            while a < b and not text[a].isalnum():
                a += 1
            found.append((a, b))
    alone = lambda a, b: not (text[a - 1:a].isalnum() or text[b:b + 1].isalnum())
    out, i = [], 0
    for a, b in sorted(set(found)):
        while i < len(taken) and taken[i][2] <= a:
            i += 1
        if a < b and alone(a, b) and not any(s < b and a < e for _, s, e in taken[max(0, i - 4):i + 8]):
            out.append((a, b))
    return out


def forms(instance: str) -> list[str]:
    """Kinds whose form an instance may have."""
    digits = sum(c.isdigit() for c in instance)
    if "@" in instance:
        return ["email"]
    if not re.fullmatch(r"[0-9 ().:/-]+", instance):
        return []
    out = []
    if 2 <= max(instance.count("."), instance.count(":")) <= 7 and " " not in instance:
        out.append("ip")
    if 12 <= digits <= 19:
        out.append("card")
    if 7 <= digits <= 15:
        out.append("phone")
    return out


def _norm(word: str) -> str:
    return re.sub(r"[0-9]+", "0", word.lower())[:40]


def patterns(text: str, start: int, end: int) -> list[str]:
    """The two words before an occurrence, and the word on either side."""
    m = _WORD_BEFORE.search(text[max(0, start - 120):start])
    two, one = ((m.group(1), m.group(2)) if m.group(1) else (None, m.group(3))) if m else (None, None)
    after = _WORD_AFTER.match(text, end, end + 80)
    one = _norm(one) if one else "^"
    out = [f"around {one} _ {_norm(after.group(1)) if after else '$'}"]
    if two:
        out.append(f"before {_norm(two)} {one} _")
    return out


_OCCURRENCE = "struct<kind:string,start:int,end:int,instance:string,patterns:array<string>>"


def occurrences(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with its digest, its base spans, and all
    seeds and candidates with their patterns."""
    keep = [c for c in docs.columns if c not in (text, "digest", "found")]
    inner = docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"),
                        *[F.col(f"`{c}`") for c in keep])
    occurrence = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()),
                            ("instance", pa.string()), ("patterns", pa.list_(pa.string()))])

    def run(batches):
        claim("pii")
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                digests, found = [], []
                for t in part.column(0).to_pylist():
                    base = base_spans(t)
                    spans = base + [(None, *s) for s in candidate_spans(t, base)]
                    found.append([(k, a, e, t[a:e], patterns(t, a, e)) for k, a, e in spans])
                    digests.append(hashlib.md5(t.encode()).hexdigest() if spans else None)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array(digests, pa.string()),
                     pa.array([[dict(zip(("kind", "start", "end", "instance", "patterns"), o)) for o in f]
                               for f in found], pa.list_(occurrence))], names=[*keep, "digest", "found"])

    return inner.mapInArrow(run, StructType(inner.drop("__text").schema.fields + [
        StructField("digest", StringType()), StructField("found", DataType.fromDDL(f"array<{_OCCURRENCE}>"))]))


def _allowed(kind: Column, instance: Column) -> Column:
    """``forms`` with built-in functions."""
    digits = F.length(F.regexp_replace(instance, "[^0-9]", ""))
    plain = instance.rlike("^[0-9 ().:/-]+$")
    dots = F.greatest(F.length(F.regexp_replace(instance, r"[^.]", "")), F.length(F.regexp_replace(instance, "[^:]", "")))
    return (F.when(instance.contains("@"), kind == "email").when(~plain, F.lit(False))
            .when(kind == "ip", dots.between(2, 7) & ~instance.contains(" "))
            .when(kind == "card", digits.between(12, 19)).when(kind == "phone", digits.between(7, 15))
            .otherwise(F.lit(False)))


def conflicts(edges: DataFrame) -> DataFrame:
    """(pattern, kind, against): how many instances of a pattern speak against a
    kind, as seeds of another one or by their form."""
    seeded = edges.groupBy("pattern", "instance").agg(F.collect_set("seed").alias("seeds"))
    against = lambda k: F.when(F.size("seeds") > 0, ~F.array_contains("seeds", k)).otherwise(
        ~_allowed(F.lit(k), F.col("instance")))
    counts = seeded.groupBy("pattern").agg(*[F.sum(against(k).cast("bigint")).alias(k) for k in KINDS])
    return counts.select("pattern", F.explode(F.array(*[
        F.struct(F.lit(k).alias("kind"), F.col(k).alias("against")) for k in KINDS])).alias("c")).select("pattern", "c.*")


def bootstrap(found: DataFrame) -> tuple[DataFrame, DataFrame] | None:
    """From rows of (digest, found): the accepted (instance, kind, score) and
    the confident (pattern, kind, confidence); None if nothing was found."""
    occ = found.select(F.explode("found").alias("o")).select("o.*")
    edges = cut(occ.select(F.explode("patterns").alias("pattern"), "instance", F.col("kind").alias("seed")).distinct())
    candidates = edges.where("seed is null").select("instance").distinct()
    seeds = edges.where("seed is not null").select("instance", F.col("seed").alias("kind")).distinct() \
        .withColumn("score", F.lit(1.0))
    against = conflicts(edges)
    links = edges.select("pattern", "instance").distinct()
    accepted, members = None, seeds
    while True:
        confident = cut(
            links.join(members, "instance").groupBy("pattern", "kind").agg(F.sum("score").alias("f"))
            .where(F.col("f") >= SUPPORT).join(against, ["pattern", "kind"])
            .withColumn("confidence", F.col("f") / (F.col("f") + F.col("against") + 1))
            .where(F.col("confidence") >= CONFIDENT)
            .select("pattern", "kind", "confidence"))
        if confident.isEmpty():
            return None
        reached = (
            links.join(confident, "pattern").join(candidates, "instance", "left_semi")
            .where(_allowed(F.col("kind"), F.col("instance")))
            .groupBy("instance", "kind").agg((1 - F.exp(F.sum(F.log(1 - F.col("confidence") + 1e-6)))).alias("score"))
            .where(F.col("score") >= ACCEPT))
        new = cut(reached if accepted is None else reached.join(accepted, ["instance", "kind"], "left_anti"))
        if new.isEmpty():
            return None if accepted is None else (accepted, confident)
        if accepted is not None:
            new = cut(accepted.unionByName(new).groupBy("instance", "kind").agg(F.max("score").alias("score")))
        accepted = new
        members = seeds.unionByName(accepted).groupBy("instance", "kind").agg(F.max("score").alias("score"))


def discovered(found: DataFrame) -> DataFrame | None:
    """(digest, more): the spans that the patterns add to a text."""
    got = bootstrap(found)
    if got is None:
        return None
    accepted, confident = got
    occ = (found.where("digest is not null").select("digest", F.explode("found").alias("o")).select("digest", "o.*")
           .where("kind is null").drop("kind").distinct()
           .select("digest", "start", "end", "instance", F.explode("patterns").alias("pattern")))
    spans = (occ.join(confident, "pattern").join(accepted, ["instance", "kind"])
             .select("digest", "kind", "start", "end").distinct())
    return spans.groupBy("digest").agg(F.collect_set(F.struct("kind", "start", "end")).alias("more"))


def _joined(spans: Column) -> Column:
    order = F.array_sort(F.transform(spans, lambda s: F.struct(
        s["start"].alias("start"), F.array_position(F.array(*map(F.lit, KINDS)), s["kind"]).alias("k"),
        s["end"].alias("end"), s["kind"].alias("kind"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the text, with counts of base spans, their digest
    base_sha256, and all spans."""
    own = [c for c in docs.columns if c != text]
    rows = cut(occurrences(docs.select(*[F.col(f"`{c}`").alias(f"__{c}") for c in own],
                                       F.col(f"`{text}`").alias("__t")), "__t"))
    more = discovered(rows.select("digest", "found"))
    if more is None:
        rows = rows.withColumn("more", F.lit(None).cast("array<struct<kind:string,start:int,end:int>>"))
    else:
        rows = rows.join(more, "digest", "left")
    base = F.transform(F.filter("found", lambda o: o["kind"].isNotNull()), lambda o: F.struct(
        o["kind"].alias("kind"), o["start"].alias("start"), o["end"].alias("end")))
    rows = rows.withColumn("__base", base)
    count = lambda k: F.size(F.filter("__base", lambda s: s["kind"] == k)).cast("bigint")
    return rows.select(*[F.col(f"`__{c}`").alias(c) for c in own], *[count(k).alias(f"n_{k}") for k in KINDS],
                       F.sha2(_joined(F.col("__base")), 256).alias("base_sha256"),
                       _joined(F.concat("__base", F.coalesce("more", F.array().cast(
                           "array<struct<kind:string,start:int,end:int>>")))).alias("spans"))


def masked(text: str, spans: list[tuple[str, int, int]]) -> str:
    """The text with each stretch of overlapping spans replaced by its kind."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2])):
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """``docs`` with all spans masked; a column with the text's length is kept
    right.  Null texts stay null."""
    found = cut(occurrences(docs.select(F.col(f"`{text}`").alias("__t")), "__t").where("digest is not null"))
    more = discovered(found)
    t = F.col(f"`{text}`").cast("string")
    if more is None:
        marked = docs.withColumn("__more", F.lit(None).cast("array<struct<kind:string,start:int,end:int>>"))
    else:
        more = cut(more.select(F.col("digest").alias("__d"), F.col("more").alias("__more")))
        if more.count() <= SEND:
            more = F.broadcast(more)
        marked = docs.withColumn("__d", F.md5(t.cast("binary"))).join(more, "__d", "left").drop("__d")

    @F.pandas_udf("string")
    def mask(texts, extra):
        import pandas as pd
        return pd.Series([None if x is None else masked(x, base_spans(x) + [
            (s["kind"], s["start"], s["end"]) for s in (e if e is not None else [])]) for x, e in zip(texts, extra)],
            dtype=object)

    out = marked.withColumn(text, mask(t, F.col("__more")))
    if length is not None and length in docs.columns:
        out = out.withColumn(length, F.length(F.col(f"`{text}`")).cast(docs.schema[length].dataType))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
