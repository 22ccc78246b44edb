"""URL filter: rules first, then multinomial naive Bayes over the words of the
host and the path.

Names written together are split by the most likely sequence of words
(Viterbi over unigrams).  The unigrams are word counts over the text of all
pages; a word is kept when it makes up at least ``SHARE`` of all words, so the
model has at most 1 / SHARE of them, whatever the input, and can be sent to
every task.  The naive Bayes counts cover the urls of all pages: a url with a
word of ``SEEDS`` is an example of ``block``, any other of ``allow``; what
else stands beside the seeds is learned.  Rare tokens share one entry, which
bounds that table in the same way.

Defined results: a null url, or one without ``://``, has an empty host and
path, fits no rule and has no words, so the prior judges it.  Among rules that
fit, the longest text wins, then the first listed.  Rows are judged one by
one; repeated rows get repeated results and an empty table an empty one.  Urls of
any length are read whole.  Other columns are kept; those added replace columns of
the same names.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Least share of all words, or tokens, that a model entry has.
SHARE = 1e-5
#: Longest word of a split.
LONGEST = 20

# Words that mark an example of ``block``.
SEEDS = ("adult", "ads", "bet", "bets", "betting", "casino", "gambling", "lottery", "malware", "phishing",
         "pills", "poker", "porn", "sex", "slots", "spam", "viagra", "warez", "xxx")

OTHER = "<other>"
NUMBER = "<number>"


def host_and_path(url: Column) -> tuple[Column, Column]:
    u = F.coalesce(url.cast("string"), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.regexp_extract(u, pattern, 1)
    return (F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
            F.regexp_extract(u, pattern, 2))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The text of the rule that fits, or null.  ``rules``: (verdict, text),
    text being a host and a path, such as ``example.com/en/``; the list is
    part of the plan."""
    out = F.lit(None).cast("string")
    for _, text in sorted(reversed(rules), key=lambda r: len(r[1])):  # the longest is asked first
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        out = F.when(fits, F.lit(text)).otherwise(out)
    return out


def word_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """(word, n): ASCII words in the text of all pages."""
    text = F.regexp_replace(F.lower(F.coalesce(F.col(f"`{html}`").cast("string"), F.lit(""))), "<[^>]*>", " ")
    words = F.regexp_extract_all(text, F.lit(r"(?<![^\x00-\x7F])\b[a-z]{2,%d}\b(?![^\x00-\x7F])" % LONGEST), F.lit(0))
    return pages.select(F.explode(words).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def frequent(counts: DataFrame, share: float) -> dict[str, int]:
    """The entries with at least ``share`` of the sum of ``n``; at most
    1 / share of them."""
    total = counts.agg(F.sum("n")).first()[0] or 0
    return {r[0]: r[1] for r in counts.where(F.col("n") >= max(1, math.ceil(total * share))).collect()}


@dataclass
class Splitter:
    """Most likely split of a name into words."""

    counts: dict[str, int]
    known: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def __post_init__(self):
        # Seeds count at least as much as the most frequent hundredth.
        ranked = sorted(self.counts.values(), reverse=True)
        floor = ranked[len(ranked) // 100] if ranked else 1
        self.counts = {**self.counts, **{s: max(self.counts.get(s, 0), floor) for s in SEEDS}}
        total = sum(self.counts.values())
        self.cost = {w: math.log(total / n) for w, n in self.counts.items()}
        # A letter that no word covers costs more than any word.
        self.letter = math.log(total + 1) + 2

    def split(self, name: str) -> tuple[str, ...]:
        got = self.known.get(name)
        if got is None:
            # Names can be long; the best split up to each letter is enough.
            best: list[tuple[float, int]] = [(0.0, 0)]
            for end in range(1, len(name) + 1):
                options = [(best[end - 1][0] + self.letter, end - 1)]
                for start in range(max(0, end - LONGEST), end):
                    c = self.cost.get(name[start:end])
                    if c is not None:
                        options.append((best[start][0] + c, start))
                best.append(min(options))
            words, end = [], len(name)
            while end:
                start = best[end][1]
                words.append(name[start:end])
                end = start
            got = self._joined(words[::-1])
            if len(name) <= 64:
                if len(self.known) > 100_000:
                    self.known.clear()
                self.known[name] = got
        return got

    def _joined(self, words: list[str]) -> tuple[str, ...]:
        """Letters that no word covers, put together again."""
        out: list[str] = []
        loose = False
        for w in words:
            if w not in self.cost:
                out[-1:] = [out[-1] + w] if loose else [*out[-1:], w]
                loose = True
            else:
                out.append(w)
                loose = False
        return tuple(out)

    def tokens(self, host: str, path: str) -> list[str]:
        out = []
        for part, text in (("h:", host), ("p:", path.lower())):
            for piece in re.findall(r"[a-z]+|[0-9]+|[^\x00-\x7f]+", text):
                if piece[0].isascii() and piece[0].isdigit():
                    out.append(part + NUMBER)
                else:
                    out.extend(part + w for w in self.split(piece))
        return out


def is_example(tokens: list[str]) -> bool:
    return any(t[2:] in SEEDS for t in tokens)


@dataclass
class Bayes:
    """Multinomial naive Bayes with add-one smoothing."""

    counts: dict[str, dict[str, int]]
    urls: dict[str, int]

    def __post_init__(self):
        tokens = set(self.counts["allow"]) | set(self.counts["block"]) | {OTHER}
        sums = {c: sum(self.counts[c].values()) + len(tokens) for c in ("allow", "block")}
        self.weight = {t: math.log((self.counts["block"].get(t, 0) + 1) / sums["block"])
                       - math.log((self.counts["allow"].get(t, 0) + 1) / sums["allow"]) for t in tokens}
        self.prior = math.log((self.urls.get("block", 0) + 1) / (self.urls.get("allow", 0) + 1))

    def log_odds(self, tokens: list[str]) -> float:
        """Of ``block`` against ``allow``."""
        other = self.weight[OTHER]
        return self.prior + sum(self.weight.get(t, other) for t in tokens)


def fit(pages: DataFrame, url: str = "url", html: str = "html", share: float = SHARE) -> tuple[Splitter, Bayes]:
    """Both models, from all rows."""
    splitter = Splitter(frequent(word_counts(pages, html), share))
    host, path = host_and_path(F.col(f"`{url}`"))

    def run(batches):
        for b in batches:
            out = []
            for h, p in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                tokens = splitter.tokens(h, p)
                kind = "block" if is_example(tokens) else "allow"
                out.append((kind, ["", *tokens]))
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in out], pa.string()),
                                              pa.array([t for _, t in out], pa.list_(pa.string()))],
                                             names=["kind", "tokens"])

    # The empty token stands once for each url and counts them.
    counts = (pages.select(host.alias("host"), path.alias("path"))
              .mapInArrow(run, "kind string, tokens array<string>")
              .select("kind", F.explode("tokens").alias("token"))
              .groupBy("token", "kind").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("token").pivot("kind", ["allow", "block"]).agg(F.sum("n")).na.fill(0)
              .select("token", "allow", "block", (F.col("allow") + F.col("block")).alias("n")))
    sums = counts.where("token != ''").agg(F.sum("allow"), F.sum("block"), F.sum("n")).first()
    keep = counts.where((F.col("token") == "") | (F.col("n") >= max(1, math.ceil((sums[2] or 0) * share)))).collect()
    urls = next(({"allow": r.allow, "block": r.block} for r in keep if r.token == ""), {})
    by = {c: {r.token: r[c] for r in keep if r.token and r[c]} for c in ("allow", "block")}
    for i, c in enumerate(("allow", "block")):
        by[c][OTHER] = (sums[i] or 0) - sum(by[c].values())
    return splitter, Bayes(by, urls)


def judge(pages: DataFrame, rules: list[tuple[str, str]], models: tuple[Splitter, Bayes],
          url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule, verdict and log_odds (of the method)."""
    added = ("host", "path", "rule", "verdict", "log_odds")
    host, path = host_and_path(F.col(f"`{url}`"))
    splitter, bayes = models
    said = pages.sparkSession.sparkContext.broadcast((splitter, bayes))

    @F.pandas_udf("double")
    def log_odds(h, p):
        import pandas as pd
        s, b = said.value
        return pd.Series([b.log_odds(s.tokens(x, y)) for x, y in zip(h, p)], dtype="float64")

    keep = [F.col(f"`{c}`") for c in pages.columns if c not in added]
    parsed = pages.select(*keep, host.alias("host"), path.alias("path"))
    scored = parsed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)) \
        .withColumn("log_odds", log_odds("host", "path"))
    by_rule = F.lit(None).cast("string")
    for verdict, text in rules:
        by_rule = F.when(F.col("rule") == text, F.lit(verdict)).otherwise(by_rule)
    verdict = F.coalesce(by_rule, F.when(F.col("log_odds") > 0, "block").otherwise("allow"))
    return scored.withColumn("verdict", verdict)
