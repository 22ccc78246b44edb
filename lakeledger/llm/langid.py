"""Language identification by unigram piece models, summed over all
segmentations.

The pieces are those of a fixed public vocabulary that are whole letters, with
or without the space before a word.  Each language has a probability for each
piece.  A word's probability is the sum over all ways to cut it into pieces
(forward algorithm); a text is judged by the product over its words and the
language's prior.  The probabilities are fitted by expectation maximisation:
Spark counts the words of a sample of labelled texts, tasks compute expected
piece counts (forward and backward), and Spark adds them up by language and
piece.  The sample takes about ``PER_LANGUAGE`` texts of each language, by a
hash of the id; the priors count all labelled texts.

Only text and label train; the label, source and id of a row that is judged
play no part.  Words are lower-cased runs of letters of any length; those of
over ``RUN`` letters are summed one by one, rescaled at each letter.

Defined results: null texts and texts without a letter are ``und`` with score
0, and so is everything when nothing is labelled.  Ties go to the language
first in the alphabet.  Rows are judged one by one; repeated rows get repeated
results and an empty table an empty one.  Other columns are kept (``lang_pred`` and
``score`` are replaced).
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from lakeledger.llm.bpe import load_ranks
from lakeledger.llm.util import claim

#: Labelled texts of a language that train, about.
PER_LANGUAGE = 1500
#: Longest word that is summed together with others, without rescaling; letters
#: of longer ones that are looked up at once.
RUN, BLOCK = 32, 4096
#: Rounds of expectation maximisation; added to each piece's expected count.
ROUNDS, ADDED = 3, 0.05
#: Probability of a letter that no piece covers.
FLOOR = 1e-8
#: Words whose probabilities a worker keeps before it starts anew.
KEPT = 600_000

_LETTERS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _LETTERS.findall(text.lower())


def pieces_of(path: str) -> list[str]:
    """The usable pieces of a ``.tiktoken`` vocabulary."""
    out = set()
    for raw in load_ranks(path):
        try:
            s = raw.decode("utf-8")
        except UnicodeDecodeError:
            continue
        if s == s.lower() and re.fullmatch(r" ?[^\W\d_]+| ", s):
            out.add(s)
    return sorted(out)


_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


class Lattice:
    """All cuts of words into pieces, many words at once.

    Pieces are found by 64-bit hashes of their letters, in an open hash table."""

    SLOTS = 1 << 18

    def __init__(self, pieces: list[str]):
        self.number = {p: i + 1 for i, p in enumerate(pieces)}  # 0: not a piece
        self.longest = max(map(len, pieces), default=1)
        self.keys = np.zeros(self.SLOTS, np.uint64)
        self.values = np.zeros(self.SLOTS, np.int32)
        self.probes = 1
        for p, number in self.number.items():
            h = np.zeros(1, np.uint64)
            for c in p:
                h = h * _MULTIPLIER + np.uint64(ord(c) + 1)
            slot, tries = int(self._slot(h)[0]), 1
            while self.values[slot]:
                slot, tries = (slot + 1) % self.SLOTS, tries + 1
            self.keys[slot], self.values[slot] = h[0], number
            self.probes = max(self.probes, tries)

    def _slot(self, h: np.ndarray) -> np.ndarray:
        return (((h ^ (h >> np.uint64(29))) * _MULTIPLIER) >> np.uint64(64 - 18)).astype(np.int64)

    def _find(self, h: np.ndarray) -> np.ndarray:
        slot = self._slot(h)
        out, same = self.values[slot], self.keys[slot] == h
        # Another piece has the slot: look in the next ones.
        open_ = np.flatnonzero(~same & (out != 0))
        out[~same] = 0
        for i in range(1, self.probes):
            if not len(open_):
                break
            at = (slot[open_] + i) % self.SLOTS
            hit = self.keys[at] == h[open_]
            out[open_[hit]] = self.values[at[hit]]
            open_ = open_[~hit & (self.values[at] != 0)]
        return out

    def cuts(self, words: list[str]) -> np.ndarray:
        """[word, end, length - 1] -> number of the piece that ends there;
        -1 for a single letter that is no piece."""
        return self._cuts([" " + w for w in words])

    def _cuts(self, texts: list[str]) -> np.ndarray:
        lengths = np.array([len(t) for t in texts])
        ends = int(lengths.max())
        flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        letters = np.zeros((len(texts), ends), np.uint64)
        inside = np.arange(ends) < lengths[:, None]
        letters[inside] = flat + np.uint64(1)
        longest = min(self.longest, ends)
        out = np.zeros((len(texts), ends + 1, longest), np.int32)
        h = np.zeros_like(letters)
        for k in range(1, longest + 1):
            h = h[:, :ends - k + 1] * _MULTIPLIER + letters[:, k - 1:]
            valid = inside[:, k - 1:]
            found = self._find(h[valid])
            if k == 1:
                found[found == 0] = -1
            out[:, k:, k - 1][valid] = found
        return out

    @staticmethod
    def forward(cuts: np.ndarray, table: np.ndarray) -> np.ndarray:
        """[word, end, ...]: probability of the first letters of each word.
        ``table`` by piece number: row 0 is zero, the last row the floor."""
        n, ends, longest = cuts.shape
        alpha = np.zeros((n, ends, *table.shape[1:]))
        alpha[:, 0] = 1
        for j in range(1, ends):
            for k in range(min(j, longest)):
                alpha[:, j] += alpha[:, j - k - 1] * table[cuts[:, j, k]]
        return alpha

    @staticmethod
    def backward(cuts: np.ndarray, table: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        n, ends, longest = cuts.shape
        beta = np.zeros((n, ends))
        beta[np.arange(n), lengths] = 1
        for j in range(ends - 1, 0, -1):
            for k in range(min(j, longest)):
                beta[:, j - k - 1] += beta[:, j] * table[cuts[:, j, k]]
        return beta

    def _block(self, text: str, at: int) -> np.ndarray:
        """[end - at - 1, length - 1]: the cuts of a long text that end behind
        ``at``, up to ``BLOCK`` of them."""
        first = max(0, at - self.longest + 1)
        return self._cuts([text[first:at + BLOCK]])[0, at - first + 1:]

    def long_forward(self, word: str, table: np.ndarray) -> np.ndarray:
        """[end, ...]: logarithm of the probability of the first letters of a
        word of any length; of the whole word only, if there are languages."""
        text, one = " " + word, table.ndim == 1
        logs = np.zeros(len(text) + 1) if one else np.zeros(table.shape[1])
        last = np.zeros((self.longest, *table.shape[1:]))  # by the newest, which is 1
        last[0] = 1
        for at in range(0, len(text), BLOCK):
            for j, row in enumerate(self._block(text, at), at + 1):
                new = (last[:len(row)] * table[row]).sum(0)
                last[1:] = last[:-1] / new
                last[0] = 1
                if one:
                    logs[j] = logs[j - 1] + np.log(new)
                else:
                    logs += np.log(new)
        return logs

    def long_expected(self, word: str, count: float, table: np.ndarray, out: np.ndarray) -> None:
        """Adds the expected counts of the pieces of a word of any length."""
        text, alpha = " " + word, self.long_forward(word, table)
        beta = np.zeros(len(text) + 1)
        ahead = np.zeros(self.longest + 1)  # by that of the next end, which is 1
        ahead[0] = 1
        with np.errstate(divide="ignore"):
            logs = np.log(table)
        for at in reversed(range(0, len(text), BLOCK)):
            cuts = self._block(text, at)
            for j in range(at + len(cuts), at, -1):
                row = cuts[j - at - 1]
                ahead[1:len(row) + 1] += table[row]
                beta[j - 1] = beta[j] + np.log(ahead[1])
                ahead[:-1] = ahead[1:] / ahead[1]
                ahead[-1] = 0
            ends = np.arange(at + 1, at + len(cuts) + 1)
            for k in range(cuts.shape[1]):
                some = ends > k
                pieces, end = cuts[some, k], ends[some]
                np.add.at(out, pieces, count * np.exp(alpha[end - k - 1] + logs[pieces] + beta[end] - alpha[-1]))


def expected(lattice: Lattice, words: list[str], counts: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Expected count of each piece over all cuts of the words."""
    out = np.zeros(len(table))
    sizes = np.array([len(w) for w in words], np.int64)
    for i in np.flatnonzero(sizes > RUN):
        lattice.long_expected(words[i], counts[i], table, out)
    order = np.argsort(sizes, kind="stable")[:int((sizes <= RUN).sum())]
    for part in np.array_split(order, max(1, len(order) // 2000)):
        if not len(part):
            continue
        chosen = [words[i] for i in part]
        cuts, lengths = lattice.cuts(chosen), np.array([len(w) + 1 for w in chosen])
        alpha, beta = lattice.forward(cuts, table), lattice.backward(cuts, table, lengths)
        weight = counts[part] / alpha[np.arange(len(part)), lengths]
        for j in range(1, cuts.shape[1]):
            for k in range(min(j, cuts.shape[2])):
                at = cuts[:, j, k]
                np.add.at(out, at, weight * alpha[:, j - k - 1] * table[at] * beta[:, j])
    return out


@dataclass
class Model:
    langs: list[str]
    priors: np.ndarray  # logarithms
    pieces: list[str]
    table: np.ndarray  # [piece number, language]
    name: str = ""


class Scorer:
    """Words' log probabilities, kept for a bounded number of words."""

    def __init__(self, model: Model):
        self.model, self.lattice = model, Lattice(model.pieces)
        self.rows: dict[str, int] = {}
        self.logs = np.zeros((1024, len(model.langs)))

    def learn(self, words: list[str]) -> None:
        words.sort(key=len)
        for at in range(0, len(words), 2000):
            part = words[at:at + 2000]
            alpha = self.lattice.forward(self.lattice.cuts(part), self.model.table)
            logs = np.log(alpha[np.arange(len(part)), [len(w) + 1 for w in part]])
            first = len(self.rows)
            while first + len(part) > len(self.logs):
                self.logs = np.concatenate([self.logs, np.zeros_like(self.logs)])
            self.logs[first:first + len(part)] = logs
            self.rows.update((w, first + i) for i, w in enumerate(part))

    def judge(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        split = [words_of(t) if t else [] for t in texts]
        if len(self.rows) >= KEPT:
            self.rows.clear()
        new = {w for ws in split for w in ws if w not in self.rows}
        # Long words are not kept.
        long = {w: self.lattice.long_forward(w, self.model.table) for w in new if len(w) > RUN and self.model.langs}
        new.difference_update(long)
        if new and self.model.langs:
            self.learn(sorted(new))
        for ws in split:
            if not ws or not self.model.langs:
                yield "und", 0.0
                continue
            rows = np.array([self.rows[w] for w in ws if w not in long], np.int64)
            z = self.model.priors + self.logs[rows].sum(0)
            if len(rows) < len(ws):
                z = z + sum(long[w] for w in ws if w in long)
            best = int(z.argmax())
            yield self.model.langs[best], float(1 / np.exp(z - z[best]).sum())


_SCORERS: dict[str, Scorer] = {}


def _scorer(model: Model) -> Scorer:
    """One scorer for each Python worker; it keeps its words over tasks."""
    claim("langid", _SCORERS.clear)
    if model.name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[model.name] = Scorer(model)
    return _SCORERS[model.name]


def held_out(doc_id: Column) -> Column:
    """Rows that never train."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, vocabulary: str, rounds: int = ROUNDS, per_language: int = PER_LANGUAGE) -> Model:
    """Fits on the rows with a language that are not held out."""
    spark = docs.sparkSession
    pieces = pieces_of(vocabulary)
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    langs = sorted(sizes)
    flat = np.zeros((len(pieces) + 2, len(langs)))
    flat[1:-1], flat[-1] = 1 / len(pieces), FLOOR
    if not langs:
        return Model([], np.zeros(0), pieces, flat, uuid.uuid4().hex)
    share = F.lit(0.0)
    for lang, n in sizes.items():
        share = F.when(F.col("lang") == lang, F.lit(min(1.0, per_language / n))).otherwise(share)
    chosen = rows.where(F.pmod(F.xxhash64(F.lit("lang"), "doc_id"), F.lit(1 << 30)) < share * (1 << 30))

    def count(batches):
        for b in batches:
            out = [words_of(t) if t else [] for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.string()))],
                                             names=["lang", "words"])

    words = (chosen.select("lang", F.col("text").cast("string").alias("text"))
             .mapInArrow(count, "lang string, words array<string>")
             .select("lang", F.explode("words").alias("word")).groupBy("lang", "word").count())
    words = words.checkpoint(eager=True)  # read once a round
    table = flat
    for _ in range(rounds):
        said = spark.sparkContext.broadcast(table)

        def expect(batches, said=said):
            lattice, at = Lattice(pieces), {lang: i for i, lang in enumerate(langs)}
            for b in batches:
                lang, word, n = (np.array(c.to_pylist(), dtype=object) for c in b.columns)
                for x in sorted(set(lang)):
                    mine = np.flatnonzero(lang == x)
                    got = expected(lattice, list(word[mine]), n[mine].astype(float), said.value[:, at[x]])
                    some = np.flatnonzero(got[1:-1]) + 1
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x] * len(some), pa.string()), pa.array(some, pa.int64()),
                         pa.array(got[some], pa.float64())], names=["lang", "piece", "n"])

        sums = words.mapInArrow(expect, "lang string, piece long, n double") \
            .groupBy("lang", "piece").agg(F.sum("n").alias("n")).collect()
        table = np.zeros_like(flat)
        table[1:-1] = ADDED
        for r in sums:
            table[r.piece, langs.index(r.lang)] += r.n
        table = np.round(table / table.sum(0), 12)  # tasks add in any order
        table[1:-1] = np.maximum(table[1:-1], FLOOR)
        table[-1] = FLOOR
        said.unpersist()
    priors = np.log(np.array([sizes[x] for x in langs]) / sum(sizes.values()))
    return Model(langs, priors, pieces, table, uuid.uuid4().hex)


def predict(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` without the text, with lang_pred and score (the posterior)."""
    said = docs.sparkSession.sparkContext.broadcast(model)
    keep = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    inner = docs.select(F.col(f"`{text}`").cast("string").alias("__text"), *[F.col(f"`{c}`") for c in keep])

    def run(batches):
        scorer = _scorer(said.value)
        for b in batches:
            for at in range(0, b.num_rows, 512):
                part = b.slice(at, 512)
                got = list(scorer.judge(part.column(0).to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], pa.array([g[0] for g in got], pa.string()),
                     pa.array([g[1] for g in got], pa.float64())], names=[*keep, "lang_pred", "score"])

    return inner.mapInArrow(run, StructType(inner.drop("__text").schema.fields + [
        StructField("lang_pred", StringType()), StructField("score", DoubleType())]))
