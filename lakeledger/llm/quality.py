"""Quality classifier: a factorisation machine over hashed words, structure
statistics and the text's length.

    score = sigmoid(w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2])

The bracket is the sum of all pairwise interactions, so a text is scored in
time linear in its features.  It is trained on at most ``SAMPLE`` labelled
texts, chosen by a hash of their id, whose features (not texts) come to the
driver; a text has at most ``WORDS`` + 12 features, so the size is bounded.
The model has (``FACTORS`` + 1) numbers for each feature and is sent to every
task.  Whole texts are read, in training and in scoring.

Defined results: null and empty texts have no words and are scored by their
statistics.  Rows without a label, or whose label is not 0 or 1, do not
train; with no labels at all every score is 0.5.  Rows are scored one by one;
repeated rows get repeated results and an empty table an empty one; of rows that
share a labelled id one text trains.  Other columns are kept, but for the score's.
"""

from __future__ import annotations

import math
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from lakeledger.llm.util import claim, unused

#: Word buckets, factors of the interactions, bins of a statistic.
WORDS, FACTORS, BINS = 1 << 14, 8, 16
#: Labelled texts that train at most.
SAMPLE = 4000
#: Word hashes that a worker keeps before it starts anew.
KEPT = 250_000

STATISTICS = ("length", "word length", "distinct words", "punctuation", "capitals", "digits", "repeated words",
              "longest repeat", "repeated lines", "bars", "sentence ends", "symbols")
SIZE = WORDS + len(STATISTICS) * BINS


class _Hashes(dict):
    def __missing__(self, word: str) -> int:
        h = zlib.crc32(word.encode("utf-8", "replace"))
        if len(word) <= 64:
            if len(self) >= KEPT:
                self.clear()
            self[word] = h
        return h


_HASHES = _Hashes()


def statistics(text: str, hashes: np.ndarray) -> list[float]:
    """One number for each of STATISTICS, most of them shares from 0 to 1."""
    raw = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), np.uint8), minlength=256)
    size, n = max(1, int(raw.sum())), len(hashes)
    lines = [x for x in text.split("\n") if x]
    capitals, small = int(raw[65:91].sum()), int(raw[97:123].sum())
    digits = int(raw[48:58].sum())
    ascii_marks = int(raw[33:127].sum()) - capitals - small - digits
    same = hashes[1:] == hashes[:-1]
    runs = np.flatnonzero(~np.concatenate(([False], same, [False])))
    longest = int(np.diff(runs).max()) if len(runs) > 1 else 0
    return [
        math.log2(len(text) + 1) / 20,
        len(text) / (n + 1) / 20,
        len(np.unique(hashes)) / n if n else 0.0,
        ascii_marks / size * 4,
        capitals / max(1, capitals + small),
        digits / size * 4,
        float(same.mean()) if n > 1 else 0.0,
        math.log2(longest + 1) / 12,
        1 - len(set(lines)) / len(lines) if lines else 0.0,
        int(raw[124]) / max(1, n),
        int(raw[46] + raw[33] + raw[63]) / max(1, n),
        int(raw[[33, 35, 36, 37, 38, 42, 64, 94, 126]].sum()) / max(1, n) / 2,
    ]


def features(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of a text's features."""
    words = text.lower().split()
    hashes = np.fromiter(map(_HASHES.__getitem__, words), np.int64, len(words))
    buckets = np.unique(hashes & (WORDS - 1))
    stats = np.clip(statistics(text, hashes), 0.0, 1.0)
    # A share of exactly 0 has a bin of its own; small shares are told apart.
    bins = np.where(stats == 0, 0, 1 + np.minimum((np.sqrt(stats) * (BINS - 1)).astype(int), BINS - 2))
    idx = np.concatenate([buckets, WORDS + np.arange(len(bins)) * BINS + bins])
    val = np.concatenate([np.full(len(buckets), 1 / math.sqrt(len(buckets) or 1)), np.full(len(bins), 0.5)])
    return idx, val


@dataclass
class Machine:
    """The factorisation machine."""

    bias: float
    linear: np.ndarray
    factors: np.ndarray

    def score(self, idx: np.ndarray, val: np.ndarray) -> float:
        v = self.factors[idx] * val[:, None]
        pairs = 0.5 * float((v.sum(0) ** 2 - (v ** 2).sum(0)).sum())
        z = self.bias + float(self.linear[idx] @ val) + pairs
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 16, batch: int = 128,
          rate: float = 0.08, decay: float = 2e-4, seed: int = 7) -> Machine:
    """Adagrad on the logistic loss, in batches."""
    rng = np.random.default_rng(seed)
    m = Machine(0.0, np.zeros(SIZE), rng.normal(0, 0.02, (SIZE, FACTORS)))
    labels = np.array([y for *_, y in rows], float)
    if len(rows) == 0 or labels.min() == labels.max():
        return Machine(0.0 if len(rows) == 0 else (4.0 if labels[0] else -4.0), m.linear, np.zeros_like(m.factors))
    g_lin, g_fac, g_bias = np.full(SIZE, 1e-3), np.full((SIZE, FACTORS), 1e-3), 1e-3
    for _ in range(epochs):
        for part in np.array_split(rng.permutation(len(rows)), max(1, len(rows) // batch)):
            idx = np.concatenate([rows[i][0] for i in part])
            val = np.concatenate([rows[i][1] for i in part])
            at = np.concatenate([[0], np.cumsum([len(rows[i][0]) for i in part])[:-1]])
            doc = np.repeat(np.arange(len(part)), [len(rows[i][0]) for i in part])
            v = m.factors[idx] * val[:, None]
            sums = np.add.reduceat(v, at)
            z = (m.bias + np.add.reduceat(m.linear[idx] * val, at)
                 + 0.5 * (sums ** 2 - np.add.reduceat(v ** 2, at)).sum(1))
            err = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels[part]) / len(part)
            each = err[doc] * val
            keys, inverse = np.unique(idx, return_inverse=True)
            d_lin = np.bincount(inverse, each, len(keys)) + decay * m.linear[keys]
            grad = each[:, None] * (sums[doc] - v)
            d_fac = np.stack([np.bincount(inverse, grad[:, f], len(keys)) for f in range(FACTORS)], 1) \
                + decay * m.factors[keys]
            g_bias += err.sum() ** 2
            g_lin[keys] += d_lin ** 2
            g_fac[keys] += d_fac ** 2
            m.bias -= rate * err.sum() / math.sqrt(g_bias)
            m.linear[keys] -= rate * d_lin / np.sqrt(g_lin[keys])
            m.factors[keys] -= rate * d_fac / np.sqrt(g_fac[keys])
    return m


def held_out(doc_id: Column) -> Column:
    """Rows that never train."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", sample: int = SAMPLE) -> Machine:
    """A machine from at most ``sample`` labelled texts that are not held out."""
    chosen = (labels.where(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
              .groupBy("doc_id").agg(F.min(label).alias("__y"))
              .orderBy(F.xxhash64(F.lit("quality"), F.col("doc_id")), "doc_id").limit(sample))

    def run(batches):
        claim("quality", _HASHES.clear)
        for b in batches:
            got = [features(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([i.astype("int32") for i, _ in got], pa.list_(pa.int32())),
                 pa.array([v for _, v in got], pa.list_(pa.float64()))], names=["y", "idx", "val"])

    texts = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    picked = (texts.join(F.broadcast(chosen), "doc_id")  # at most ``sample`` ids
              .groupBy("doc_id", "__y").agg(F.min("text").alias("text"))  # one text of rows that share an id
              .select(F.col("__y").cast("int").alias("y"), "text")
              .mapInArrow(run, "y int, idx array<int>, val array<double>"))
    rows = [(np.array(r.idx), np.array(r.val), r.y) for r in picked.collect()]
    rows.sort(key=lambda r: (r[2], len(r[0]), r[0].tobytes()))  # tasks end in any order
    return train(rows)


def score(docs: DataFrame, machine: Machine, text: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with a score from 0 to 1."""
    said = docs.sparkSession.sparkContext.broadcast(machine)
    keep = [c for c in docs.columns if c != out]
    inner = docs.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"),
                        *[F.col(f"`{c}`") for c in keep])

    def run(batches):
        claim("quality", _HASHES.clear)
        m = said.value
        for b in batches:
            s = [m.score(*features(t.as_py())) for t in b.column(0)]
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(s, pa.float64())], names=[*keep, out])

    return inner.mapInArrow(run, StructType(inner.drop("__text").schema.fields + [StructField(out, DoubleType())]))


def keep_good(docs: DataFrame, machine: Machine, text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` without the rows scored under ``least``."""
    own = unused("__score", docs.columns)
    return score(docs, machine, text, own).where(F.col(own) >= least).drop(own)
