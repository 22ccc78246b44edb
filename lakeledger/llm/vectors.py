"""Near duplicates among embeddings, by cross-polytope hashing.

A hash rotates a vector at random (three rounds of random signs and the fast
Hadamard transform) and takes the axis, with its sign, that the result is
closest to.  ``hashes`` of them make a bucket; each of several tables stores a
vector in its own bucket and asks that and the next best ones (multiprobe).
Pairs that meet are verified by their cosine in double precision, so no link
is wrong; the chance to miss one at cosine 0.9 is under one in a thousand.
The number of hashes grows with the logarithm of the input, so that vectors
meet by chance in few buckets, and tables and probes grow with it.

Equal vectors are reduced to one first.  Buckets are streamed in sorted order
with constant memory.  Vectors of a bucket with few owners are paired one by
one; a fuller one gives a star.  What stars connect may have no more in common
than a direction, as all vectors of a model may.  The square of the length of
their mean tells: it is the mean of all their cosines.  Under ``TIGHT`` they are
hashed anew around their mean (with ``AGAIN`` times the tables, as what is left of
near vectors is less alike), and only what is in a star then too goes on with the
tight ones: these are compared block by block, each pair of blocks in its own
task, which returns counts and spanning links and not the pairs.

Defined results: vectors that are null, empty, zero, or hold null or
non-finite components link with nothing, as do vectors of different lengths
with each other.  Rows count as vectors even if they share an id; a row
without an id takes part in ``n_links`` of others, but is no component's name.
Vectors of any length are hashed and compared whole.  Other columns play no part,
whatever their names.  An empty table gives an empty result.
"""

from __future__ import annotations

import functools
import itertools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.components import components
from lakeledger.llm.jaccard import EXACT, INDEX, meetings
from lakeledger.llm.util import cut

#: Least cosine of a link.
COSINE = 0.9
#: Vectors in a block.
BLOCK = 512
#: Axes of a hash that probes consider.
AXES = 3
#: Mean cosine from which vectors that stars connect are compared at once;
#: tables for those that are hashed again, as a multiple.
TIGHT, AGAIN = 0.8, 2


def shape(n: int, dim: int) -> tuple[int, int, int]:
    """Hashes of a bucket, tables and probes for n vectors of a dimension."""
    axes = 2 * (1 << max(1, math.ceil(math.log2(max(2, dim)))))
    hashes = max(2, math.ceil(math.log(32 * max(n, 1 << 15)) / math.log(axes)))
    more = max(0, hashes - 3)
    return hashes, 16 + 16 * more, 6 * 2 ** more


@functools.lru_cache(8)
def _signs(dim: int, tables: int, hashes: int) -> np.ndarray:
    wide = 1 << max(1, math.ceil(math.log2(max(2, dim))))
    return np.random.default_rng([dim, 77]).choice([-1.0, 1.0], (tables, hashes, 3, wide))


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast transform of the rows; their length is a power of two."""
    wide, h = x.shape[1], 1
    while h < wide:
        x = x.reshape(len(x), -1, 2, h)
        x = np.stack([x[:, :, 0] + x[:, :, 1], x[:, :, 0] - x[:, :, 1]], 2).reshape(len(x), wide)
        h *= 2
    return x / math.sqrt(wide)


def buckets(x: np.ndarray, tables: int, hashes: int, probes: int) -> np.ndarray:
    """[vector, table, probe]: 61-bit names of buckets, the own one first."""
    dim = x.shape[1]
    signs = _signs(dim, tables, hashes)
    padded = np.zeros((len(x), signs.shape[-1]))
    padded[:, :dim] = x
    axes = min(AXES, padded.shape[1])
    choices = np.array(list(itertools.product(range(axes), repeat=hashes)))
    out = np.zeros((len(x), tables, min(probes, len(choices))), np.uint64)
    for t in range(tables):
        code, cost = 0, 0.0
        for k in range(hashes):
            y = padded
            for s in signs[t, k]:
                y = hadamard(y * s)
            size = np.abs(y)
            top = np.argpartition(-size, axes - 1, axis=1)[:, :axes]
            top = np.take_along_axis(top, np.argsort(-np.take_along_axis(size, top, 1), axis=1, kind="stable"), 1)
            value = np.take_along_axis(y, top, 1)
            axis = (top * 2 + (value > 0)).astype(np.uint64)
            loss = (np.abs(value[:, :1]) - np.abs(value)) ** 2
            code = code * np.uint64(2 * padded.shape[1]) + axis[:, choices[:, k]] if k else axis[:, choices[:, k]]
            cost = cost + loss[:, choices[:, k]]
        pick = np.argsort(cost, axis=1, kind="stable")[:, :out.shape[2]]
        name = np.take_along_axis(code, pick, 1) + np.uint64((t * 0x9E3779B97F4A7C15 + dim * 0x85EBCA77C2B2AE63) % 2 ** 64)
        for _ in range(2):
            name = (name ^ (name >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        out[:, t] = name >> np.uint64(3)
    return out


def _matrix(column) -> np.ndarray:
    """Unit rows from a list of vectors of one length."""
    x = np.array(column.to_pylist() if hasattr(column, "to_pylist") else column, np.float64)
    # Scaled first: neither huge nor tiny components over- or underflow.
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _pairs(reps: DataFrame, n: int, centred: bool = False) -> DataFrame:
    """(a, b, star) of vectors that share a bucket; if ``centred``, of those
    of one cluster, hashed around its mean (columns cluster and mean)."""
    def run(batches):
        for batch in batches:
            vectors = batch.column(1).to_pylist()
            ids = batch.column(0).to_numpy()
            lengths = np.array([len(v) for v in vectors])
            for dim in np.unique(lengths):
                mine = np.flatnonzero(lengths == dim)
                hashes, tables, probes = shape(n, int(dim))
                for at in range(0, len(mine), 1000):
                    part = mine[at:at + 1000]
                    x = _matrix([vectors[i] for i in part])
                    if centred:
                        means = batch.column(3)
                        x = x - np.array([means[i].as_py() for i in part.tolist()])
                        names = buckets(x, AGAIN * tables, hashes, probes)
                        own = batch.column(2).to_numpy()[part].view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                        names = (names ^ own[:, None, None]) >> np.uint64(3)
                    else:
                        names = buckets(x, tables, hashes, probes)
                    kind = np.full(names.shape, INDEX, np.uint64)
                    kind[:, :, 0] = EXACT
                    key = ((names << np.uint64(3)) | kind).ravel().view(np.int64)
                    id_ = np.repeat(ids[part], names.shape[1] * names.shape[2])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(key), pa.array(id_), pa.array(np.zeros(len(key), bool))], names=["key", "id", "sure"])

    columns = ["rid", "v", "cluster", "mean"] if centred else ["rid", "v"]
    entries = reps.select(*columns).mapInArrow(run, "key long, id long, sure boolean")
    return meetings(entries).select("a", "b", "star")


def _means(members: DataFrame) -> DataFrame:
    """(cluster, mean, cosine): the mean of the unit vectors of a cluster, and
    the mean of all their cosines (their lengths are equal)."""
    def run(batches):
        for b in batches:
            vectors = b.column(1).to_pylist()
            lengths = np.array([len(v) for v in vectors])
            for dim in np.unique(lengths):
                at = np.flatnonzero(lengths == dim)
                x = _matrix([vectors[i] for i in at])
                which, number = np.unique(b.column(0).to_numpy()[at], return_inverse=True)
                total = np.zeros((len(which), int(dim)))
                np.add.at(total, number, x)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(which), pa.array(np.bincount(number)), pa.array(total.tolist(), pa.list_(pa.float64()))],
                    names=["cluster", "n", "total"])

    # One sum for each cluster and batch leaves a task.
    parts = members.select("cluster", "v").mapInArrow(run, "cluster long, n long, total array<double>")
    each = parts.select("cluster", "n", F.posexplode("total").alias("at", "x")).groupBy("cluster", "at").agg(
        (F.sum("x") / F.sum("n")).alias("x"))
    # Sums of doubles differ in their last places from run to run; buckets should not.
    mean = F.transform(F.array_sort(F.collect_list(F.struct("at", "x"))), lambda p: F.round(p["x"], 6))
    return each.groupBy("cluster").agg(mean.alias("mean"), F.sum(F.col("x") * F.col("x")).alias("cosine"))


def _tight(stars: DataFrame, reps: DataFrame, n: int) -> tuple[DataFrame, DataFrame]:
    """Stars of vectors that are alike, and pairs of those that are less so and
    meet again around their mean."""
    cluster = components(stars).select(F.col("node").alias("rid"), F.col("component").alias("cluster"))
    members = cut(cluster.join(reps.select("rid", "v"), "rid"))
    means = cut(_means(members))
    edges = stars.join(members.select(F.col("rid").alias("a"), "cluster"), "a")
    tight = edges.join(means.where(F.col("cosine") >= TIGHT).select("cluster"), "cluster", "left_semi").select("a", "b")
    loose = means.where(F.col("cosine") < TIGHT).select("cluster", "mean")
    if loose.isEmpty():
        return tight, stars.limit(0).select("a", "b")
    again = cut(_pairs(members.join(loose, "cluster"), n, centred=True))
    return tight.unionByName(again.where("star").select("a", "b")), again.where("not star").select("a", "b")


def _verified(pairs: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    def run(batches):
        for b in batches:
            x, y = b.column(2).to_pylist(), b.column(3).to_pylist()
            keep = np.zeros(len(x), bool)
            dims = np.array([len(v) for v in x])
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                keep[at] = (_matrix([x[i] for i in at]) * _matrix([y[i] for i in at])).sum(1) >= least
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(pa.array(keep))

    return (pairs.join(reps.select(F.col("rid").alias("a"), F.col("v").alias("va")), "a")
            .join(reps.select(F.col("rid").alias("b"), F.col("v").alias("vb")), "b")
            .select("a", "b", "va", "vb").mapInArrow(run, "a long, b long"))


def _clustered(cluster: DataFrame, reps: DataFrame, least: float) -> DataFrame:
    """(a, b, links): within each cluster all pairs are compared; links
    counts the other rows that a links with in this pair of blocks, b is one
    of the vectors a is connected with."""
    size = cluster.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    placed = cluster.join(size, "cluster").withColumn("mine", F.pmod(F.xxhash64("rid"), F.col("blocks")).cast("int"))
    cells = placed.select("cluster", "rid", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")) \
        .select("cluster", "rid", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))

    def run(t):
        i, j, mine = (t.column(c).to_numpy() for c in ("i", "j", "mine"))
        ids, copies = t.column("rid").to_numpy(), t.column("copies").to_numpy()
        x = _matrix(t.column("v"))
        near = x @ x.T >= least
        np.fill_diagonal(near, False)
        if i[0] != j[0]:
            near &= mine[:, None] != mine[None, :]
        links = near @ copies
        # The smallest vector connected with each, by passing minima on.
        low = np.arange(len(ids))
        while True:
            new = np.minimum(low, np.where(near, low[None, :], len(ids)).min(1, initial=len(ids)))
            new = np.minimum(new, new[new])
            if (new == low).all():
                break
            low = new
        some = links > 0
        return pa.table({"a": pa.array(ids[some]), "b": pa.array(ids[low][some]), "links": pa.array(links[some])})

    return (cells.join(reps.select("rid", "v", "copies"), "rid").groupBy("cluster", "i", "j")
            .applyInArrow(run, "a long, b long, links long"))


def near_duplicates(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding",
                    least: float = COSINE) -> DataFrame:
    """One row for each row of ``df``: vec_id, n_links, component_id, kept."""
    v = F.col(f"`{vector}`").cast("array<double>")
    valid = F.coalesce((F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                       & F.exists(v, lambda x: x != 0), F.lit(False))
    rows = df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), F.when(valid, v).alias("v"))
    rows = rows.withColumn("digest", F.sha2(F.to_json(F.struct("v")).cast("binary"), 256))
    reps = cut(rows.where("v is not null").groupBy("digest").agg(
        F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"), F.first("v").alias("v"))
        .withColumn("rid", F.monotonically_increasing_id()))
    n = reps.count()
    pairs = cut(_pairs(reps, n))
    stars, single = pairs.where("star").select("a", "b"), pairs.select("a", "b")
    found = None
    if not stars.isEmpty():
        stars, more = _tight(stars, reps, n)
        stars, single = cut(stars), single.unionByName(more)
    single = single.distinct()
    if not stars.isEmpty():
        cluster = cut(components(stars).select(F.col("node").alias("rid"), F.col("component").alias("cluster")))
        side = lambda c: cluster.select(F.col("rid").alias(c), F.col("cluster").alias(f"c{c}"))
        single = (single.join(side("a"), "a", "left").join(side("b"), "b", "left")
                  .where("not coalesce(ca = cb, false)").select("a", "b"))
        found = cut(_clustered(cluster, reps, least))
    links = cut(_verified(single, reps, least))
    copies = reps.select(F.col("rid").alias("b"), "copies")
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    counts = both.join(copies, "b").select("a", F.col("copies").alias("links"))
    edges = links
    if found is not None:
        counts = counts.unionByName(found.select("a", "links"))
        edges = edges.unionByName(found.select("a", "b"))
    counts = counts.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "rid")
    group = components(edges).withColumnRenamed("node", "rid")
    each = (reps.select("rid", "digest", "low", "copies").join(group, "rid", "left").join(counts, "rid", "left")
            .withColumn("component", F.coalesce("component", "rid")))
    lowest = each.groupBy("component").agg(F.min("low").alias("component_id"))
    each = each.join(lowest, "component").select(
        "digest", "component_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = rows.select("vec_id", F.when(F.col("v").isNotNull(), F.col("digest")).alias("digest")).join(
        each, "digest", "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
                      component.alias("component_id"), F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
