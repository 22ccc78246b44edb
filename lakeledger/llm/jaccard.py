"""Set similarity join on word shingles, by partition and pigeonhole.

A text's set holds its distinct 5-word shingles as 64-bit hashes.  Sets whose
Jaccard similarity is at least 0.8 differ in at most a quarter of the smaller
one's size.  Sizes are cut into bands; in the space of a band (its sets, and
those up to 1 / 0.8 larger) the universe of hashes is cut into m segments, and
the part of a set in a segment is one key.  d of the segments also index all
parts with one hash deleted.  If a set probes parts exactly (worth 1) and
parts with deletions (worth 2) for a total above the largest possible
difference H, one probe must meet any similar set: otherwise each probed part
would differ by at least its worth.

Allocation by cost: m and d are those with the fewest keys for which a set
almost never lacks parts that are not empty.  A set probes its largest parts
first (their keys are the rarest), then deletions of its smallest, and empty
parts, which many sets share, only when nothing else is left.

Keys are sorted within partitions and streamed, so a key of any number of sets
takes constant memory.  Up to ``FEW`` probes of one key are paired with all
they meet.  A key with more gives a star around its smallest id.  The sets that
stars connect meet once more, in the rarest of their own hashes (an exact prefix
filter), so that a passage that many texts share brings none of them together;
what is still in a star after that is much alike.  A sketch of
one bit for about each hash (the parity of the hashes in a cell) bounds the
difference of two sets from below: pairs it rules out go, and the sets that
stars connect are compared by it.  What may still be similar forms clusters.
Their sets are read again, shuffled once by cluster, and all pairs in a
cluster are verified on the whole sets.  A cluster of more than ``BLOCK`` sets
is cut into blocks, for sketches and for sets alike: first each block with
itself and with the first one, three rows a set; only pairs of blocks that are
not in one component after that are compared too.  Spanning links, not pairs,
leave a task.

Defined results: null, empty and blank texts have no set and link with
nothing; fewer words than a shingle are one shingle.  Rows that share an id
are one document with several versions, any of which may link it; rows without
an id link with nothing and have no component.  Texts of any length are read
whole; other columns play no part, whatever their names.  Two different shingles are
taken for one only if their 64-bit hashes collide inside one pair of texts.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeledger.llm.components import components
from lakeledger.llm.util import claim, cut

#: Words of a shingle; similarity as a ratio of whole numbers.
WORDS, NUM, DEN = 5, 80, 100
#: Ratio of the sizes that begin neighbouring bands.
BAND = 1.5
#: Probes of one key that are paired one by one; sets in a block.
FEW, BLOCK = 8, 256
#: Ids up to which the documents to read again are sent to every task.
SEND = 1_000_000

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5,
                 0x85EBCA77C2B2AE63], np.uint64)

# Kinds of a key, probes first: exact with deletions, deletion; exact; then index only.
EXACT2, DELETED2, EXACT, INDEX, DELETED = range(5)


_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def _mix(x: np.ndarray) -> np.ndarray:
    for _ in range(2):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class _Powers:
    """Powers of an odd number and of its inverse modulo 2^64, as many as the
    longest text so far has bytes."""

    def __init__(self, base: int):
        self.bases = base, pow(base, -1, 2 ** 64)
        self.up, self.down = self._first(4096)

    def _first(self, n: int) -> list[np.ndarray]:
        out = []
        for base in self.bases:
            p = np.ones(1, np.uint64)
            while len(p) < n:
                p = np.concatenate([p, p * np.uint64(pow(base, len(p), 2 ** 64))])
            out.append(p)
        return out

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            self.up, self.down = self._first(n)
        return self.up, self.down


_POWERS = _Powers(0xA24BAED4963EE407)


def word_hashes(raw: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word of a text's bytes: a polynomial in the
    bytes, from differences of running sums, then mixed with the length."""
    inside = ~_SPACE[raw]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False]))))
    start, end = edges[::2], edges[1::2]
    up, down = _POWERS.get(len(raw))
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((raw.astype(np.uint64) + np.uint64(1)) * up[:len(raw)], out=sums[1:])
    return _mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * _ODD[0])


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    raw = np.frombuffer((text or "").encode("utf-8", "replace").lower(), np.uint8)  # ASCII letters only
    h = word_hashes(raw)
    if not len(h):
        return np.zeros(0, np.uint64)
    width = min(WORDS, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        out += h[i:len(h) - width + 1 + i] * _ODD[i]
    out = np.sort(_mix(out))
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if not len(small) or len(small) * DEN < len(large) * NUM:
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return DEN * both >= NUM * (len(a) + len(b) - both)


def most_different(n: int, partner: int) -> int:
    """Most hashes in which similar sets of these sizes differ."""
    return (DEN - NUM) * (n + partner) // (DEN + NUM)


def largest_partner(n: int) -> int:
    return n * DEN // NUM


@functools.lru_cache(None)
def band_start(k: int) -> int:
    return 1 if k == 0 else max(band_start(k - 1) + 1, math.ceil(BAND ** k))


def band_of(n: int) -> int:
    k = max(0, int(math.log(n, BAND)) - 2)
    while band_start(k + 1) <= n:
        k += 1
    return k


def _lacking(m: int, d: int, n: int, need: int) -> float:
    """About the chance that empty parts leave a set of n short of ``need``."""
    spare = m + d - need
    if spare < 0:
        return 1.0
    mean = m * math.exp(-n / m)
    allowed = spare // 2 if d else spare
    term = total = math.exp(-mean)
    for i in range(1, allowed + 1):
        term *= mean / i
        total += term
    return max(0.0, 1 - total)


@functools.lru_cache(None)
def allocation(k: int) -> tuple[int, int]:
    """Segments of a band's space, and how many of them index deletions: the
    cheapest choice in keys for a set of the band's largest size."""
    low, high = band_start(k), band_start(k + 1) - 1
    best = None
    need = most_different(high, largest_partner(high)) + 1
    need_low = most_different(low, largest_partner(low)) + 1
    for share in (0.0, 0.03, 0.06, 0.12, 0.25, 0.5, 1.0):
        m = max(1, math.ceil(need / (1 + share)))
        for _ in range(400):
            d = min(m, math.ceil(share * m))
            if max(_lacking(m, d, high, need), _lacking(m, d, low, need_low)) < 1e-5:
                cost = m + d * high / m
                if best is None or cost < best[0]:
                    best = (cost, m, d)
                break
            m += max(1, m // 100)
            if m > 2 * high + 2:
                break
    if best is None:  # tiny sets: all segments with deletions
        m = max(1, math.ceil(need / 2))
        best = (0, m, m)
    return best[1], best[2]


def keys_of(z: np.ndarray) -> np.ndarray:
    """Keys of a set: 61 bits of hash, 3 bits of kind."""
    n, out = len(z), []
    own, first = band_of(n), band_of(-(-n * NUM // DEN))
    for k in range(first, own + 1):
        m, d = allocation(k)
        segment = (z % np.uint64(m)).astype(np.int64)
        counts = np.bincount(segment, minlength=m)
        order = np.argsort(segment, kind="stable")
        ends = np.concatenate([np.zeros(1, np.uint64), np.cumsum(z[order], dtype=np.uint64)])
        stop = np.cumsum(counts)
        sums = ends[stop] - ends[stop - counts]  # of each part, modulo 2^64
        salt = np.arange(m, dtype=np.uint64) * _ODD[1] + np.uint64((k + 1) * int(_ODD[2]) % 2 ** 64)
        exact = _mix(sums + salt)
        kind = np.full(m, INDEX, np.uint64)
        deletions = np.zeros(m, bool)
        if k == own:  # only the smaller set of a pair has to probe
            need = most_different(n, largest_partner(n)) + 1
            full = np.flatnonzero(counts)
            chosen = full[np.argsort(-counts[full], kind="stable")[:need]]
            kind[chosen] = EXACT
            need -= len(chosen)
            if need > 0:
                upgrade = full[full < d]
                upgrade = upgrade[np.argsort(counts[upgrade], kind="stable")[:need]]
                kind[upgrade], deletions[upgrade] = EXACT2, True
                need -= len(upgrade)
            if need > 0:
                empty = np.flatnonzero(counts == 0)
                # An empty part is worth 1, or 2 with the parts of one hash.
                plain = empty[:need]
                kind[plain] = EXACT
                need -= len(plain)
                kind[plain[plain < d][:max(0, need)]] = EXACT2
        out.append((exact << np.uint64(3)) | kind)
        if d:
            part = segment[order]
            with_ = part < d
            gone = _mix(sums[part[with_]] - z[order][with_] + salt[part[with_]])
            out.append((gone << np.uint64(3)) | np.where(deletions[part[with_]], DELETED2, DELETED).astype(np.uint64))
    return np.concatenate(out)


def _pairable(x: int, y: int) -> bool:
    """Whether two kinds of one key are a probe and what it may meet."""
    x, y = min(x, y), max(x, y)
    deleted = (x in (DELETED2, DELETED)) + (y in (DELETED2, DELETED))
    if deleted == 2:
        return False
    if deleted == 1:
        return EXACT2 in (x, y) or DELETED2 in (x, y)
    return x in (EXACT, EXACT2)


_PAIRABLE = [[_pairable(x, y) for y in range(5)] for x in range(5)]


class Meetings:
    """Pairs from a stream of (key, id) sorted by key, then id."""

    def __init__(self):
        self.key, self.probes, self.star = None, [], None
        self.seen: set[tuple[int, int, bool]] = set()
        self.out: list[tuple[int, int, bool]] = []

    def _pair(self, a: int, b: int, star: bool) -> None:
        if a != b:
            p = (min(a, b), max(a, b), star)
            if p not in self.seen:
                if len(self.seen) > 200_000:
                    self.seen.clear()
                self.seen.add(p)
                self.out.append(p)

    def add(self, key: int, kind: int, id_: int) -> None:
        if key != self.key:
            self.key, self.probes, self.star = key, [], None
        if self.star is not None:
            self._pair(self.star, id_, True)
            return
        for k, other in self.probes:
            if _PAIRABLE[k][kind]:
                self._pair(other, id_, False)
        if kind <= EXACT:
            self.probes.append((kind, id_))
            if len(self.probes) > FEW:
                self.star = min(i for _, i in self.probes)
                for _, i in self.probes:
                    self._pair(self.star, i, True)

    def feed(self, keys: np.ndarray, ids: np.ndarray) -> list[tuple[int, int, bool]]:
        hashes = keys >> np.uint64(3)
        same = hashes[1:] == hashes[:-1]
        # Only keys of several entries, and the first and last, matter.
        busy = np.concatenate(([True], same)) | np.concatenate((same, [True]))
        for h, kind, i in zip(hashes[busy].tolist(), (keys[busy] & np.uint64(7)).tolist(), ids[busy].tolist()):
            self.add(h, kind, i)
        out, self.out = self.out, []
        return out


def meetings(entries: DataFrame) -> DataFrame:
    """(a, b, star, sure) from (key, id, sure): pairs of ids that meet in a
    key, its lowest three bits being the kind.  Where sure, key is an id."""
    def meet(batches):
        meetings = Meetings()
        for batch in batches:
            sure = batch.column(2).to_numpy(zero_copy_only=False)
            keys = batch.column(0).to_numpy().view(np.uint64)
            ids = batch.column(1).to_numpy()
            pairs = [(min(a, b), max(a, b), False, True)
                     for a, b in zip(keys[sure].view(np.int64).tolist(), ids[sure].tolist())]
            if not sure.all():
                pairs += [(*p, False) for p in meetings.feed(keys[~sure], ids[~sure])]
            cols = list(zip(*pairs)) if pairs else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.bool_()),
                 pa.array(cols[3], pa.bool_())], names=["a", "b", "star", "sure"])

    # The sort has to bring equal hashes together, probes first.
    h = F.shiftrightunsigned("key", 3)
    n = int(entries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (entries.repartition(n, h, F.when(F.col("sure"), F.col("id")))
            .sortWithinPartitions("sure", h, F.col("key").bitwiseAND(F.lit(7)), "id")
            .mapInArrow(meet, "a long, b long, star boolean, sure boolean").distinct())


def candidates(docs: DataFrame) -> DataFrame:
    """(a, b, star, sure): pairs that may be similar.  ``docs`` has doc_id and
    text.  Equal sets that one task reads are paired at once (sure) and only
    the first of them sends its keys."""
    def emit(batches):
        claim("jaccard")
        first: dict[bytes, int] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                keys, ids = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for i, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    z = shingles(text)
                    if not len(z):
                        continue
                    name = xxhash.xxh3_128_digest(z.tobytes())
                    seen = first.setdefault(name, i)
                    if seen != i:
                        # Kind 7: the key is the equal document's id.
                        keys.append(np.array([seen], np.int64).view(np.uint64))
                        ids.append(np.array([i], np.int64))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(keys.pop().view(np.int64)), pa.array(ids.pop()), pa.array([True])],
                            names=["key", "id", "sure"])
                        continue
                    k = keys_of(z)
                    keys.append(k)
                    ids.append(np.full(len(k), i, np.int64))
                k, i = np.concatenate(keys), np.concatenate(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(k.view(np.int64)), pa.array(i), pa.array(np.zeros(len(k), bool))],
                    names=["key", "id", "sure"])

    entries = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(
        emit, "key long, id long, sure boolean")
    return meetings(entries)


def sketch(z: np.ndarray) -> np.ndarray:
    """Parity of the number of hashes in each of at least len(z) cells (a
    power of two): sets that differ in d hashes have sketches that differ in
    at most d bits.  Halves folded by exclusive or give the next shorter one."""
    cells = 64
    while cells < len(z):
        cells *= 2
    bits = np.bincount((z >> np.uint64(7)).astype(np.int64) & (cells - 1), minlength=cells) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def may_link(left: np.ndarray, left_n: np.ndarray, right: np.ndarray, right_n: np.ndarray) -> np.ndarray:
    """[left, right]: whether sketches of one length each, and the sizes,
    leave a link possible.  The longer sketches are folded."""
    while left.shape[1] > right.shape[1]:
        half = left.shape[1] // 2
        left = left[:, :half] ^ left[:, half:]
    while right.shape[1] > left.shape[1]:
        half = right.shape[1] // 2
        right = right[:, :half] ^ right[:, half:]
    differ = np.zeros((len(left), len(right)), np.int64)
    for w in range(left.shape[1]):
        differ += np.bitwise_count(left[:, w, None] ^ right[None, :, w])
    total = left_n[:, None] + right_n[None, :]
    return (differ <= (DEN - NUM) * total // (DEN + NUM)) & (
        np.minimum(left_n[:, None], right_n[None, :]) * DEN >= np.maximum(left_n[:, None], right_n[None, :]) * NUM)


def sketches(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, sketch) of each row."""
    def run(batches):
        claim("jaccard")
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                sets = [shingles(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([len(z) for z in sets], pa.int64()),
                     pa.array([sketch(z).tobytes() if len(z) else None for z in sets], pa.binary())],
                    names=["doc_id", "n_shingles", "sketch"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_shingles long, sketch binary")


def likely(pairs: DataFrame, known: DataFrame) -> DataFrame:
    """The pairs (a, b) that sizes and sketches leave possible."""
    def run(batches):
        for b in batches:
            na, nb = b.column(2).to_numpy(), b.column(3).to_numpy()
            keep = [len(x) and bool(may_link(
                np.frombuffer(x, np.uint64)[None, :], na[i:i + 1], np.frombuffer(y, np.uint64)[None, :], nb[i:i + 1])[0, 0])
                for i, (x, y) in enumerate(zip(b.column(4).to_pylist(), b.column(5).to_pylist()))]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    known = known.where("doc_id is not null and n_shingles > 0")
    side = lambda c: known.select(F.col("doc_id").alias(c), F.col("n_shingles").alias(f"n{c}"),
                                  F.col("sketch").alias(f"s{c}"))
    near = F.least("na", "nb") * DEN >= F.greatest("na", "nb") * NUM
    return (pairs.join(side("a"), "a").join(side("b"), "b").where(near)
            .select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long"))


def _spanning(ids: list[int], links) -> list[tuple[int, int]]:
    """Of links (i, j) between places in ``ids``, enough to connect the same."""
    root, out = list(range(len(ids))), []

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, j in links:
        a, b = find(i), find(j)
        if a != b:
            root[a] = b
            if ids[i] != ids[j]:
                out.append((ids[i], ids[j]))
    return out


def block_links(sets: list[np.ndarray], ids: list[int], left: int) -> list[tuple[int, int]]:
    """Spanning links among the first ``left`` sets and the others (or among
    all, if there are no others).  Shared hashes are counted for all pairs by
    products of 0/1 matrices, some columns at a time."""
    n = len(sets)
    size = np.array([len(z) for z in sets])
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(n), size)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    new = np.concatenate(([True], flat[1:] != flat[:-1]))
    token = np.cumsum(new) - 1
    shared = np.bincount(token)[token] > 1
    token, owner = token[shared], owner[shared]
    token = np.unique(token, return_inverse=True)[1] if len(token) else token
    count = np.zeros((n, n), np.float32)
    wide = 4096
    edges = np.searchsorted(token, np.arange(0, (int(token[-1]) if len(token) else -1) + wide + 1, wide))
    for x, y in zip(edges[:-1], edges[1:]):
        if y > x:
            m = np.zeros((n, wide), np.float32)
            m[owner[x:y], token[x:y] % wide] = 1
            count += m @ m.T
    linked = DEN * count.astype(np.int64) >= NUM * (size[:, None] + size[None, :] - count.astype(np.int64))
    pairs = zip(*(x.tolist() for x in np.nonzero(np.triu(linked, 1))))
    return _spanning(ids, ((i, j) for i, j in pairs if left == n or (i < left) != (j < left)))


def block_guesses(sizes: np.ndarray, raw: list[bytes], ids: list[int], left: int) -> list[tuple[int, int]]:
    """Spanning pairs that sketches leave possible, like ``block_links``."""
    width = np.array([len(x) for x in raw])
    rows = {w: np.flatnonzero(width == w) for w in np.unique(width)}
    sk = {w: np.stack([np.frombuffer(raw[i], np.uint64) for i in at]) for w, at in rows.items()}
    found = []
    for w, at in rows.items():
        for v, other in rows.items():
            if v <= w <= 4 * v:  # similar sizes have sketches of the same or the next length
                for i, j in zip(*np.nonzero(may_link(sk[w], sizes[at], sk[v], sizes[other]))):
                    x, y = sorted((int(at[i]), int(other[j])))
                    if x != y and (left == len(raw) or (x < left) != (y < left)):
                        found.append((x, y))
    return _spanning(ids, found)


def _placed(cluster: DataFrame) -> DataFrame:
    """(cluster, node, blocks, mine): each set's block of its cluster."""
    size = cluster.groupBy("cluster").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    return cluster.join(size, "cluster").select("cluster", "node", "blocks", F.pmod(
        F.xxhash64("node"), F.col("blocks")).cast("int").alias("mine"))


def _first_cells(placed: DataFrame) -> DataFrame:
    """(cluster, node, mine, i, j): each block with itself and with the first
    one, three rows a set at most on the whole."""
    own = placed.select("cluster", "node", "mine", F.col("mine").alias("i"), F.col("mine").alias("j"))
    to_first = placed.where("mine > 0").select("cluster", "node", "mine", F.lit(0).alias("i"), F.col("mine").alias("j"))
    of_first = placed.where("mine = 0 and blocks > 1").select("cluster", "node", "mine", F.lit(0).alias("i"), F.explode(
        F.sequence(F.lit(1), F.col("blocks") - 1)).alias("j"))
    return own.unionByName(to_first).unionByName(of_first)


def _open_cells(placed: DataFrame, done: DataFrame) -> DataFrame:
    """The other pairs of blocks, but only those whose sets are not all in one
    component of ``done`` (node, component) already."""
    state = placed.join(done, "node", "left").withColumn("component", F.coalesce("component", "node"))
    block = state.groupBy("cluster", "mine").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    apart = block.groupBy("cluster").agg(F.min("low").alias("l"), F.max("high").alias("h"), F.count(F.lit(1)).alias("n"))
    block = cut(block.join(apart.where("l != h and n > 2").select("cluster"), "cluster", "left_semi"))
    one = block.select("cluster", F.col("mine").alias("i"), F.col("low").alias("l1"), F.col("high").alias("h1"))
    two = block.select("cluster", F.col("mine").alias("j"), F.col("low").alias("l2"), F.col("high").alias("h2"))
    pairs = one.join(two, "cluster").where(
        "i > 0 and i < j and not (l1 = h1 and l1 = l2 and l2 = h2)").select("cluster", "i", "j")
    sets = placed.select("cluster", "node", "mine")
    cols = ["cluster", "node", "mine", "i", "j"]
    return cut(sets.join(pairs.withColumn("mine", F.col("i")), ["cluster", "mine"]).select(cols).unionByName(
        sets.join(pairs.withColumn("mine", F.col("j")), ["cluster", "mine"]).select(cols)))


def _connected(cluster: DataFrame, compare, sure: DataFrame | None = None) -> DataFrame:
    """Links (a, b) that ``compare`` finds in cells of blocks, enough to
    connect the sets of a cluster as all pairs would."""
    placed = cut(_placed(cluster))
    links = compare(_first_cells(placed))
    links = cut(links if sure is None else links.unionByName(sure))
    large = placed.where("blocks > 2")
    if large.isEmpty():
        return links
    mine = links.join(large.select(F.col("node").alias("a")), "a", "left_semi")
    rest = _open_cells(large, components(mine))
    return links if rest.isEmpty() else links.unionByName(cut(compare(rest)))


def refined(stars: DataFrame, docs: DataFrame) -> DataFrame:
    """(a, b, star) of the sets that stars connect, by their rarest hashes.

    A hash that many of them share tells little.  With the hashes of every set
    in order of how many of these sets hold them, similar sets share one among
    the first n - 0.8 n + 1; these are the keys they meet in anew."""
    def read(batches):
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                z = [shingles(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([xxhash.xxh3_64_intdigest(x.tobytes()) >> 1 for x in z], pa.int64()),
                     pa.array([x.view(np.int64) for x in z], pa.list_(pa.int64()))], names=["node", "version", "z"])

    nodes = cut(stars.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct())
    wanted = F.broadcast(nodes) if nodes.count() <= SEND else nodes
    sets = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi").mapInArrow(
        read, "node long, version long, z array<long>").dropDuplicates(["node", "version"])
    each = cut(sets.select("node", "version", F.size("z").alias("n"), F.explode("z").alias("h")))
    held = each.groupBy("h").agg(F.count(F.lit(1)).alias("sets"))
    ordered = each.join(held, "h").groupBy("node", "version", "n").agg(
        F.sort_array(F.collect_list(F.struct("sets", "h"))).alias("z"))
    first = F.col("n") - F.ceil(F.col("n") * F.lit(NUM) / F.lit(DEN)).cast("int") + 1
    keys = ordered.select("node", F.explode(F.slice("z", F.lit(1), first)).alias("t")).select(
        F.shiftleft("t.h", 3).bitwiseOR(F.lit(EXACT).cast("bigint")).alias("key"), F.col("node").alias("id"),
        F.lit(False).alias("sure"))
    return meetings(keys).select("a", "b", "star")


def _ordered(table):
    """Places of the left block's rows, then the others'; how many are left."""
    mine, i, j = (table.column(c).to_numpy() for c in ("mine", "i", "j"))
    return np.argsort(mine != i, kind="stable"), int((mine == i).sum()) if i[0] != j[0] else len(mine)


def guesses(stars: DataFrame, known: DataFrame) -> DataFrame:
    """Spanning pairs, possible by their sketches, within each group of sets
    that stars connect."""
    group = components(stars).withColumnRenamed("component", "cluster")
    sk = known.where("doc_id is not null and n_shingles > 0").select(
        F.col("doc_id").alias("node"), "n_shingles", "sketch")

    def run(table):
        order, left = _ordered(table)
        ids = table.column("node").to_numpy()[order].tolist()
        raw = table.column("sketch").to_pylist()
        links = block_guesses(table.column("n_shingles").to_numpy()[order], [raw[k] for k in order], ids, left)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()),
                         "b": pa.array([b for _, b in links], pa.int64())})

    def compare(cells: DataFrame) -> DataFrame:
        return (cells.join(sk, "node").select("cluster", "i", "j", "node", "mine", "n_shingles", "sketch")
                .groupBy("cluster", "i", "j").applyInArrow(run, "a long, b long"))

    return _connected(group, compare)


def exact_links(cells: DataFrame, docs: DataFrame) -> DataFrame:
    """Spanning links among the sets of each cell, verified on whole sets."""
    def read(batches):
        for b in batches:
            for at in range(0, b.num_rows, 200):
                part = b.slice(at, 200)
                z = [shingles(t).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(z, pa.binary())], names=["node", "z"])

    def run(table):
        order, left = _ordered(table)
        ids = table.column("node").to_numpy()[order].tolist()
        z = table.column("z").to_pylist()
        links = block_links([np.frombuffer(z[k], np.uint64) for k in order], ids, left)
        return pa.table({"a": pa.array([a for a, _ in links], pa.int64()),
                         "b": pa.array([b for _, b in links], pa.int64())})

    ids = cut(cells.select("node").distinct())
    wanted = ids.withColumnRenamed("node", "doc_id")
    if ids.count() <= SEND:
        wanted = F.broadcast(wanted)
    sets = docs.select("doc_id", "text").join(wanted, "doc_id", "left_semi").mapInArrow(read, "node long, z binary")
    return (cells.join(sets, "node").select("cluster", "i", "j", "node", "mine", "z")
            .groupBy("cluster", "i", "j").applyInArrow(run, "a long, b long"))


def similar_components(docs: DataFrame, known: DataFrame) -> DataFrame:
    """(node, component) of the documents that link with another; ``known``
    are the sketches of ``docs`` (doc_id, text)."""
    found = cut(candidates(docs))
    pairs = likely(found.where("not sure").select("a", "b").distinct(), known)
    stars = found.where("star").select("a", "b").distinct()
    if not stars.isEmpty():
        again = cut(refined(stars, docs))
        pairs = pairs.unionByName(likely(again.where("not star").select("a", "b").distinct(), known))
        stars = again.where("star").select("a", "b").distinct()
        if not stars.isEmpty():
            pairs = pairs.unionByName(guesses(stars, known))
    sure = found.where("sure").select("a", "b")
    # Rows that share an id make pairs of an id with itself nowhere: the
    # versions of an id are read together.
    cluster = cut(components(pairs).withColumnRenamed("component", "cluster"))
    return components(_connected(cluster, lambda cells: exact_links(cells, docs), sure))


def _own(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


def join(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles and component_id."""
    own = _own(docs, doc_id, text)
    known = cut(sketches(own))
    groups = similar_components(own, known).withColumnRenamed("node", "doc_id")
    return known.select("doc_id", "n_shingles").join(groups, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each component: that with the smallest
    id.  Rows without an id all stay."""
    own = _own(docs, doc_id, text)
    groups = similar_components(own, cut(sketches(own)))
    gone = cut(groups.where("node != component").select(F.col("node").alias("__node")))
    if gone.count() <= SEND:
        gone = F.broadcast(gone)
    return docs.join(gone, docs[doc_id] == gone["__node"], "left_anti")


#: The contract in DuckDB's SQL.
ORACLE = """
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
           'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + least(len(ws), 5) - 1], ' ') AS sh
  FROM (SELECT *, unnest(range(1, len(ws) - least(len(ws), 5) + 2)) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id < b.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 80 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a),
c AS (SELECT a AS doc_id, least(a, min(b)) AS component_id FROM r GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN c ON c.doc_id = d.doc_id
"""
