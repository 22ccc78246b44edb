"""Byte-level BPE: encoding by a lazily determinised transducer, decoding by
an incremental UTF-8 state machine.

Encoding.  A sequence of tokens is the BPE result of its bytes exactly when
every two neighbours stay apart under the merges.  So a string's tokens are
the one path through a nondeterministic transducer whose states are (last
token, partial token in the vocabulary's byte trie).  ``Transducer``
determinises it while it reads: a state is the set of live paths, and each arc
writes the token that ends the segmentation of the bytes read so far.  These
marks lead back from any live path; the tokens on which all live paths agree
are final and are emitted.  Live paths part within the last few tokens, so the
lookahead is bounded.  States and arcs are built when first needed and kept in
a table of bounded size (it is emptied when full; results do not depend on it).

Decoding.  ``Utf8Decoder`` keeps the bytes of the one code point that is not
complete.  A token read in a given pending state always yields the same text
and next state, so its arcs, too, are built once and kept.

Defined results: a null text counts as empty; empty texts give no tokens.
Long texts are read match by match.  Rows are handled one by one: repeated
rows give repeated results, an empty table gives an empty result, and other
columns of the input are not touched.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from lakeledger.llm.util import claim

#: Arcs that a worker keeps before it starts anew (matches: twice, words:
#: half as many).
KEPT = 500_000

#: The trie node in a path.
_NODE = (1 << 24) - 1

#: The pattern that lets texts be cut at spaces.
_CUT_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: A space between two characters that are not white space.
_SINGLE = re.compile(r"(?<=\S) (?=\S)")

#: Letters of Latin-1, then marks of ASCII other than the apostrophe, and the
#: same once more after a line's end.
_PLAIN = re.compile("([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@[-`{-~]+)?"
                    "(?:(\n)([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@[-`{-~]+)?)?")


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge_plain(ranks: dict[bytes, int], piece: bytes, below: int | None = None) -> list[bytes]:
    """The definition: join the neighbours whose union has the lowest rank,
    leftmost first, until none has one (or one under ``below``)."""
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        best = min(((ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks),
                   default=None)
        if best is None or (below is not None and best[0] >= below):
            break
        i = best[1]
        parts[i:i + 2] = [parts[i] + parts[i + 1]]
    return parts


class Transducer:
    """Text bytes to token ids."""

    def __init__(self, ranks: dict[bytes, int], kept: int = KEPT):
        self.ranks, self.kept = ranks, kept
        #: Bytes between two emissions inside one match.
        self.block = 4 * max(map(len, ranks))
        self.bytes_of = {r: b for b, r in ranks.items()}
        self.lengths = {r: len(b) for b, r in ranks.items()}
        # Byte trie of the vocabulary: a node is a number, arcs by node * 256 + byte.
        self.arcs: dict[int, int] = {}
        self.ends: dict[int, int] = {}
        self.depth = [0]
        #: Whether a node has arcs.
        self.inner = bytearray(1)
        for b, r in ranks.items():
            at = 0
            for x in b:
                nxt = self.arcs.get(at << 8 | x)
                if nxt is None:
                    nxt = self.arcs[at << 8 | x] = len(self.depth)
                    self.depth.append(self.depth[at] + 1)
                    self.inner.append(0)
                    self.inner[at] = 1
                at = nxt
            self.ends[at] = r
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.spines: dict[tuple[int, int], list] = {}
        self.made: dict[int, int] = {}
        self.apart: dict[int, bool] = {}
        self._new_table()

    def _new_table(self) -> None:
        # A determinised state: the live paths, earliest start first; a path
        # is (last id + 1) * 2**24 + trie node.
        self.states: list[tuple[int, ...]] = [(0,)]
        self.number = {self.states[0]: 0}
        #: state * 256 + byte -> next state * 2**32 + token.
        self.table: dict[int, int] = {}

    # -- which tokens may stand side by side ---------------------------------

    def _halves(self, t: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``t``; None for single bytes.
        Tokens that merges cannot make have the mark (-1, -1)."""
        if t not in self.halves:
            b = self.bytes_of[t]
            parts = merge_plain(self.ranks, b, below=t) if len(b) > 1 else None
            self.halves[t] = None if parts is None else (
                (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else (-1, -1))
        return self.halves[t]

    def _spine(self, t: int, side: int) -> list[tuple[bytes, float, float]]:
        """Tokens that touch one end of ``t`` while it is built:
        (bytes, rank from which it is there, rank at which it is used up)."""
        key = (t, side)
        if key not in self.spines:
            out, gone = [], float("inf")
            while True:
                halves = self._halves(t)
                out.append((self.bytes_of[t], -1 if halves is None else t, gone))
                if halves is None:
                    break
                t, gone = halves[side], t
            self.spines[key] = out
        return self.spines[key]

    def stay_apart(self, a: int, b: int) -> bool:
        """Whether no merge crosses the border between ``a`` and ``b``."""
        rank = self.ranks.get
        right = self._spine(b, 0)
        for x, from_x, to_x in self._spine(a, 1):
            for y, from_y, to_y in right:
                # Both must be there at one time.
                if from_y < to_x and from_x < to_y:
                    r = rank(x + y)
                    # Both are there before merge r is done; the merge inside
                    # ``a`` stands further left and so goes first on a tie.
                    if r is not None and from_x <= r >= from_y and r < to_x and r <= to_y:
                        return False
        return True

    def _end(self, node: int) -> int:
        """The token that ends at a trie node, if merges can make it; or -1."""
        t = self.made.get(node)
        if t is None:
            t = self.ends.get(node, -1)
            if t >= 0 and self._halves(t) == (-1, -1):
                t = -1
            self.made[node] = t
        return t

    # -- the determinised transducer -----------------------------------------

    def _arc(self, state: int, byte: int) -> int:
        paths, done, step, inner = [], -1, self.arcs.get, self.inner
        for path in self.states[state >> 8]:
            node = step((path & _NODE) << 8 | byte)
            if node is None:
                continue
            last = path & ~_NODE
            # Where the trie ends, the path does with the next byte.
            if inner[node]:
                paths.append(last | node)
            # A string has one segmentation: the first found is the only one.
            if done < 0:
                t = self.made.get(node)
                if t is None:
                    t = self._end(node)
                if t >= 0:
                    apart = not last or self.apart.get(last | t)
                    if apart is None:
                        if len(self.apart) >= self.kept:
                            self.apart.clear()
                        apart = self.apart[last | t] = self.stay_apart((last >> 24) - 1, t)
                    if apart:
                        done = t
        if done < 0:
            raise ValueError("the vocabulary lacks a byte of the text")
        paths.append(done + 1 << 24)
        new = tuple(paths)
        number = self.number.get(new)
        if number is None:
            number = self.number[new] = len(self.states)
            self.states.append(new)
        arc = self.table[state | byte] = number << 32 | done
        return arc

    def encode(self, piece: bytes) -> list[int]:
        """The ids of one match of the splitting pattern."""
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        if len(self.table) >= self.kept:
            self._new_table()
        out: list[int] = []
        state, known, make = 0, self.table.get, self._arc
        marks: list[int] = []  # arcs over the bytes that are not emitted yet
        mark = marks.append
        for at in range(0, len(piece), self.block):
            if at:
                final = self._agreed(state, marks)
                out += self._back(marks, final)
                del marks[:final]
            for byte in piece[at:at + self.block]:
                arc = known(state | byte) or make(state, byte)  # no arc is 0
                state = arc >> 24
                mark(arc)
        return out + self._back(marks, len(marks))

    def _agreed(self, state: int, marks: list[int]) -> int:
        """Up to which byte all live paths have the same tokens."""
        ends = {len(marks) - self.depth[path & _NODE] for path in self.states[state >> 8]}
        while len(ends) > 1:
            last = max(ends)
            ends.remove(last)
            ends.add(last - len(self.bytes_of[marks[last - 1] & 0xFFFFFF]))
        return ends.pop()

    def _back(self, marks: list[int], end: int) -> list[int]:
        out, lengths = [], self.lengths
        while end > 0:
            t = marks[end - 1] & 0xFFFFFF
            out.append(t)
            end -= lengths[t]
        out.reverse()
        return out


class _Kept(dict):
    """Strings already encoded, as little-endian bytes; bounded.  When half of
    the room is full, those of the half before that were not asked for since go."""

    def __init__(self, make, kept: int):
        super().__init__()
        self.make, self.half, self.old = make, max(kept // 2, 1), {}

    def __missing__(self, s: str) -> bytes:
        ids = self.old.get(s)
        if ids is None:
            ids = self.make(s)
        if len(s) <= 64:
            if len(self) >= self.half:
                self.old = dict(self)
                self.clear()
            self[s] = ids
        return ids


class _Beside(Exception):
    """A space that stands beside white space or at an end of the text."""


class Encoder:
    """Texts to ids, each match of the splitting pattern on its own."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, kept: int = KEPT):
        self.pattern = regex.compile(pattern)
        self.cuts = pattern == _CUT_PATTERN
        self.transducer = Transducer(ranks, kept)
        self.matches = _Kept(lambda m: array("I", self.transducer.encode(m.encode("utf-8"))).tobytes(), 2 * kept)
        self.words = _Kept(self._word, kept // 2)

    def _by_pattern(self, text: str) -> bytes:
        return b"".join(map(self.matches.__getitem__, self.pattern.findall(text)))

    def _word(self, word: str) -> bytes:
        """A space and the word after it."""
        plain = _PLAIN.fullmatch(word)
        if plain:
            # One match each: the space and letters, marks, a line's end, letters, marks.
            first, *more = plain.groups()
            ids = self.matches[" " + first]
            for m in more:
                if m:
                    ids += self.matches[m]
            return ids
        if not word or word[0].isspace() or word[-1].isspace():
            raise _Beside
        return self._by_pattern(" " + word)

    def encode_bytes(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers.

        No match of the pattern goes on over a single space that stands
        between two characters that are not white space; it starts there.
        So texts are cut at such spaces first (not for other patterns)."""
        if not self.cuts:
            return self._by_pattern(text)
        word = self.words.__getitem__
        try:
            first, *rest = text.split(" ")
            if not first or first[0].isspace() or first[-1].isspace():
                raise _Beside
            return self._by_pattern(first) + b"".join(map(word, rest))
        except _Beside:
            first, *rest = _SINGLE.split(text)
            if not rest:
                return self._by_pattern(first)
            return self._by_pattern(first) + b"".join(map(word, rest[:-1])) + self._by_pattern(" " + rest[-1])

    def encode(self, text: str) -> list[int]:
        return array("I", self.encode_bytes(text)).tolist()


class Utf8Decoder:
    """Token ids to text, piece by piece.

    The state is the number of a pending, incomplete UTF-8 sequence (0: none).
    Invalid bytes become U+FFFD in the text; ``bytes`` are never changed."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.pending: list[bytes] = [b""]
        self.number = {b"": 0}
        self.arcs: dict[tuple[int, int], tuple[int, str]] = {}
        #: Tokens that are whole code points by themselves.
        self.whole: dict[int, str] = {}

    def _arc(self, state: int, token: int) -> tuple[int, str]:
        decoder = codecs.getincrementaldecoder("utf-8")("replace")
        text = decoder.decode(self.pending[state] + self.bytes_of[token])
        rest = decoder.getstate()[0]
        if rest not in self.number:
            self.number[rest] = len(self.pending)
            self.pending.append(rest)
        if not state and not rest:
            self.whole[token] = text
        arc = self.arcs[state, token] = (self.number[rest], text)
        return arc

    def feed(self, state: int, ids: Iterable[int]) -> tuple[int, list[str]]:
        """The next state, and the text that ``ids`` complete."""
        out, whole, arcs = [], self.whole.get, self.arcs
        for t in ids:
            text = None if state else whole(t)
            if text is None:
                state, text = arcs.get((state, t)) or self._arc(state, t)
            out.append(text)
        return state, out

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Text as soon as its code points are complete."""
        state = 0
        for t in ids:
            state, out = self.feed(state, (t,))
            yield from filter(None, out)
        if state:
            yield "\ufffd"

    def decode(self, ids: Iterable[int]) -> str:
        state, out = self.feed(0, ids)
        return "".join(out) + ("\ufffd" if state else "")

    def decode_bytes(self, ids: Iterable[int]) -> bytes:
        """The bytes of the tokens; those of the streamed text when every
        sequence in it is valid, which is always so after encoding text."""
        ids = list(ids) if not isinstance(ids, (list, array)) else ids
        text = self.decode(ids)
        if "\ufffd" in text:
            return b"".join(map(self.bytes_of.__getitem__, ids))
        return text.encode("utf-8")


_WORKERS: dict[tuple[str, str, int], tuple[Encoder, Utf8Decoder]] = {}


def _worker(name: str, pattern: str, kept: int = KEPT) -> tuple[Encoder, Utf8Decoder]:
    """One encoder and decoder for each Python worker."""
    claim("bpe", _WORKERS.clear)
    if (name, pattern, kept) not in _WORKERS:
        _WORKERS.clear()
        ranks = load_ranks(SparkFiles.get(name))
        enc = Encoder(ranks, pattern, kept)
        _WORKERS[name, pattern, kept] = enc, Utf8Decoder(enc.transducer.bytes_of)
    return _WORKERS[name, pattern, kept]


def send_ranks(spark, path: str) -> str:
    """Sends the vocabulary file to the executors once; its name there."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def _over_text(df: DataFrame, text: str, fields: list[tuple[str, pa.DataType, str]], make,
               drop_text: bool = False) -> DataFrame:
    """``df`` with further columns computed from its text column, batch by
    batch; names that ``df`` already has are replaced."""
    keep = [c for c in df.columns if c not in {f[0] for f in fields} | ({text} if drop_text else set())]
    inner = df.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("__text"),
                      *[F.col(f"`{c}`") for c in keep])
    schema = StructType(inner.drop("__text").schema.fields
                        + [StructField(name, DataType.fromDDL(kind)) for name, _, kind in fields])

    def run(batches):
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                cols = make(part.column(0).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[1:], *[pa.array(c, f[1]) for c, f in zip(cols, fields)]],
                    names=[*keep, *[f[0] for f in fields]])

    return inner.mapInArrow(run, schema)


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of its text (array of int)."""
    name = send_ranks(df.sparkSession, ranks_path)

    def make(texts):
        enc = _worker(name, pattern)[0]
        return [[enc.encode(t) for t in texts]]

    return _over_text(df, text, [(ids, pa.list_(pa.int32()), "array<int>")], make)


def digests(df: DataFrame, ranks_path: str, pattern: str, text: str = "text") -> DataFrame:
    """Encodes, decodes the ids again, and puts n_tokens, ids_sha256 and
    decoded_sha256 in place of the text."""
    name = send_ranks(df.sparkSession, ranks_path)

    def make(texts):
        enc, dec = _worker(name, pattern)
        n, a, b = [], [], []
        for t in texts:
            raw = enc.encode_bytes(t)
            n.append(len(raw) // 4)
            a.append(hashlib.sha256(raw).hexdigest())
            b.append(hashlib.sha256(dec.decode_bytes(array("I", raw))).hexdigest())
        return [n, a, b]

    return _over_text(df, text, [("n_tokens", pa.int64(), "bigint"), ("ids_sha256", pa.string(), "string"),
                                 ("decoded_sha256", pa.string(), "string")], make, drop_text=True)


def round_trip(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids",
               kept: int = KEPT) -> DataFrame:
    """``df`` with the ids of its text and their number in ``n_tokens``; the
    text is what the ids decode to (the same, null as empty).  ``kept`` bounds
    the tables of a worker, which differ in speed alone."""
    name = send_ranks(df.sparkSession, ranks_path)
    order = [c for c in df.columns if c not in ("n_tokens", ids)]

    def make(texts):
        enc, dec = _worker(name, pattern, kept)
        coded = [np.frombuffer(enc.encode_bytes(t), np.uint32).astype(np.int32) for t in texts]
        back = [dec.decode_bytes(i.tolist()).decode("utf-8", "replace") for i in coded]
        return [[len(i) for i in coded], back, coded]

    out = _over_text(df, text, [("n_tokens", pa.int64(), "bigint"), (text, pa.string(), "string"),
                                (ids, pa.list_(pa.int32()), "array<int>")], make)
    return out.select(*[F.col(f"`{c}`") for c in order], "n_tokens", ids)
