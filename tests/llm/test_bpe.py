import hashlib
import random
from array import array

import public_tokenizers
import pytest
import tiktoken

from lakeledger.llm import bpe
from lakeledger.llm.util import prepare

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bpe.load_ranks(PATH)
TIKTOKEN = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(RANKS, PATTERN)


def test_pieces_equal_the_library(encoder):
    rnd, tokens = random.Random(5), list(RANKS)
    for _ in range(3000):
        piece = (b"".join(rnd.choice(tokens) for _ in range(rnd.randint(1, 5))) if rnd.random() < 0.6
                 else bytes(rnd.choice(b"aaabcd e\xc3\xa9\xe2") for _ in range(rnd.randint(1, 30))))
        assert encoder.transducer.encode(piece) == TIKTOKEN._encode_single_piece(piece)


def test_tiny_vocabulary_equals_the_definition():
    ranks = {bytes([b]): b for b in range(256)}
    for i, m in enumerate([b"aa", b"ab", b"ba", b"aab", b"bab", b"aaaa", b"abab"]):
        ranks[m] = 256 + i
    tr = bpe.Transducer(ranks, kept=50)
    rnd = random.Random(1)
    for _ in range(4000):
        piece = bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 60)))
        assert [tr.bytes_of[t] for t in tr.encode(piece)] == ([piece] if piece in ranks else
                                                              bpe.merge_plain(ranks, piece))


@pytest.mark.parametrize("text", ["", " ", "a" * 3000, " " * 2000 + "x", "\n\n\n  a", "!" * 900, "é" * 999,
                                  "tab\t a  b 　c\x1c\x85d", "don't  we'll 12³½ x", "\U0001f600 � á"])
def test_texts_equal_the_library(encoder, text):
    ids = encoder.encode(text)
    assert ids == TIKTOKEN.encode_ordinary(text)
    dec = bpe.Utf8Decoder(encoder.transducer.bytes_of)
    assert dec.decode(ids) == text == "".join(dec.stream(ids))
    assert dec.decode_bytes(ids) == text.encode()


def test_every_code_point_is_split_as_by_the_library(encoder):
    for base in range(0, 0x110000, 4096):
        text = "".join(f"a{chr(c)} {chr(c)}{chr(c)}" for c in range(base, base + 4096) if not 0xD800 <= c < 0xE000)
        assert encoder.encode(text) == TIKTOKEN.encode_ordinary(text)


def test_decoder_keeps_incomplete_and_invalid_bytes():
    dec = bpe.Utf8Decoder({b: bytes([b]) for b in range(256)})
    ids = list("aé€😀".encode())
    assert dec.decode(ids) == "aé€😀"
    assert dec.decode(ids[:-1]).endswith("�") and dec.decode_bytes(ids[:-1]) == bytes(ids[:-1])
    assert dec.decode([0x61, 0xFF, 0x62]) == "a�b" and dec.decode_bytes([0xFF]) == b"\xff"


def test_table_with_nulls_repeats_and_clashing_names(spark):
    prepare(spark)
    rows = [(1, None, "x"), (None, "", None), (2, "hello world", "y"), (2, "hello world", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = bpe.digests(df, PATH, PATTERN).collect()
    assert len(got) == 4
    for r, (doc, text, _) in zip(sorted(got, key=lambda r: (r.doc_id is None, r.doc_id)),
                                 sorted(rows, key=lambda r: (r[0] is None, r[0]))):
        ids = TIKTOKEN.encode_ordinary(text or "")
        assert r.doc_id == doc and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(array("I", ids).tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.digests(df.limit(0), PATH, PATTERN).count() == 0
    assert bpe.encode(df, PATH, PATTERN).select("ids").where("size(ids) = 2").count() == 2
    back = bpe.round_trip(df, PATH, PATTERN)
    assert [f.name for f in back.schema] == ["doc_id", "text", "n_tokens", "ids"]
    assert [r.ids for r in back.where("doc_id = 1").collect()] == [[]]


def test_cut_texts_equal_the_library(encoder):
    rnd = random.Random(7)
    parts = ["Haus", "été", "x", "don't", "'s", "12", "³", "-", "...", "|", "ſt", "日本", "ÿ÷ß", "\x1c", "\x85", "\t",
             " ", "  ", "\n", "\n\n", " \n", ",", "!?", "'", "\u00a0", "_", "e\u0301", "the"]
    small = bpe.Encoder(RANKS, PATTERN, kept=20)
    for _ in range(4000):
        text = "".join(rnd.choice(parts) + rnd.choice(["", " ", " ", "\n"]) for _ in range(rnd.randint(0, 12)))
        assert encoder.encode(text) == small.encode(text) == TIKTOKEN.encode_ordinary(text)


def test_other_patterns_are_not_cut_at_spaces():
    pattern = r"\p{L}+ \p{L}+|\s+|\S"
    own = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=RANKS, special_tokens={})
    for text in ("of the house", "a b, c d", ""):
        assert bpe.Encoder(RANKS, pattern).encode(text) == own.encode_ordinary(text)


def test_letters_and_marks_need_no_pattern():
    enc = bpe.Encoder(RANKS, PATTERN)

    class Counted:
        calls = 0

        def findall(self, text):
            Counted.calls += 1
            return bpe.regex.findall(PATTERN, text)

    enc.pattern = Counted()
    text = "In Häusern, wohnen (sie.\nDann gehen\nalle: fort."
    assert enc.encode(text) == TIKTOKEN.encode_ordinary(text)
    # The first word, and the bracket before letters.
    assert Counted.calls == 2


def test_words_in_use_stay_kept():
    made = []

    def make(s):
        made.append(s)
        return s.encode()

    kept = bpe._Kept(make, 20)
    for i in range(300):
        assert kept["the"] == b"the" and kept[str(i)] == str(i).encode()
        assert len(kept) + len(kept.old) <= 20
    assert made.count("the") == 1


def test_fewer_states_where_the_trie_ends():
    tr = bpe.Transducer(RANKS)
    tr.encode(b" Undeinheitschonnd")
    assert all(tr.inner[path & bpe._NODE] for state in tr.states for path in state)
