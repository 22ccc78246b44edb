from lakeledger.llm import util


def test_claim_empties_the_caches_of_others():
    mine, other = {1: 1}, {2: 2}
    util.claim("other", other.clear)
    util.claim("mine", mine.clear)
    assert mine and not other
    util.claim("mine", mine.clear)
    assert mine
    util.claim("third")
    assert not mine


def test_unused_names():
    assert util.unused("__a", ["b"]) == "__a"
    assert util.unused("__a", ["__A", "__a_"]) == "__a__"
