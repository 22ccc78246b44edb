import itertools
import math

from lakeledger.llm import urlfilter as U
from lakeledger.llm.queries import RULES

URLS = {
    None: ("", ""), "": ("", ""), "no scheme/en/": ("", ""), "http://": ("", ""),
    "HTTP://WWW.Example.COM/EN/x?q#f": ("www.example.com", "/EN/x"),
    "https://a.example.com/en/1.html": ("a.example.com", "/en/1.html"),
    "https://www.example.com/en/1": ("www.example.com", "/en/1"),
    "https://m.www.example.com/en/": ("m.www.example.com", "/en/"),
    "https://notexample.com/en/": ("notexample.com", "/en/"),
    "https://example.com": ("example.com", ""), "https://example.com?x=/en/": ("example.com", ""),
    "x://b.net/es/1#t": ("b.net", "/es/1"), "x://net/fr/": ("net", "/fr/"), "x://b.net/de/": ("b.net", "/de/"),
    "a://b://c/d": ("b:", "//c/d"), "http://line\nbreak.com/p\nq": ("line\nbreak.com", "/p\nq"),
    "http://casinowin.org/free": ("casinowin.org", "/free"),
}
RULE = {"HTTP://WWW.Example.COM/EN/x?q#f": "com/", "https://a.example.com/en/1.html": "example.com/en/",
        "https://www.example.com/en/1": "www.example.com/en/", "https://m.www.example.com/en/": "www.example.com/en/",
        "https://notexample.com/en/": "com/", "x://b.net/es/1#t": "net/es/", "x://net/fr/": "net/fr/",
        "http://line\nbreak.com/p\nq": "com/"}


def brute_split(counts, letter, name):
    """Over all splits."""
    total, best = sum(counts.values()), None
    for cuts in itertools.product([0, 1], repeat=max(0, len(name) - 1)):
        words, at = [], 0
        for i, c in enumerate([*cuts, 1]):
            if c:
                words.append(name[at:i + 1])
                at = i + 1
        cost = 0.0
        for w in words:
            cost += math.log(total / counts[w]) if w in counts else (letter if len(w) == 1 else math.inf)
        if best is None or cost < best:
            best = cost
    return best


def test_split_is_the_most_likely_of_all():
    s = U.Splitter({"free": 50, "bet": 40, "bets": 30, "the": 900, "here": 20, "he": 100, "re": 90, "there": 10})
    for name in ("freebets", "thethere", "xfreebet", "hereq", "a", "thereherebets"):
        words = s.split(name)
        assert "".join(words) == name
        cost = sum(s.cost[w] if w in s.cost else s.letter * len(w) for w in words)
        assert math.isclose(cost, brute_split(s.counts, s.letter, name))
    assert s.split("freebets") == ("free", "bets") and s.split("") == ()
    assert len("".join(s.split("the" * 50_000))) == 150_000


def test_hosts_rules_and_verdicts(spark):
    rows = [(i, u, "<p>free casino win the the</p>", "x") for i, u in enumerate(URLS)] + [(99, "", None, "x")] * 2
    rows += [(200 + i, f"http://m.spam-farm.org/en/{i}", "<p>farm the</p>", "x") for i in range(30)]
    rows += [(300 + i, f"http://www.good-site.org/en/{i}", "the site good", "x") for i in range(60)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    models = U.fit(df)
    got = U.judge(df, RULES, models).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.url in URLS:
            assert (r.host, r.path) == URLS[r.url]
            assert r.rule == RULE.get(r.url)
        if r.rule:
            assert r.verdict == dict((t, v) for v, t in RULES)[r.rule]
        else:
            tokens = models[0].tokens(r.host, r.path)
            assert r.verdict == ("block" if models[1].log_odds(tokens) > 0 else "allow")
    by = {r.page_id: r.verdict for r in got}
    assert by[201] == "block" and by[301] == "allow"
    assert by[list(URLS).index("http://casinowin.org/free")] == "block"
    empty = df.limit(0)
    assert U.judge(empty, RULES, U.fit(empty)).count() == 0


def test_word_counts_cover_all_text(spark):
    df = spark.createDataFrame([("<a href='x'>One two</a> two é oné",), (None,)], "html string")
    assert {r.word: r.n for r in U.word_counts(df).collect()} == {"one": 1, "two": 2}
