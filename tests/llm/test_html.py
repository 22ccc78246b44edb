import html
import re

import pytest

from lakeledger.llm import html_extract as H
from lakeledger.llm.queries import op4_html

SF = "/root/testdata/sf0.01"
LONG = "This paragraph is long enough to count, has commas, and says something about the matter at hand. " * 2
LONG = LONG.strip()
P1, P2 = LONG, LONG.replace("matter", "second point")


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{body}</body></html>"


CASES = {
    "plain": (f"<div id=content><h1>Title</h1><p>{P1}</p><p>{P2}</p></div>", f"Title\n{P1}\n{P2}"),
    "around": (f"<header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a></li></ul></nav><div class='sidebar'><p>{P2}"
               f"</p></div><article><p>{P1}</p><p>{P2}</p></article><aside><p>{P1}</p></aside><footer><p>{P1}</p></footer>",
               f"{P1}\n{P2}"),
    "comments": (f"<article><p>{P1}</p><p>{P2}</p></article><div id='comments'><div class=comment><p>{P1}</p><p>{P1}</p>"
                 f"<p>{P1}</p></div></div>", f"{P1}\n{P2}"),
    "inside": (f"<article><p>{P1}</p><div class='ad'><p>{P2}</p></div><form><p>{P2}</p><input></form><script>var a='<p>"
               f"{P2}</p>'</script><div class='cookie-notice'>{P2}</div><p class=notice>{P2}</p><p>{P2}</p></article>", f"{P1}\n{P2}"),
    "unclosed": (f"<div class=post><p>{P1}<p>{P2}<ul><li>one, two<li>three</ul></div>", f"{P1}\n{P2}\none, two\nthree"),
    "inline": (f"<article><p><b>{P1}<br>a&nbsp;b &amp; c &#233;&lt;x&gt;<p>  {P2}\n\n x </article>",
               f"{P1} a b & c é<x>\n{P2} x"),
    "links": (f"<div><p><a href=x>{P1}</a></p><p><a href=x>{P2}</a></p></div><div><p>{P1}</p><p>{P2} <a href=y>more</a>"
              "</p></div>", f"{P1}\n{P2} more"),
    "hidden": (f"<main><p>{P1}</p><p style='display: none'>{P2}</p><div hidden>{P2}</div><p>{P2}</p></main>",
               f"{P1}\n{P2}"),
    "bare text": (f"<div>{P1}<p>{P2}</p>tail of it</div>", f"{P1}\n{P2}\ntail of it"),
    "sibling": (f"<div><p>{P1}</p><p>{P2}</p><p>Short end.</p></div>", f"{P1}\n{P2}\nShort end."),
    "headline beside the text": (f"<div><h1>Title</h1><div><p>{P1}</p><p>{P2}</p></div></div>", f"Title\n{P1}\n{P2}"),
    "headline further up": (f"<div id=wrap><div class=top><h1>Title</h1></div><div class=row><div class=col><p>{P1}</p><p>{P2}"
                            f"</p></div></div></div><div class=footer>{P1}</div>", f"Title\n{P1}\n{P2}"),
    "short section": (f"<div><div><p>{P1}</p><p>{P2}</p></div><div><h2>More</h2><p>It ends here.</p></div></div>",
                      f"{P1}\n{P2}\nMore\nIt ends here."),
    "list and table": (f"<div><div><p>{P1}</p><p>{P2}</p></div><ul><li>one<li>two</ul><table><tr><td>a<td>b</table>"
                       "<ul><li><a href=1>Home</a><li><a href=2>News</a></ul></div>", f"{P1}\n{P2}\none\ntwo\na\nb"),
    "names of an article's parts": (f"<article><p class=remark>{P1}</p><div class='search-result'><p>{P2}</p></div></article>",
                                    f"{P1}\n{P2}"),
    "names in parts": (f"<article><p>{P1}</p><div class='side-bar'>{P2}</div><div id=cookiebar>{P2}</div><div class=adsbox>{P2}"
                       f"</div><div class='userComments'><p>{P2}</p></div><p>{P2}</p></article><div class=responses><p>{P1}</p>"
                       f"<p>{P2}</p></div>", f"{P1}\n{P2}"),
    "quotes": (f"<article><p title=\"a > b\">{P1}</p><!-- <p>{P2}</p> --><p>{P2}</p></article>", f"{P1}\n{P2}"),
}


@pytest.mark.parametrize("name", CASES)
def test_layouts(name):
    body, want = CASES[name]
    assert H.main_text(page(body)) == want


@pytest.mark.parametrize("text", [None, "", "   ", "<", "<!--", "<script>x", "</p></div>", "<p", "<html></html>"])
def test_pages_without_text(text):
    assert H.main_text(text) in ("", "<", "<p")


def test_broken_and_very_long_pages():
    assert H.main_text("just text") == "just text"
    assert H.main_text("<p>a b") == "a b"
    deep = "<div>" * 20_000 + P1 + "</div>" * 20_000
    assert H.main_text(deep) == P1
    many = "<article>" + f"<p>{P1}</p>" * 5000 + "</article>"
    assert H.main_text(many) == "\n".join([P1] * 5000)
    assert H.main_text("<p>" + "x" * 3_000_000) == "x" * 3_000_000
    assert H.main_text("<" * 200_000)[:1] == "<"


@pytest.mark.parametrize("bit", ["<a ", "<p title='", "<p title=\"", "<div>", "</div>", "<li>", "<b>", "<", "<!", "<script ",
                                 "<a '\">", "<td>", "<p", "</section>", "<table><tr><td>", "<ul><li>", "&lt;", "<a b='c' "])
def test_broken_markup_is_read_in_linear_time(bit):
    import time
    text = (bit * (1 + 400_000 // len(bit)))[:400_000]
    for page_ in (text, f"<div><p>{P1}</p>" + text + "</p>"):
        began = time.process_time()
        H.main_text(page_)
        assert time.process_time() - began < 6  # about one second on an idle machine


def test_given_pages_have_their_whole_article(spark):
    """The pages hold one article each: its blocks, cut by hand."""
    def by_hand(page):
        a = re.sub(r"</?b>", "", re.search(r"<article>(.*)</article>", page, re.S).group(1)).replace("<br>", " ")
        parts = [" ".join(html.unescape(x).split()) for x in re.split(r"</?(?:h1|p)>", a)]
        return "\n".join(x for x in parts if x)
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op4_html(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == by_hand(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


def test_rows(spark):
    df = spark.createDataFrame([(1, None, "u", "x"), (None, "<p>a b", None, "y"), (2, "", "u", "z"), (2, "", "u", "z")],
                               "page_id long, html string, url string, text string")
    got = H.extract(df).collect()
    assert sorted((r.text, r.n_chars) for r in got) == [("", 0)] * 3 + [("a b", 3)]
    assert H.extract(df.limit(0)).count() == 0
