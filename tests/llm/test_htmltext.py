"""Main text of hand-made pages, of odd rows, and of all small test pages."""

import html
import re
import time

import numpy as np
import pytest

from quantis.llm import htmltext
from quantis.llm.htmltext import main_text
from quantis.llm.queries import QUERIES
from tests.conftest import SF_SMALL
from tests.llm.test_operators_on_odd_rows import collected

LONG = "A sentence of the article that is long enough to be told from a menu, and goes on for a while. " * 3
P = f"<p>{LONG}</p>"
TEXT = LONG.strip()


def page(body):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var a='<p>x</p>';</script></head><body>{body}</body></html>"


MENU = "<nav><ul>" + "".join(f'<li><a href="/{i}">Item {i}</a></li>' for i in range(8)) + "</ul></nav>"
PAGES = {
    "menus, adverts and footers go": (
        f'{MENU}<div class="ad">Buy this now, it is very good and very cheap today.</div><article><h1>Head</h1>{P}<p>Be.</p>{P}</article>'
        "<aside><p>Other stories of the day</p></aside><footer>&copy; Someone</footer>", ["Head", TEXT, "Be.", TEXT]),
    "reader comments go": (
        f'<article><h1>H</h1>{P}</article><section id="comments"><h2>Comments</h2>'
        f'<article class="comment"><p>{LONG}</p></article><article class="comment"><p>{LONG}</p></article></section>', ["H", TEXT]),
    "notices and forms go": (
        f'<div class="cookie-notice"><p>{LONG}</p></div><main><h1>H</h1>{P}<form><p>Your mail</p><input><button>Go</button></form></main>',
        ["H", TEXT]),
    "an article's header keeps its heading": (
        f'<header><p>Site name</p></header><article><header><h1>H</h1><p>By X</p></header>{P}</article>', ["H", TEXT]),
    "names around everything are no boilerplate": (
        f'<div class="page-with-sidebar"><div id="content"><h1>H</h1>{P}{P}</div><div class="sidebar">{MENU}</div></div>', ["H", TEXT, TEXT]),
    "a page that names nothing": (
        "<div><ul>" + "".join(f"<li><a href=/>Link {i}</a></li>" for i in range(9)) + f"</ul></div><div><div><h2>H</h2>{P}<p>Short.</p>{P}</div></div>"
        "<div><a href=/>About</a> <a href=/>Terms</a></div>", ["H", TEXT, "Short.", TEXT]),
    "unclosed tags": (
        f"{MENU}<article><h1>H</h1><p><b>One<br><p>Two</p><ul><li>a<li>b</ul><p>{LONG}<p>{LONG}</article><footer>x</footer>",
        ["H", "One", "Two", "a", "b", TEXT, TEXT]),
    "character references and white space": (
        f"<article><h1>A&amp;B &lt;c&gt; &eacute;&#233;&#x65e5;</h1><p>one\n two\t&nbsp; three<br>four<img src=x>five</p>{P}<p>&notit; &am &copy</p></article>",
        ["A&B <c> éé日", "one two three four five", TEXT, "¬it; &am ©"]),
    "inline elements join, cells and items are blocks": (
        f"<article><p>in<b>li</b><i>ne</i></p><table><tr><td>1</td><td>2</td></tr></table>{P}</article>", ["inline", "1", "2", TEXT]),
    "nested markup inside paragraphs": (
        f'<article><p>see <span class="ad">buy</span>here</p>{P}<div class="share-buttons"><a href=/>Share</a></div></article>', ["see", "here", TEXT]),
    "no text": ("<div></div>", []),
    "comments and sections of markup": (f"<article><!-- <p>no</p> --><![CDATA[x]]><?php y ?>{P}<!doctype z></article>", [TEXT]),
}


@pytest.mark.parametrize("name", PAGES)
def test_hand_made_pages(name):
    body, expected = PAGES[name]
    assert main_text(page(body)).split("\n") == (expected or [""])


def expected_text(markup):
    """The blocks of the article of a test page, by splitting at its tags."""
    inner = re.search(r"<article>(.*)</article>", markup, re.S).group(1)
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner))
    return "\n".join(filter(None, blocks))


def test_all_small_pages(spark):
    rows = spark.read.parquet(f"{SF_SMALL}/pages.parquet")
    expected = {(r["page_id"], r["url"]): expected_text(r["html"]) for r in rows.collect()}
    got = QUERIES["op11_html_text"](spark, SF_SMALL).collect()
    assert len(got) == len(expected) == rows.count()
    for r in got:
        assert r["text"] == expected[(r["page_id"], r["url"])] and r["n_chars"] == len(r["text"])


def test_odd_rows(spark):
    long = page("<article>" + P * 20_000 + "</article>")
    rows = [(1, "u", None, "x"), (2, None, "", "x"), (None, "u", page(f"<article>{P}</article>"), "x"), (3, "u", long, "x"), (3, "u", long, "x"),
            (4, "u", "no markup at all", "x"), (5, "u", "<", "x"), (6, "u", "&", "x")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r["row"]["page_id"], r["n_chars"]): r["text"] for r in htmltext.extract(df, keep=["page_id", "url", "text"]).collect()}
    assert got[(1, 0)] == got[(2, 0)] == "" and got[(None, len(TEXT))] == TEXT
    assert got[(3, 20_000 * (len(TEXT) + 1) - 1)] == "\n".join([TEXT] * 20_000)
    assert got[(4, 16)] == "no markup at all" and got[(5, 1)] == "<" and got[(6, 1)] == "&"
    assert htmltext.extract(df).first()["row"].asDict().keys() == {"page_id", "url", "text"}


def test_empty_table(spark):
    assert collected(htmltext.extract(spark.createDataFrame([], "page_id long, url string, html string"))) == []


@pytest.mark.parametrize(
    "part", ["<", "<a ", "<!--", "<!-- x ", "<div>", "&", "<p><button>", "<p>x", '<a href="', "</", "</x ", "<script>", "<?", "<!", "<![CDATA[", "<article>x", "<ul><li>a"]
)
def test_hostile_markup_takes_linear_time(part):
    def seconds(n):
        t = time.process_time()
        main_text(part * n)
        return time.process_time() - t

    seconds(100)
    assert seconds(40_000) < 20 * max(seconds(4_000), 0.05)


def test_smoothing_keeps_constant_ratios():
    assert np.allclose(htmltext.smoothed(np.full(9, 3.0)), 3)
    assert htmltext.smoothed(np.array([0, 0, 9, 0, 0.0])).argmax() == 2
