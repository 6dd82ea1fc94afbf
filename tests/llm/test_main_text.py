"""Main text of pages built from known blocks, of hand-written layouts, and of the given table."""
import html as markup
import random
import re
import time

import pytest

from cohortloom.llm import main_text
from cohortloom.llm.main_text import extract
from cohortloom.llm.queries import QUERIES
from tests.llm.fixtures import prose

SCHEMA = "page_id long, url string, html string, text string, n_chars string, c0 int"


def sentence(r, n):
    words = [w + r.choice(["", "", "", ",", " & co", " <3"]) for w in prose(r.random(), n).split(" ")]
    return " ".join(words) + "."


def inline(r, text):
    """The text in markup that leaves it as it is: links, bold, references, breaks, odd white space."""
    out = []
    for word in text.split(" "):
        word = markup.escape(word).replace("e", r.choice(["e", "&#101;", "&#x65;"]))
        out.append(r.choice(["{}", "{}", "{}", "<b>{}</b>", '<a href="/x?a=1>2">{}</a>', "<em\n>{}</em>", "{}<!-- > -->"]).format(word))
    return "".join(w + r.choice([" ", " ", "\n  ", "<br>", "\t&#32;"]) for w in out[:-1]) + out[-1]


def noise(r):
    links = "".join(f"<li><a href='/{i}'>{prose(i, 2)}</a>" for i in range(r.randint(2, 8)))
    return r.choice(
        [
            f"<nav><ul>{links}</ul></nav>",
            f"<div class='main-menu'><ul>{links}</ul></div>",
            f"<aside><p>{sentence(r, 60)}</p></aside>",
            f"<div class=ad>{sentence(r, 40)}</div>",
            f"<div id='cookieNotice'><p>{sentence(r, 30)}</p><button>OK</button></div>",
            f"<form><p>{sentence(r, 20)}</p><select><option>a<option>b</select></form>",
            "<script>if (1 < 2) document.write('<p>no</p>');</script>",
            "<style>p > b {}</style>",
            f"<section id=comments><p>{sentence(r, 90)}</p><p>{sentence(r, 90)}</p></section>",
            f"<div hidden><p>{sentence(r, 30)}</p></div>",
            f"<div role='banner'>{sentence(r, 15)}</div>",
            "<noscript><p>Please turn it on.</p></noscript>",
        ]
    )


@pytest.mark.parametrize("seed", range(60))
def test_known_blocks_come_back(seed):
    r = random.Random(seed)
    blocks, body = [], []
    for _ in range(r.randint(2, 9)):
        text = sentence(r, r.randint(8, 70))
        blocks.append(text)
        tag = r.choice(["p", "p", "p", "h2", "blockquote", "pre"])
        shut = "" if tag == "p" and r.random() < 0.4 else f"</{tag}>"
        body.append(f"<{tag}>{inline(r, text)}{shut}")
        if r.random() < 0.3:
            body.append(noise(r))
    inner = "".join(body)
    wrap = r.choice(["<article>{}</article>", "<main>{}</main>", "<div class='post'>{}</div>", "<article><section>{}</section></article>", "<main><article>{}</article></main>"])
    around = [noise(r) for _ in range(r.randint(0, 5))]
    cut = r.randint(0, len(around))
    page = "".join(around[:cut]) + wrap.format(inner) + "".join(around[cut:])
    if r.random() < 0.3:
        page = f"<div class='page has-sidebar'>{page}</div>"
    page = f"<!DOCTYPE html><html><head><title>t</title><meta charset=utf-8></head><body>{page}<footer>&copy; all</footer>" + r.choice(["", "</body></html>", "<div"])
    assert extract(page)[0] == " ".join(blocks)


LONG = "Many plain words, one after another, that make up a paragraph of some length."


@pytest.mark.parametrize(
    "page,text",
    [
        (None, ""),
        ("", ""),
        ("   \n", ""),
        ("plain  text &amp; more", "plain text & more"),
        ("<p>cut off <a href='x", "cut off"),
        ("<p>a &lt;b&gt; &copy;&nbsp;x &unknown; &amp", "a <b> © x &unknown; &"),
        ("<body><h1>T</h1><p>a<p>b</body>", "T a b"),
        ("<p>one<div>two</div>three", "one two three"),
        ("<p>in<b>li</b>ne <i>x<p>next</i> y", "inline x next y"),
        ("<ul><li>a<li>b<ul><li>c</ul><li>d</ul>", "a b c d"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a b c"),
        ("<nav>only</nav><footer>clutter</footer>", ""),
        ("<div title='a > b'>x</div>", "x"),
        ('<div title="never closed><p>x</p>', "x"),
        ("<script>never closed <p>x</p>", ""),
        (f"<table class=layout><tr><td><a href=1>a</a> <a href=2>b</a><td><p>{LONG}</p><p>{LONG}</p></table>", f"{LONG} {LONG}"),
        (f"<form id=page><div><p>{LONG}</p><p>{LONG}</p></div><input></form>", f"{LONG} {LONG}"),
        (f"<article><header><h1>Title</h1><p>by someone</p></header><p>{LONG}</p><footer>tags</footer></article>", f"Title {LONG}"),
        (f"<header><h1>Site</h1></header><div class=post><p>{LONG}</p><p>{LONG}</p></div>", f"{LONG} {LONG}"),
        (f"<article><p>{LONG}</p><ul><li><a>x</a><li><a>y</a><li><a>z</a></ul></article>", LONG),
        (f"<article class=post><p>{LONG}</p></article><article class=teaser><p>{LONG} Again.</p></article>", LONG),
        (f"<div><h2>A</h2><div><p>{LONG}</p><p>{LONG}</p></div><p>{LONG}</p></div>", f"A {LONG} {LONG} {LONG}"),
        (f"<article class='comment'><p>{LONG}</p></article><article><p>Short.</p></article>", "Short."),
    ],
)
def test_layouts(page, text):
    assert extract(page)[0] == text


def test_points_follow_length_commas_and_links():
    nodes = main_text.parse("<div><p>a, b</p><p><a>all of it, linked</a></p><section><p>" + "x" * 100 + "</p></section></div>")
    main_text.prune(nodes)
    main_text.score(nodes)
    points = {x.tag: x.points for x in nodes if x.tag in ("div", "section")}
    assert points["section"] == pytest.approx(2.0)
    assert points["div"] == pytest.approx((1 + 1 + 0.04 + 0 + 1.0) * (1 - 17 / 121))


def test_deep_and_long_pages_are_linear():
    start = time.time()
    assert extract("<div>" * 30_000 + "deep")[0] == "deep"
    assert extract("<b>x</b> <" * 60_000)[0].count("x") == 60_000
    assert len(extract("<p>word word</p>" * 60_000)[0]) == 60_000 * 10 - 1
    assert time.time() - start < 30


def test_rows_and_clashing_names(spark):
    rows = [(1, "u", None, "t", "n", 1), (None, None, "<p>x</p>", None, None, 2), (1, "u", "", "t", "n", 1), (2, "v", "<p>é\U0001f600</p>", "", "", 3)]
    found = main_text.main_text(spark.createDataFrame(rows, SCHEMA))
    assert found.columns == ["page_id", "url", "text", "n_chars", "container", "points"]
    got = sorted([(r.page_id, r.url, r.text, r.n_chars) for r in found.collect()], key=str)
    assert got == sorted([(1, "u", "", 0), (None, None, "x", 1), (1, "u", "", 0), (2, "v", "é\U0001f600", 2)], key=str)
    assert main_text.main_text(spark.createDataFrame([], SCHEMA)).count() == 0


def test_query_equals_the_article_of_the_given_pages(spark, sf):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf}/pages.parquet").collect()}
    got = QUERIES["op11_main_text"](spark, sf).collect()
    assert len(got) == len(pages) > 0
    for r in got:
        inside = re.search("<article>(.*?)</article>", pages[r.page_id], re.S).group(1)
        plain = markup.unescape(re.sub("<[^>]+>", " ", re.sub("</?b>", "", inside)))
        assert r.text == " ".join(plain.split()) and r.n_chars == len(r.text)
