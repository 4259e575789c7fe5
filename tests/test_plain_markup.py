"""Markup in plain forms is read without the parser's steps, and gives the tree that the parser gives."""

import random
from html.parser import HTMLParser

from newsloom.operators import page_tree

SF_DIR = "/root/testdata/sf0.001"
PAGE = (
    '<!DOCTYPE html><html lang="en"><head><title>A &amp; b</title><style>p{margin:0}</style>'
    "<script>var t=\"</p>\";track(3);</script></head><body class=x data-id='7' hidden><!-- ad 3-4 --><ARTICLE><p>a < b<br/>"
    '<P>c &lt; d</p><img src="x" alt=""/><a href="?a=1&b=2">e</a></article></div></body></html>'
)
PIECES = [
    *"< > </ /> a p div script style title br \n \" ' = & -- - ! <? text \f \r \0 K ſ".split(" "), " ", "<!--", "-->", "]]>", "<![CDATA[",
    "<p>", "</p>", "</P>", '<div class="a b">', "<div class=x>", "</div>", "<br/>", "<br / >", "<a b=c/>", "<a b='c'/>", '<a b="">', "<a b>",
    '<a\tB="1" b="2">', '<a b= "c">', '<a b ="c">', '<a b="c"d="e">', '<a href="?a&b">', "</a>", "</ a>", "<a-b c:d=1>", "</a-b>", "&amp;", "&lt", "&#1;",
    "<script>", '<script src="a&b">', "<script/>", "</script>", "</SCRIPT >", "</ script>", "<SCRIPT>", "<style>", "</style>", "<title>", "</title>",
    "<title/>", "<textarea>", "</textarea>", "<iframe>", "</iframe>", "<!DOCTYPE html>", "<!doctype", "é",
]


def flat(node):
    return node if isinstance(node, str) else (node.tag, node.attrs, [flat(c) for c in node.children])


def both(html, monkeypatch):
    quick = flat(page_tree.parse(html))
    with monkeypatch.context() as m:
        m.setattr(page_tree._Builder, "read_plain", lambda self, html, end: 0)
        return quick, flat(page_tree.parse(html))


def test_plain_pages_are_read_in_one_look_at_each_tag(spark, monkeypatch):
    steps = []
    start = HTMLParser.parse_starttag
    monkeypatch.setattr(HTMLParser, "parse_starttag", lambda self, i: steps.append(self.rawdata) or start(self, i))
    tree = page_tree.parse(PAGE)
    assert steps == ['<a href="?a=1&b=2">'] and tree.first("title").text() == "A & b" and tree.first("a").attrs == {"href": "?a=1&b=2"}
    steps.clear()
    for row in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("html").collect():
        page_tree.parse(row.html or "")
    assert steps == []


def test_plain_markup_gives_the_tree_of_the_parser(spark, monkeypatch):
    pages = [r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").select("html").collect() if r.html]
    made = random.Random(7)
    pages += [PAGE, *("".join(made.choice(PIECES) for _ in range(made.randint(1, 25))) for _ in range(20_000))]
    for html in pages:
        quick, slow = both(html, monkeypatch)
        assert quick == slow, html


def test_first_elements_are_those_of_each_selector_alone():
    tree = page_tree.parse('<p><h1 class="a x"><time datetime="t"></time><h1 class="b"></h1><div id=A-b></div></h1><div class="b"></div></p>')
    selectors = ["h1", "time", "h1.b", "div.b", "[id*=a-]", "[datetime=t]", "nav", "div"]
    alone = {s: tree.all(s)[0] for s in selectors if tree.all(s)}
    assert tree.firsts(selectors) == alone and len(alone) == 7
