import pytest
from pyspark.sql import functions as F

from newsloom.functions import markup
from newsloom.operators import crawl, extraction, links, sites
from newsloom.operators.page_tree import parse
from newsloom.plans.bronze import bronze_articles
from newsloom.sources import feeds

HESPRESS = """<html><head><script>var a = "<h1>no</h1>";</script></head><body>
<div class="Breadcrumbs"><a>Home</a><a> Sport </a></div><h1 class="x">Big <b>news</b> &amp; more</h1>
<p class="Post-AUTHOR name">Ann <i>B</i></p><time datetime="2026-05-06T10:00:00">today</time>
<section class="article-content"><p>One</p><nav>menu</nav><script>x()</script> two<!-- c --> three<aside>ad</aside></section>
<article>other</article></body></html>"""


def read(html, key):
    return extraction.read_page(html, sites.BY_KEY[key])[:-1]


def test_listed_site():
    assert read(HESPRESS, "hespress") == (
        "Bignews& more", "AnnB", "2026-05-06T10:00:00", "Sport", "One two three")


def test_one_breadcrumb_is_no_category_and_time_text_is_the_fallback():
    page = '<div class="breadcrumb"><a>Home</a></div><h1>T</h1><time> 7:30 </time><div class="post-content">a</div>'
    assert read(page, "hespress") == ("T", None, "7:30", None, "a")


@pytest.mark.parametrize("key,html,title,body", [
    ("barlamane", '<h1>a</h1><h1 class="post-title">b</h1><article>x</article><div class="z entry-content">y</div>', "b", "y"),
    ("barlamane", '<h1>a</h1><h1 class="entry-title">c</h1><article>x</article>', "c", "x"),
    ("akhbarona", '<h1>a</h1><article>x</article><div class="article-body">y<p class="share-links">s</p></div>', "a", "y"),
    ("akhbarona", '<h1 class="article-title">t</h1><div class="col-md-8">p<aside>q</aside><div class="related-posts">r</div></div>', "t", "p"),
    ("bbc_news", '<article><div data-component="text-block">a <b>b</b></div><p>c</p><div data-component="text-block">d</div></article>', None, "a b d"),
    ("bbc_news", "<article><p>a <b>b</b></p>x<p>c</p><figure><p>f</p></figure></article>", None, "ab c"),
    ("bbc_news", "<article>no paragraphs</article>", None, ""),
    ("al_jazeera", '<article><p>n</p></article><div class="wysiwyg"><p>a</p> t <p>b</p><aside><p>c</p></aside></div>', None, "a b"),
    ("al_jazeera", '<div class="content">plain <i>text</i></div>', None, "plain text"),
    ("reuters", '<article><p>n</p></article><p data-testid="paragraph-0">a <b>b</b></p>', None, "a b"),
    ("reuters", '<div class="article-body__content"><p>a</p><p>b</p></div>', None, "a b"),
    ("reuters", "<div>nothing</div>", None, ""),
    ("hespress", "<h1>t</h1>", "t", ""),
])
def test_site_rules(key, html, title, body):
    parsed = read(html, key)
    assert (parsed[0], parsed[4]) == (title, body)


def test_bbc_byline_and_category_class():
    assert read('<span data-testid="byline-name">By X</span><article><p>a</p></article>', "bbc_news")[1] == "By X"
    assert read('<span class="Entry-Category">News</span><h1>t</h1><article>a</article>', "barlamane")[3] == "News"


def test_unclosed_paragraphs_nest_and_stray_end_tags_are_ignored():
    page = parse("<div><p>a<p>b</p></i>c</div>d")
    assert [p.text() for p in page.all("p")] == ["abc", "b"]
    assert page.first("div").text(" ") == "a b c"
    assert parse("<p>x<br/>y<img>z</p>").first("p").text("|") == "x|y|z"


def test_strings_split_at_comments_only():
    assert parse("<p>a &amp; b<!-- x --> c</p>").first("p").text("|") == "a & b|c"


def test_native_body_agrees_with_the_tree(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    native = pages.select("page_id", markup.page_title(F.col("html")).alias("t"), markup.page_body(F.col("html")).alias("b"))
    tree = extraction.parse_pages(pages.withColumn("site", F.lit("hespress")))
    both = native.join(tree, "page_id")
    assert both.count() == pages.count()
    assert both.filter("t <> title or b <> content").count() == 0


def test_links(spark):
    html = """<a href="/a">1</a><!-- <a href="/no">x</a> --><script>'<a href="/no2">'</script>
      <A class=x HREF='/b?c=1&amp;d=2'>2</A><a data-href="/no3">3</a><a href=/e>4</a><a href="/a">5</a>"""
    df = spark.createDataFrame([(1, "https://x.y/z", html)], "page_id bigint, url string, html string")
    got = [r.href for r in links.resolved_links(df).orderBy("pos").collect()]
    assert got == ["https://x.y/a", "https://x.y/b?c=1&d=2", "https://x.y/e", "https://x.y/a"]


@pytest.mark.parametrize("site,href,kept", [
    ("hespress", "https://www.hespress.com/a.html", True), ("hespress", "https://www.hespress.com/a.htm", False),
    ("hespress", "https://other.com/a.html", False), ("akhbarona", "https://www.akhbarona.com/x/12.html", True),
    ("akhbarona", "https://www.akhbarona.com/x/index.1.html", False), ("barlamane", "https://barlamane.com/a", True),
    ("barlamane", "https://barlamane.com/a/b/", True), ("barlamane", "https://barlamane.com/a/b/c", False),
    ("barlamane", "https://barlamane.com/", False), ("barlamane", "https://barlamane.com/tag/x", False),
    ("barlamane", "https://barlamane.com/france", False), ("barlamane", "https://barlamane.com//a//", True),
    ("barlamane", "https://barlamane.com/a//b", False),
])
def test_article_links(spark, site, href, kept):
    df = spark.createDataFrame([(site, href, sites.BY_KEY[site].base)], "s string, h string, b string")
    assert df.select(links.is_article_link(F.col("h"), F.col("s"), F.col("b")).alias("k")).first().k is kept


def test_site_of(spark):
    cases = {"https://www.bbc.com/x": "bbc_news", "https://bbc.com/x": "bbc_news", "https://barlamane.com": "barlamane",
             "https://notbbc.com/x": None, "http://WWW.Reuters.com:80/a": "reuters", "x": None}
    df = spark.createDataFrame([(u,) for u in cases], "u string")
    assert {r.u: r.s for r in df.select("u", extraction.site_of(F.col("u")).alias("s")).collect()} == cases


def test_cap_counts_successes_and_never_retries(spark):
    rows = [("s", f"u{i}", 0, i, i % 2 == 0) for i in range(10)] + [("s", "u1", 1, 0, True), ("s", "v", 1, 1, True), ("t", "u1", 0, 0, True)]
    df = spark.createDataFrame(rows, "source string, url string, category_rank int, pos int, ok boolean")
    got = {(r.source, r.url) for r in crawl.cap_articles(df, "ok", per_source=6).collect()}
    assert got == {("s", "u0"), ("s", "u2"), ("s", "u4"), ("s", "u6"), ("s", "u8"), ("s", "v"), ("t", "u1")}


RSS = """<?xml version="1.0"?><rss><channel><title>c</title>
<item><title><![CDATA[ A & b ]]></title><link>{0}</link><pubDate>Mon, 06 May 2026 12:00:00 GMT</pubDate><description>&lt;p&gt;d&lt;/p&gt;</description></item>
<item><title></title><link>{0}</link></item><item><title>no link</title></item>
<item><title>last</title><link>{1}</link><description> e </description></item></channel></rss>"""


def test_feeds(spark, tmp_path):
    for site, category, first, last in (
        ("bbc_news", "world", "https://www.bbc.com/1", "https://elsewhere.com/2"),
        ("al_jazeera", "africa", "/news/1", "https://www.aljazeera.com/2"),
        ("reuters", "world", "https://www.reuters.com/1", "https://www.reuters.com/2"),
    ):
        folder = tmp_path / f"site={site}" / f"category={category}"
        folder.mkdir(parents=True)
        (folder / "feed.xml").write_text(RSS.format(first, last))
    items = feeds.read_feeds(spark, f"file:{tmp_path}").orderBy("site", "pos").collect()
    assert [(r.site, r.title, r.url, r.description, r.category) for r in items] == [
        ("al_jazeera", "A & b", "https://www.aljazeera.com/news/1", "<p>d</p>", "africa"),
        ("al_jazeera", "last", "https://www.aljazeera.com/2", "e", "africa"),
        ("bbc_news", "A & b", "https://www.bbc.com/1", "<p>d</p>", "world"),
        ("reuters", "A & b", "https://www.reuters.com/1", "<p>d</p>", "world"),
        ("reuters", "last", "https://www.reuters.com/2", "e", "world"),
    ]


def test_bronze_from_pages_and_feeds(spark):
    h, r, b = "https://www.hespress.com", "https://www.reuters.com", "https://www.bbc.com"
    listings = spark.createDataFrame([
        ("hespress", 0, f'<a href="/1.html">a</a><a href="{h}/2.html">b</a><a href="/3.htm">c</a>'),
        ("hespress", 1, '<a href="/2.html">b</a><a href="/4.html">d</a><a href="/9.html">gone</a>'),
    ], "site string, category_rank int, html string")
    page = "<h1>T{0}</h1><article><p>body {0}</p></article>"
    rows = [(i, f"{h}/{i}.html", page.format(i)) for i in (1, 2)] + [
        (4, f"{h}/4.html", "<article>no title</article>"),
        (10, f"{r}/10", "<p class='author'>X</p>Please enable JS"), (11, f"{r}/11", "<article></article>"),
        (12, f"{r}/12", page.format(12)), (13, f"{b}/13", "<div>nothing</div>"), (14, f"{b}/14", page.format(14)),
        (15, f"{r}/15", "<div></div>"), (16, "https://unknown.example/1", page.format(16)),
    ]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    feed = [("reuters", 0, p, f"R{n}", f"{r}/{n}", "d", f"desc {n}", "world") for p, n in enumerate((10, 11, 12, 99))]
    feed += [("reuters", 0, 9, "R15", f"{r}/15", "d", None, "world")]
    feed += [("bbc_news", 0, p, f"B{n}", f"{b}/{n}", "d", f"desc {n}", "uk") for p, n in enumerate((13, 14))]
    items = spark.createDataFrame(feed, "site string, category_rank int, pos bigint, title string, url string, "
                                  "publication_date string, description string, category string")
    got = bronze_articles(listings, items, pages, F.lit("now")).orderBy("source", "pos").collect()
    assert [(a.source, a.title, a.content, a.author, a.language) for a in got] == [
        ("BBC News", "B14", "body 14", None, "en"),
        ("Hespress", "T1", "body 1", None, "ar"),
        ("Hespress", "T2", "body 2", None, "ar"),
        ("Reuters", "R10", "desc 10", None, "en"),
        ("Reuters", "R11", "desc 11", None, "en"),
        ("Reuters", "R12", "body 12", None, "en"),
    ]


def test_content_is_cut_by_characters(spark):
    df = spark.createDataFrame([("é" * 6000,)], "c string")
    assert df.select(extraction.cut_content(F.col("c"), 5000).alias("c")).first().c == "é" * 5000
    assert df.select(extraction.cut_content(F.col("c"), None).alias("c")).first().c == "é" * 6000


def test_odd_pages_do_not_fail_the_others(spark):
    assert parse("<p>a<![foo bar]>b</p>").text("|") == "a|b"
    many = "<i>" * 20_000 + "</b>" * 20_000 + "<article>x</article>"
    assert parse(many).first("article").text() == "x"
    rows = [(1, "https://www.reuters.com/1", "reuters", "<article><p>ok</p></article>"), (2, "https://www.reuters.com/2", "reuters", "bad")]
    site = sites.BY_KEY["reuters"]
    assert extraction.read_page(None, site)[:5] == (None,) * 5 and extraction.read_page(None, site)[5]
    df = spark.createDataFrame(rows, "page_id bigint, url string, site string, html string")
    assert {r.page_id: r.content for r in extraction.parse_pages(df).collect()} == {1: "ok", 2: ""}
    counts = crawl.site_outcomes(extraction.parse_pages(df)).first()
    assert (counts.site, counts.pages, counts.failed, counts.articles) == ("reuters", 2, 0, 1)


def test_source_counts_keep_silent_sources(spark):
    df = spark.createDataFrame([("Reuters",), ("Reuters",), ("Elsewhere",)], "source string")
    got = {r.source: r.article_count for r in crawl.source_counts(df).collect()}
    assert got == {**{s: 0 for s in sites.SOURCES}, "Reuters": 2}
