"""The six news sites: how each names itself and how its pages are read."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Site:
    key: str
    source: str
    base: str
    language: str
    feed: bool  # items come from RSS: title, date and category are the feed's
    body: tuple[str, ...]  # selectors, first match wins
    drop: tuple[str, ...]  # tags removed from the body
    title: tuple[str, ...] = ()
    author: str = "[class*=author]"
    date: str = ""
    category: str = ""
    category_links: bool = False  # the last of two or more links in it
    drop_classes: tuple[str, ...] = ()
    blocks: str = ""  # elements whose texts make the body
    blocks_separated: bool = False  # a blank between the pieces inside a block
    paragraphs: bool = False  # else its paragraphs
    whole: bool = True  # else the text of the whole element
    guards: tuple[str, ...] = ()  # texts of a page that hides its article


# Names, addresses and page layout of the sites.
# A selector is tag.class, tag, [class*=part] (any case) or [attribute=value].
SITES = (
    Site(
        key="hespress",
        source="Hespress",
        base="https://www.hespress.com",
        language="ar",
        feed=False,
        title=("h1",),
        date="time",
        category="[class*=breadcrumb]",
        category_links=True,
        body=("[class*=article-content]", "div.post-content", "article"),
        drop=("script", "style", "nav", "aside"),
    ),
    Site(
        key="bbc_news",
        source="BBC News",
        base="https://www.bbc.com",
        language="en",
        feed=True,
        author="[data-testid=byline-name]",
        body=("article",),
        drop=("script", "style", "figure", "nav"),
        blocks="div[data-component=text-block]",
        blocks_separated=True,
        paragraphs=True,
        whole=False,
    ),
    Site(
        key="barlamane",
        source="Barlamane",
        base="https://barlamane.com",
        language="ar",
        feed=False,
        title=("h1.entry-title", "h1.post-title", "h1"),
        date="time",
        category="[class*=category]",
        body=("div.entry-content", "div.post-content", "div.article-content", "article"),
        drop=("script", "style", "nav", "aside"),
    ),
    Site(
        key="akhbarona",
        source="Akhbarona",
        base="https://www.akhbarona.com",
        language="ar",
        feed=False,
        title=("h1.article-title", "h1.entry-title", "h1"),
        date="time",
        category="[class*=category]",
        body=("div.col-md-8", "div.article-body", "div.entry-content", "article"),
        drop=("script", "style", "nav", "aside"),
        drop_classes=("detail-social-links", "share-links", "related-posts"),
    ),
    Site(
        key="al_jazeera",
        source="Al Jazeera",
        base="https://www.aljazeera.com",
        language="en",
        feed=True,
        body=("div.wysiwyg", "div.article-p-wrapper", "article", "div.content"),
        drop=("script", "style", "figure", "nav", "aside"),
        paragraphs=True,
    ),
    Site(
        key="reuters",
        source="Reuters",
        base="https://www.reuters.com",
        language="en",
        feed=True,
        body=(
            "[data-testid=paragraph-0]",
            "div.article-body__content",
            "div.StandardArticleBody_body",
            "article",
        ),
        drop=("script", "style", "figure", "nav"),
        paragraphs=True,
        guards=("Please enable JS", "enable JavaScript"),
    ),
)

# Which links of a listing page lead to articles.
BARLAMANE_SKIPPED = ("/category/", "/page/", "/tag/", "/author/", "/fr", "/feed", "/contact", "/about")
ARTICLE_LINK = {"hespress": r"\.html$", "akhbarona": r"/[0-9]+\.html$"}

# Text that a BBC feed link must hold, and the bounds of a small crawl. Nothing
# applies these bounds by itself; callers that want them pass them on.
BBC_LINK_PART = "bbc.com"
LINKS_PER_LISTING = 10
ARTICLES_PER_SOURCE = 50
MAX_CONTENT = 5000

BY_KEY = {site.key: site for site in SITES}
SOURCES = tuple(site.source for site in SITES)
