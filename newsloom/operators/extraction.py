"""Articles from raw pages, by the rules of each site.

Parsing is a map over pages (no shuffle) in Arrow batches; all that follows,
truncation, fallback, filters and constants, is native.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import text
from newsloom.operators import page_tree, sites
from newsloom.operators.page_tree import parse
from newsloom.operators.sites import Site

# Workers get these helpers with the task and need no installed package.
for _module in (page_tree, sites, sys.modules[__name__]):
    cloudpickle.register_pickle_by_value(_module)

PARSED = "title string, author string, publication_date string, category string, content string, error string"
# Whole pages travel to the parser; only so many of a batch become Python strings at a time.
PAGES_AT_A_TIME = 64


def site_of(url: Column) -> Column:
    """Key of the site a URL belongs to, else NULL."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z]+://([^/?#:]+)", 1))
    key = F.lit(None).cast("string")
    for site in sites.SITES:
        domain = site.base.removeprefix("https://").removeprefix("www.")
        key = F.when((host == domain) | host.endswith("." + domain), site.key).otherwise(key)
    return key


def read_page(html: str, site: Site) -> tuple:
    """Title, author, date, category and body of one page, and the error if it cannot be read."""
    try:
        return *_fields(html, site), None
    except Exception as error:  # one page must not fail the others
        return None, None, None, None, None, f"{type(error).__name__}: {error}"


def _fields(html: str, site: Site) -> tuple:
    page = parse(html)
    wanted = [*site.title, site.date, site.category, site.author, *site.body]
    found = page.firsts([s for s in wanted if s])

    def text_of(selector: str):
        node = found.get(selector)
        return None if node is None else node.text()

    title = next((text_of(s) for s in site.title if s in found), None)
    date = None
    node = found.get(site.date)
    if node is not None:
        date = node.attrs.get("datetime") or node.text()
    category = None
    node = found.get(site.category)
    if node is not None and site.category_links:
        links = node.all("a")
        category = links[-1].text() if len(links) > 1 else None
    elif node is not None:
        category = node.text()
    # The author is read before the body drops elements of the page.
    author = text_of(site.author)
    return title, author, date, category, _body(found, site)


def _body(found: dict, site: Site) -> str:
    node = next((found[s] for s in site.body if s in found), None)
    if node is None:
        return ""
    dropped = set(site.drop_classes)
    node.remove(
        lambda n: n.tag in site.drop or dropped.intersection((n.attrs.get("class") or "").split())
    )
    blocks = node.all(site.blocks) if site.blocks else []
    if blocks:
        return " ".join(b.text(" " if site.blocks_separated else "") for b in blocks)
    paragraphs = node.all("p") if site.paragraphs else []
    if paragraphs:
        return " ".join(p.text() for p in paragraphs)
    return node.text(" ") if site.whole else ""


class PythonParser:
    """Carried columns and fields of pages that come in Arrow batches."""

    def __init__(self, carried: list[str]):
        self.carried, self.sites = carried, dict(sites.BY_KEY)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [*self.carried, *(f.split()[0] for f in PARSED.split(", "))]
        for whole in batches:
            for at in range(0, whole.num_rows, PAGES_AT_A_TIME):
                batch = whole.slice(at, PAGES_AT_A_TIME)
                pages = zip(batch.column("html").to_pylist(), batch.column("site").to_pylist())
                parsed = zip(*[read_page(html, self.sites[site]) for html, site in pages])
                columns = [batch.column(c) for c in self.carried] + [pa.array(c, pa.string()) for c in parsed]
                yield pa.RecordBatch.from_arrays(columns, names)
        # Workers are used again for other tasks and would keep it.
        pa.default_memory_pool().release_unused()


def parse_pages(pages: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Parse pages that carry a ``site`` key; others are left out.

    Keeps page_id, url, site and the columns named in ``keep``.
    """
    carried = ["page_id", "url", "site", *keep]
    source = pages.filter(F.col("site").isin(list(sites.BY_KEY)) & F.col("html").isNotNull())
    types = dict(source.dtypes)
    schema = ", ".join(f"`{c}` {types[c]}" for c in carried) + ", " + PARSED
    return source.select(*carried, "html").mapInArrow(PythonParser(carried), schema)


def is_guarded(html: Column, guards: tuple[str, ...]) -> Column:
    """True when the page shows a script notice in place of its article."""
    hit = F.lit(False)
    for guard in guards:
        hit = hit | html.contains(guard)
    return hit


def body_or_description(guarded: Column, body: Column, description: Column) -> Column:
    """The body, or the feed's description behind a guard or without a body."""
    return F.when(guarded, description).otherwise(
        F.coalesce(text.null_if_empty(body), description)
    )


def succeeded() -> Column:
    """Whether a parsed page makes an article: it was read, has a body, and a title
    unless the feed gives that."""
    from_feed = F.col("site").isin([s.key for s in sites.SITES if s.feed])
    return F.col("error").isNull() & (from_feed | ~text.is_blank(F.col("title"))) & ~text.is_blank(F.col("content"))


def finish(
    parsed: DataFrame, scraped_at: Column, keep: tuple[str, ...] = (), max_content: int | None = None
) -> DataFrame:
    """Raw articles from parsed pages with a ``site``: drop rows without a title or
    body, add the constants of the site; with ``max_content`` bodies are cut to that length."""
    site = F.col("site")
    source, language = F.lit(None).cast("string"), F.lit(None).cast("string")
    for s in sites.SITES:
        source = F.when(site == s.key, s.source).otherwise(source)
        language = F.when(site == s.key, s.language).otherwise(language)
    return parsed.filter(succeeded()).select(
        "title",
        "author",
        "publication_date",
        "category",
        cut_content(F.col("content"), max_content).alias("content"),
        source.alias("source"),
        "url",
        language.alias("language"),
        scraped_at.cast("string").alias("scraped_at"),
        *keep,
    )


def cut_content(content: Column, n: int | None) -> Column:
    return content if n is None else F.substring(content, 1, n)
