"""Raw pages and feeds to Bronze articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from newsloom.operators import crawl, extraction, links, sites
from newsloom.operators.keyfilter import maybe_in
from newsloom.operators.ranking import first_n_salted, keep_first
from newsloom.operators.sequence import number_rows
from newsloom.settings import staged


KEY = ["site", "url"]
# ``listing`` and ``url`` decide between listings of equal rank.
ORDER = ["category_rank", "pos", "listing", "url"]
ITEM = ["title", "publication_date", "description", "category"]


def wanted_articles(listings: DataFrame, items: DataFrame, links_per_listing: int | None = None) -> DataFrame:
    """URLs to read, each once per site: from links of listing pages, and from feed items
    with their ``item`` (title, date, description and category). The first one wins."""
    listed = listings.filter(F.col("site").isin([s.key for s in sites.SITES if not s.feed]))
    links_of = links.listing_links(listed, links_per_listing)
    item = F.struct(*ITEM).alias("item")
    from_links = links_of.select(*KEY, *ORDER[:3], F.lit(None).cast(items.select(item).schema["item"].dataType).alias("item"))
    fed = items.filter(F.col("site").isin([s.key for s in sites.SITES if s.feed]))
    from_items = fed.select(*KEY, F.col("category_rank"), F.col("pos"), F.lit(0).cast("bigint").alias("listing"), item)
    return keep_first(from_links.unionByName(from_items), KEY, ORDER)


def read_wanted(wanted: DataFrame, located: DataFrame) -> DataFrame:
    """Articles of the wanted URLs whose page was fetched, with the ``error`` of pages
    that cannot be read. ``located``: pages with their ``site``.

    Pages are parsed once, before the join, so their raw HTML is never shuffled; pages that
    nothing asks for are left out before that. Of a URL that was fetched several times the
    first page counts, so the join is one to one.
    """
    wanted = staged(wanted, "wanted-articles")
    asked = maybe_in(located, wanted, KEY)
    parsed = extraction.parse_pages(asked.withColumn("guarded", guarded()), keep=("guarded",))
    page = keep_first(parsed, KEY, ["page_id"])
    both = wanted.join(page.withColumnsRenamed({"content": "body", "title": "page_title", "category": "page_category",
                                                "publication_date": "page_date"}), KEY)
    fed = F.col("site").isin([s.key for s in sites.SITES if s.feed])
    falls_back = F.col("site").isin([s.key for s in sites.SITES if s.guards])
    content = extraction.body_or_description(F.col("guarded"), F.col("body"), F.col("item.description"))
    return both.select(
        *KEY, "category_rank", "pos", "listing", "error",
        F.when(fed, F.col("item.title")).otherwise(F.col("page_title")).alias("title"),
        F.when(~fed | ~F.col("guarded"), F.col("author")).alias("author"),
        F.when(fed, F.col("item.publication_date")).otherwise(F.col("page_date")).alias("publication_date"),
        F.when(fed, F.col("item.category")).otherwise(F.col("page_category")).alias("category"),
        F.when(falls_back, content).otherwise(F.col("body")).alias("content"),
    )


def guarded() -> Column:
    """Whether a page of a guarded site shows its guard in place of the article."""
    hit = F.lit(False)
    for s in sites.SITES:
        hit = hit | ((F.col("site") == s.key) & extraction.is_guarded(F.col("html"), s.guards))
    return hit


def bronze_articles(
    listings: DataFrame,
    items: DataFrame,
    pages: DataFrame,
    scraped_at: Column,
    *,
    per_source: int | None = None,
    links_per_listing: int | None = None,
    max_content: int | None = None,
    seen: Observation | None = None,
) -> DataFrame:
    """Articles of all six sites, each URL once, numbered by ``pos`` in the order of the
    crawl. ``listings``: site, category_rank, html; ``items``: as from ``read_feeds``;
    ``pages``: page_id, url, html.

    Everything is kept unless bounds are given: the first ``per_source`` successful
    articles of a source, ``links_per_listing`` links of a page, ``max_content`` characters.
    A URL that failed is not taken up again from a later listing. ``seen`` gets what became of the
    pages of each site (see ``crawl.observed_outcomes``); a site whose pages fail takes nothing from the others.
    """
    located = pages.withColumn("site", extraction.site_of(F.col("url")))
    read = read_wanted(wanted_articles(listings, items, links_per_listing), located)
    if seen is not None:
        read = crawl.observed_outcomes(read, seen)
    kept = read.filter(extraction.succeeded())
    if per_source is not None:
        # Chosen on narrow rows; their texts are joined again afterwards.
        narrow = first_n_salted(kept.select(*KEY, *ORDER[:3]), ["site"], ORDER, per_source)
        kept = kept.join(narrow.select(KEY), KEY, "left_semi")
    ordered = number_rows(kept.drop("error").withColumnRenamed("pos", "place"), "category_rank", "place", "listing", *KEY, out="pos")
    return extraction.finish(
        ordered.withColumn("error", F.lit(None).cast("string")), scraped_at, keep=("pos",), max_content=max_content
    )
