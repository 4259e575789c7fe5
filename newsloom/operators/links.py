"""Links of listing pages. All of it happens inside the row of each page, so
nothing is shuffled and a page with many links stays one row until the end."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import markup
from newsloom.operators import sites


def page_links(pages: DataFrame) -> DataFrame:
    """Every link of every page, 0-based in document order."""
    return pages.select("page_id", "url", F.posexplode(markup.hrefs(F.col("html"))).alias("pos", "href"))


def resolved_links(pages: DataFrame) -> DataFrame:
    links = page_links(pages)
    return links.withColumn("href", markup.resolve(F.col("href"), markup.site_base(F.col("url"))))


def is_article_link(href: Column, site: Column, base: Column) -> Column:
    """Whether a resolved link leads to an article of the listing's own site."""
    rest = F.substring(href, F.length(base) + 1, F.length(href))
    skipped = F.lit(False)
    for part in sites.BARLAMANE_SKIPPED:
        skipped = skipped | href.contains(part)
    short_path = rest.rlike("^/*[^/]+(?:/[^/]+)?/*$")
    by_site = (
        F.when(site == "hespress", href.rlike(sites.ARTICLE_LINK["hespress"]))
        .when(site == "akhbarona", href.rlike(sites.ARTICLE_LINK["akhbarona"]))
        .when(site == "barlamane", ~skipped & short_path)
        .otherwise(False)
    )
    return href.startswith(base) & by_site


def first_links(html: Column, base: Column, wanted, n: int | None = None) -> Column:
    """The distinct wanted links of a page, in document order; with ``n`` the first n."""
    resolved = F.transform(markup.hrefs(html), lambda h: markup.resolve(h, base))
    distinct = F.array_distinct(F.filter(resolved, wanted))
    return distinct if n is None else F.slice(distinct, 1, n)


def listing_links(listings: DataFrame, n: int | None = None) -> DataFrame:
    """Article links of listing pages with ``site`` and ``category_rank``; with ``n``
    at most n of each page. ``listing`` tells pages of equal rank apart."""
    base = F.lit(None).cast("string")
    for s in sites.SITES:
        base = F.when(F.col("site") == s.key, s.base).otherwise(base)
    based = listings.withColumn("base", base)
    found = first_links(
        F.col("html"), F.col("base"), lambda h: is_article_link(h, F.col("site"), F.col("base")), n
    )
    listing = F.xxhash64("html").alias("listing")
    return based.select("site", "category_rank", listing, F.posexplode(found).alias("pos", "url"))
