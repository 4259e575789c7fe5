"""RSS feeds: ``<folder>/site=<key>/category=<feed>/*.xml``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.functions.dates import strip_space
from newsloom.functions.markup import resolve
from newsloom.functions.text import is_blank, null_if_empty
from newsloom.operators import sites
from newsloom.sources.lake import list_files

ITEM = "title string, link string, pubDate string, description string"


def read_feeds(spark: SparkSession, folder: str, order: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Items of all feeds. ``pos`` rises in the order of the items of a feed, and
    ``category_rank`` is the place of the feed in the ``order`` of its site: the category of
    the first feed wins where an item is in several. Feeds not in the order come last.

    The reader splits large files at item tags; nothing is read whole. A file that cannot be read
    gives the items before its damage; ``feed_outcomes`` counts such files.
    """
    schema = ITEM + ", site string, category string"
    raw = spark.read.format("xml").option("rowTag", "item").option("ignoreCorruptFiles", True).schema(schema).load(folder)
    rank = F.lit(max(map(len, (order or {}).values()), default=0))
    for site, feeds in (order or {}).items():
        for i, feed in enumerate(feeds):
            rank = F.when((F.col("site") == site) & (F.col("category") == feed), i).otherwise(rank)
    placed = raw.withColumns({"pos": F.monotonically_increasing_id(), "category_rank": rank})
    return usable_items(placed)


def feed_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Per site and category: feed files, items in them, and files that gave none, such as damaged
    ones. A file is a unit of failure: what cannot be read in one takes nothing from the others."""
    place = [F.regexp_extract("path", f"/{name}=([^/]+)/", 1).alias(name) for name in ("site", "category")]
    files = list_files(spark, folder, "*.xml").select("path", *place)
    read = spark.read.format("xml").option("rowTag", "item").option("ignoreCorruptFiles", True).schema(ITEM).load(folder)
    found = read.groupBy(F.col("_metadata.file_path").alias("path")).agg(
        # What is no feed comes as an item without anything.
        F.count_if(F.coalesce(*[c.split()[0] for c in ITEM.split(", ")]).isNotNull()).alias("n")
    )
    return files.join(found, "path", "left").groupBy("site", "category").agg(
        F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("n"), F.lit(0)).alias("items"), F.count_if(F.coalesce("n", F.lit(0)) == 0).alias("unreadable")
    )


def usable_items(raw: DataFrame) -> DataFrame:
    """Items with a title and a link; BBC links must be its own, and Al Jazeera
    links may be relative. A bad item does not affect the rest of its feed."""

    def clean(name: str):
        return null_if_empty(strip_space(F.col(name)))

    link = clean("link")
    aljazeera = sites.BY_KEY["al_jazeera"]
    url = F.when(F.col("site") == aljazeera.key, resolve(link, F.lit(aljazeera.base))).otherwise(link)
    items = raw.select(
        "site",
        "category_rank",
        "pos",
        clean("title").alias("title"),
        url.alias("url"),
        clean("pubDate").alias("publication_date"),
        clean("description").alias("description"),
        "category",
    )
    foreign = (F.col("site") == "bbc_news") & ~F.col("url").contains(sites.BBC_LINK_PART)
    return items.filter(~is_blank(F.col("title")) & ~is_blank(F.col("url")) & ~foreign)
