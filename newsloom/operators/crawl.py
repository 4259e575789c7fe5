"""Choosing which articles of a crawl become Bronze rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsloom.operators import sites
from newsloom.operators.extraction import succeeded
from newsloom.operators.ranking import first_n_salted, keep_first


def cap_articles(candidates: DataFrame, succeeded: str, per_source: int | None = None) -> DataFrame:
    """First listing wins per (source, url); of the successful articles all are kept, or
    with ``per_source`` the first of each source in (category_rank, pos) order.

    A URL that failed is not tried again under a later listing, and failures do
    not count towards the cap.
    """
    order = ["category_rank", "pos"]
    found = keep_first(candidates, ["source", "url"], order).filter(F.col(succeeded))
    return found if per_source is None else first_n_salted(found, ["source"], order, per_source)


def counts_by(articles: DataFrame, column: str) -> DataFrame:
    """Articles per value of ``language`` or ``source``; a missing value counts as such."""
    return articles.groupBy(column).agg(F.count(F.lit(1)).alias("article_count"))


def site_outcomes(parsed: DataFrame) -> DataFrame:
    """Per site, what became of its fetched pages: read, failed, and articles made."""
    return parsed.groupBy("site").agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if(F.col("error").isNotNull()).alias("failed"),
        F.count_if(succeeded()).alias("articles"),
    )


def observed_outcomes(read: DataFrame, seen: Observation) -> DataFrame:
    """``read`` as it is; when it is written, ``seen`` gets the same figures for each site."""
    figures = []
    for site in sites.SITES:
        own = F.col("site") == site.key
        figures += [
            F.count_if(own).alias(f"{site.key}.pages"),
            F.count_if(own & F.col("error").isNotNull()).alias(f"{site.key}.failed"),
            F.count_if(own & succeeded()).alias(f"{site.key}.articles"),
        ]
    return read.observe(seen, *figures)


def outcome_rows(spark: SparkSession, seen: dict[str, int]) -> DataFrame:
    """``site``, ``pages``, ``failed``, ``articles``: a row for every site, those without pages too."""
    rows = [(s.key, *(int(seen.get(f"{s.key}.{x}") or 0) for x in ("pages", "failed", "articles"))) for s in sites.SITES]
    return spark.createDataFrame(rows, "site string, pages bigint, failed bigint, articles bigint")


def source_counts(articles: DataFrame) -> DataFrame:
    """Articles per site; a site without any counts 0. Other sources are left out."""
    spark = articles.sparkSession
    names = spark.range(1).select(F.explode(F.array(*[F.lit(s) for s in sites.SOURCES])).alias("source"))
    counts = articles.groupBy("source").agg(F.count(F.lit(1)).alias("n"))
    return names.join(counts, "source", "left").select(
        "source", F.coalesce("n", F.lit(0)).alias("article_count")
    )
