"""Aggregates over clean articles.

Each function takes articles, or the compact ``article_groups`` of them: one
scan of the articles then feeds five tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import dates, text

# Labels of missing values and the length of the keyword list.
NO_SOURCE = "Unknown"
NO_CATEGORY = "Uncategorized"
NO_LANGUAGE = "unknown"
TOP_KEYWORDS = 30


def article_groups(articles: DataFrame) -> DataFrame:
    """Counts and total length per (source, category, language, day)."""
    return articles.groupBy(
        "source",
        "category",
        "language",
        dates.publication_day(F.col("publication_date"), F.col("scraped_at")).alias("day"),
    ).agg(
        F.count(F.lit(1)).alias("group_count"),
        F.sum(F.coalesce("content_length", F.lit(0))).alias("group_length"),
    )


def _article_count(df: DataFrame) -> Column:
    counted = F.sum("group_count") if "group_count" in df.columns else F.count(F.lit(1))
    return counted.alias("article_count")


def _length_sum(df: DataFrame) -> Column:
    if "group_length" in df.columns:
        return F.sum("group_length")
    return F.sum(F.coalesce("content_length", F.lit(0)))


def articles_by_source(df: DataFrame) -> DataFrame:
    key = F.coalesce("source", F.lit(NO_SOURCE)).alias("source")
    return df.groupBy(key).agg(_article_count(df)).orderBy(F.desc("article_count"), "source")


def articles_by_category(df: DataFrame) -> DataFrame:
    key = F.coalesce(text.null_if_empty(F.col("category")), F.lit(NO_CATEGORY)).alias("category")
    return df.groupBy(key).agg(_article_count(df)).orderBy(F.desc("article_count"), "category")


def articles_by_language(df: DataFrame) -> DataFrame:
    key = F.coalesce("language", F.lit(NO_LANGUAGE)).alias("language_code")
    return (
        df.groupBy(key)
        .agg(_article_count(df))
        .select(
            "language_code", text.language_name(F.col("language_code")).alias("language"), "article_count"
        )
        .orderBy(F.desc("article_count"), "language_code")
    )


def articles_by_date(df: DataFrame) -> DataFrame:
    if "day" in df.columns:
        day = F.col("day")
    else:
        day = dates.publication_day(F.col("publication_date"), F.col("scraped_at"))
    return (
        df.filter(~text.is_blank(day))
        .groupBy(day.alias("date"))
        .agg(_article_count(df))
        .orderBy(F.desc("date"))
    )


def keywords(articles: DataFrame) -> DataFrame:
    """One row per keyword occurrence, stop words left out."""
    return articles.select(
        F.explode(text.article_tokens(F.col("content"), F.col("title"))).alias("keyword")
    ).filter(~text.is_stop_word(F.col("keyword")))


def keyword_counts(articles: DataFrame) -> DataFrame:
    """``keyword``, ``frequency``. What stands between blanks is counted first, and keywords are looked for once in each
    different one. A keyword has four letters, so shorter ones are not counted."""
    chunk = F.explode(text.article_chunks(F.col("content"), F.col("title"))).alias("chunk")
    counted = articles.select(chunk).filter(F.octet_length("chunk") >= 4).groupBy("chunk").agg(F.count(F.lit(1)).alias("n"))
    found = counted.select(F.explode(text.keyword_tokens(F.col("chunk"))).alias("keyword"), "n")
    return found.filter(~text.is_stop_word(F.col("keyword"))).groupBy("keyword").agg(F.sum("n").alias("frequency"))


def top_keywords(articles: DataFrame, n: int = TOP_KEYWORDS) -> DataFrame:
    """Most frequent keywords; equal counts go by the keyword."""
    return keyword_counts(articles).orderBy(F.desc("frequency"), "keyword").limit(n)


def summary_stats(df: DataFrame) -> DataFrame:
    """One row of totals.

    Counted per (source, language) first, so the sets are collected from that
    short list and not from the articles.
    """
    groups = df.groupBy(
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("language", F.lit("")).alias("language"),
    ).agg(_article_count(df), _length_sum(df).alias("length"))
    return groups.agg(
        F.coalesce(F.sum("article_count"), F.lit(0)).alias("total_articles"),
        F.array_sort(F.collect_set("source")).alias("sources"),
        F.array_sort(F.collect_set("language")).alias("languages"),
        F.sum("length").alias("length"),
    ).select(
        "total_articles",
        F.size("sources").cast("bigint").alias("total_sources"),
        "sources",
        "languages",
        F.coalesce(F.round(F.col("length") / F.nullif("total_articles", F.lit(0)), 1), F.lit(0.0)).alias(
            "avg_content_length"
        ),
    )
