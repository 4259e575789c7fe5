"""Cleaning and validity of articles."""

from __future__ import annotations

from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions import dates, text

# Least lengths of a valid article, in characters after cleaning.
MIN_TITLE = 5
MIN_CONTENT = 50


@cache
def _clean_texts() -> Column:
    """Title, author, category and content, cleaned. Built once: it is long."""
    return F.transform(F.array("title", "author", "category", "content"), text.normalize_text)


@cache
def _clean_date() -> Column:
    return dates.normalize_date(F.col("publication_date"), F.col("scraped_at"))


def clean(raw: DataFrame, processed_at: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """Silver columns of each raw article; ``keep`` names extra columns to carry.

    ``inline`` binds the cleaned values to columns, so that later filters read
    them instead of repeating the cleaning in the filter and in the output.
    """
    bound = raw.select(
        F.inline(
            F.array(F.struct(_clean_texts().alias("texts"), _clean_date().alias("publication_date")))
        ),
        F.coalesce("source", F.lit("")).alias("source"),
        F.coalesce("url", F.lit("")).alias("url"),
        "language",
        "scraped_at",
        *keep,
    )
    cleaned = bound.select(
        F.col("texts")[0].alias("title"),
        text.null_if_empty(F.col("texts")[1]).alias("author"),
        "publication_date",
        text.null_if_empty(F.col("texts")[2]).alias("category"),
        F.col("texts")[3].alias("content"),
        "source",
        "url",
        "language",
        "scraped_at",
        *keep,
    )
    return cleaned.select(
        "title",
        "author",
        "publication_date",
        "category",
        "content",
        F.length("content").alias("content_length"),
        "source",
        "url",
        text.language_or_detect(F.col("language"), F.col("content"), F.col("source")).alias("language"),
        "scraped_at",
        processed_at.cast("string").alias("processed_at"),
        *keep,
    )


@cache
def rejection_reason() -> Column:
    """First failing rule of a cleaned article, or ``ok``."""
    return (
        F.when(text.is_blank(F.col("title")), "missing_title")
        .when(F.length("title") < MIN_TITLE, "title_too_short")
        .when(text.is_blank(F.col("content")), "missing_content")
        .when(F.length("content") < MIN_CONTENT, "content_too_short")
        .when(text.is_blank(F.col("url")), "missing_url")
        .otherwise("ok")
    )


def with_reason(cleaned: DataFrame) -> DataFrame:
    return cleaned.withColumn("reason", rejection_reason())


def accepted(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reason") == "ok").drop("reason")


def rejected(checked: DataFrame) -> DataFrame:
    return checked.filter(F.col("reason") != "ok")
