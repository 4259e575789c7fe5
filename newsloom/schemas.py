"""Declared schemas of every layer. Readers always get one; nothing is inferred.

A missing key, a JSON null and SQL NULL are the same thing in all of them.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

RSS_ITEM = "title string, url string, publication_date string, description string, category string"

PAGE = "page_id bigint, url string, html string"

BRONZE_ARTICLE = (
    "title string, author string, publication_date string, category string, content string, "
    "source string, url string, language string, scraped_at string"
)

SILVER_ARTICLE = (
    "title string, author string, publication_date string, category string, content string, "
    "content_length int, source string, url string, language string, scraped_at string, "
    "processed_at string"
)

EVENT = (
    "event_id string, event_type string, event_time string, batch_id string, source string, "
    "url string, title string, publication_date string, language string, category string, "
    f"payload struct<{', '.join(':'.join(f.split()) for f in SILVER_ARTICLE.split(', '))}>"
)

GOLD_TABLES = {
    "articles_by_source": "source string, article_count bigint",
    "articles_by_category": "category string, article_count bigint",
    "articles_by_language": "language_code string, language string, article_count bigint",
    "articles_by_date": "date string, article_count bigint",
    "top_keywords": "keyword string, frequency bigint",
    "summary_stats": (
        "total_articles bigint, total_sources bigint, sources array<string>, "
        "languages array<string>, avg_content_length double, generated_at string"
    ),
}

WAREHOUSE_TABLES = {
    "dim_source": "source string, article_count int",
    "dim_category": "category string, article_count int",
    "dim_language": "language_code string, language string, article_count int",
    "fact_articles_by_day": "publication_day date, article_count int",
    "fact_keywords": "keyword string, frequency int",
    "fact_articles": (
        "url_hash string, url string, title string, author string, "
        "publication_date timestamp_ntz, category string, content string, content_length int, "
        "source string, language string, scraped_at timestamp_ntz, processed_at timestamp_ntz"
    ),
    "warehouse_summary": (
        "id tinyint, total_articles int, total_sources int, avg_content_length decimal(12,2), "
        "generated_at timestamp_ntz"
    ),
}

WAREHOUSE_EVENT = (
    "event_id string, event_type string, event_time timestamp_ntz, batch_id string, "
    "source string, url_hash string, url string, title string, "
    "publication_date timestamp_ntz, language string, category string, loaded_at timestamp_ntz"
)

QUALITY_ISSUE = "layer string, type string, message string, severity string, timestamp string"


def names(schema: str) -> list[str]:
    """Top-level column names of a schema string."""
    return StructType.fromDDL(schema).names
