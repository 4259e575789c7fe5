"""Article events: building them and merging them into the event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions import dates, text

# Fixed values.
EVENT_TYPE = "article_published"


def event_id(batch_id: Column, sequence: Column, url: Column) -> Column:
    return F.sha2(
        F.concat_ws(":", batch_id, sequence.cast("string"), F.coalesce(url, F.lit(""))), 256
    )


def build_events(articles: DataFrame, batch_id: Column, event_time: Column, sequence: str = "sequence") -> DataFrame:
    """One event per numbered article; the article itself is the payload."""
    payload = F.struct(*[F.col(c) for c in schemas.names(schemas.SILVER_ARTICLE)])
    return articles.select(
        event_id(batch_id, F.col(sequence), F.col("url")).alias("event_id"),
        F.lit(EVENT_TYPE).alias("event_type"),
        event_time.cast("string").alias("event_time"),
        batch_id.alias("batch_id"),
        "source",
        F.coalesce("url", F.lit("")).alias("url"),
        "title",
        "publication_date",
        "language",
        "category",
        payload.alias("payload"),
        F.col(sequence).alias("sequence"),
    )


def warehouse_events(events: DataFrame, loaded_at: Column) -> DataFrame:
    """Event rows in warehouse types; rows without a URL are left out."""
    return events.filter(~text.is_blank(F.col("url"))).select(
        "event_id",
        "event_type",
        dates.parse_datetime(F.col("event_time")).alias("event_time"),
        "batch_id",
        "source",
        text.url_hash(F.col("url")).alias("url_hash"),
        "url",
        "title",
        dates.parse_datetime(F.col("publication_date")).alias("publication_date"),
        "language",
        "category",
        loaded_at.cast("timestamp_ntz").alias("loaded_at"),
    )


def upsert(existing: DataFrame, incoming: DataFrame, key: str = "event_id") -> DataFrame:
    """Insert new keys; for a known key only ``loaded_at`` moves on.

    Keys are unique in ``existing``. The incoming rows are counted per key by hash; known
    keys take the newest stamp by a join, new ones come in as they are. Only keys that
    repeat within the batch are ordered by all of their row, so that the result
    does not depend on which copy arrives first.
    """
    rest = [c for c in existing.columns if c not in (key, "loaded_at")]
    counts = incoming.groupBy(key).agg(F.count(F.lit(1)).alias("_copies"), F.max("loaded_at").alias("_loaded"))
    known = existing.join(counts, key, "left").withColumn("loaded_at", F.greatest("loaded_at", "_loaded"))
    fresh = incoming.join(existing.select(key), key, "left_anti").join(counts, key)
    once = fresh.filter(F.col("_copies") == 1)
    first = F.min(F.struct("loaded_at", *rest)).alias("first")
    repeated = (
        fresh.filter(F.col("_copies") > 1)
        .groupBy(key)
        .agg(first, F.max("_loaded").alias("loaded_at"))
        .select(key, *[F.col(f"first.{c}").alias(c) for c in rest], "loaded_at")
    )
    columns = existing.columns
    return known.select(columns).unionByName(once.select(columns)).unionByName(repeated.select(columns))
