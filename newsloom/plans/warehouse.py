"""Gold to the star schema of the warehouse."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions import dates, text
from newsloom.operators import events as event_ops
from newsloom.plans import gold
from newsloom.settings import staged
from newsloom.sources.lake import Lake, read_or_empty

# The key of each table.
KEYS = {
    "dim_source": "source",
    "dim_category": "category",
    "dim_language": "language_code",
    "fact_articles_by_day": "publication_day",
    "fact_keywords": "keyword",
    "fact_articles": "url_hash",
    "warehouse_summary": "id",
}
EVENT_TABLE = "streaming_article_events"
LAYER = "warehouse"
REJECTED_DAYS = "rejected_days"
_DAY = r"^\d{4}-\d{2}-\d{2}$"


def _counts(rows: DataFrame, *keys: str, count: str = "article_count") -> DataFrame:
    return rows.select(*keys, F.col(count).cast("int").alias(count))


def _day() -> Column:
    return F.when(F.col("date").rlike(_DAY), F.col("date").try_cast("date"))


def fact_articles_by_day(by_date: DataFrame) -> DataFrame:
    return by_date.select(_day().alias("publication_day"), F.col("article_count").cast("int").alias("article_count")).filter(
        F.col("publication_day").isNotNull()
    )


def rejected_days(by_date: DataFrame) -> DataFrame:
    """Days that are no dates; a DATE column cannot hold them."""
    return by_date.filter(_day().isNull())


def fact_articles(articles: DataFrame) -> DataFrame:
    return articles.filter(~text.is_blank(F.col("url"))).select(
        text.url_hash(F.col("url")).alias("url_hash"),
        "url",
        F.coalesce("title", F.lit("")).alias("title"),
        "author",
        dates.parse_datetime(F.col("publication_date")).alias("publication_date"),
        "category",
        "content",
        "content_length",
        "source",
        "language",
        dates.parse_datetime(F.col("scraped_at")).alias("scraped_at"),
        dates.parse_datetime(F.col("processed_at")).alias("processed_at"),
    )


def warehouse_summary(summary: DataFrame) -> DataFrame:
    """One row with id 1; without a summary all figures are 0."""
    return summary.agg(
        F.max("total_articles").alias("total_articles"),
        F.max("total_sources").alias("total_sources"),
        F.max("avg_content_length").alias("avg_content_length"),
        F.max("generated_at").alias("generated_at"),
    ).select(
        F.lit(1).cast("tinyint").alias("id"),
        F.coalesce("total_articles", F.lit(0)).cast("int").alias("total_articles"),
        F.coalesce("total_sources", F.lit(0)).cast("int").alias("total_sources"),
        F.coalesce("avg_content_length", F.lit(0.0)).cast("decimal(12,2)").alias("avg_content_length"),
        dates.parse_datetime(F.col("generated_at")).alias("generated_at"),
    )


def star_schema(gold_rows: dict[str, DataFrame], articles: DataFrame) -> dict[str, DataFrame]:
    """The seven tables, without their load stamp."""
    return {
        "dim_source": _counts(gold_rows["articles_by_source"], "source"),
        "dim_category": _counts(gold_rows["articles_by_category"], "category"),
        "dim_language": _counts(gold_rows["articles_by_language"], "language_code", "language"),
        "fact_articles_by_day": fact_articles_by_day(gold_rows["articles_by_date"]),
        "fact_keywords": _counts(gold_rows["top_keywords"], "keyword", count="frequency"),
        "fact_articles": fact_articles(articles),
        "warehouse_summary": warehouse_summary(gold_rows["summary_stats"]),
    }


def require_unique(rows: DataFrame, key: str, table: str) -> None:
    """Fail the load when a key repeats.

    Short hashes are grouped first: if none repeats, no key does. Only keys of
    repeated hashes are then compared in full.
    """
    code = F.xxhash64(key)
    repeated_codes = rows.groupBy(code.alias("code")).count().filter("count > 1").select("code")
    if repeated_codes.isEmpty():
        return
    suspects = rows.select(key, code.alias("code")).join(repeated_codes, "code", "left_semi")
    repeated = suspects.groupBy(key).count().filter("count > 1").select(key).first()
    if repeated is not None:
        raise ValueError(f"{table}: key {repeated[0]!r} is not unique")


def load_warehouse(spark: SparkSession, lake: Lake, run_id: str, loaded_at: Column) -> dict[str, int]:
    """Full refresh: write all seven tables of the run, then make them current.

    A failure before the end leaves the previous load in place.
    """
    gold_rows = gold.read_all_gold(spark, lake)
    articles = lake.read_latest(spark, gold.LAYER, gold.ARTICLES, schemas.SILVER_ARTICLE)
    tables = star_schema(gold_rows, articles)
    tables[REJECTED_DAYS] = rejected_days(gold_rows["articles_by_date"])
    stamp = loaded_at.cast("timestamp_ntz").alias("loaded_at")
    stamped = {name: rows.select("*", stamp) for name, rows in tables.items()}
    lake.write_tables(stamped, LAYER, run_id)
    for name, key in KEYS.items():
        schema = schemas.WAREHOUSE_TABLES[name]
        require_unique(spark.read.schema(schema).parquet(lake.run_path(LAYER, name, run_id)), key, name)
    lake.publish(spark, LAYER, run_id)
    return load_stats(gold_rows, articles)


def load_stats(gold_rows: dict[str, DataFrame], articles: DataFrame) -> dict[str, int]:
    """Rows offered to the load, counted on the Gold side."""
    counted = {
        "articles": articles,
        "sources": gold_rows["articles_by_source"],
        "categories": gold_rows["articles_by_category"],
        "languages": gold_rows["articles_by_language"],
        "dates": gold_rows["articles_by_date"],
        "keywords": gold_rows["top_keywords"],
    }
    return {row.part: row.n for row in count_parts(counted).collect()}


def count_parts(parts: dict[str, DataFrame]) -> DataFrame:
    """Row count of several frames: one row per frame."""
    counts = None
    for part, rows in parts.items():
        one = rows.agg(F.count(F.lit(1)).alias("n")).select(F.lit(part).alias("part"), "n")
        counts = one if counts is None else counts.unionByName(one)
    return counts


def read_warehouse(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    schema = schemas.WAREHOUSE_TABLES[name] + ", loaded_at timestamp_ntz"
    return lake.read_latest(spark, LAYER, name, schema)


def write_jdbc(rows: DataFrame, table: str, url: str, properties: dict[str, str], tasks: int = 16) -> None:
    """Refresh one table of a database, keeping its definition.

    ``tasks`` bounds the connections the database sees at once.
    """
    jdbc_writer(rows, table, url, properties, tasks).save()


def jdbc_writer(rows: DataFrame, table: str, url: str, properties: dict[str, str], tasks: int = 16):
    options = {
        "url": url,
        "dbtable": table,
        "truncate": "true",
        "batchsize": "10000",
        "numPartitions": str(tasks),
        **properties,
    }
    return rows.write.format("jdbc").options(**options).mode("overwrite")


def upsert_events(spark: SparkSession, lake: Lake, events: DataFrame, batch_id: str, loaded_at: Column) -> None:
    """Merge the events of one batch into the event table.

    The batch is part of every event id, so only the batch's own partition can
    hold the same keys: that one is read, merged, staged and replaced, whatever
    the size of the table.
    """
    path = lake.path(LAYER, EVENT_TABLE)
    known = read_or_empty(spark, path, schemas.WAREHOUSE_EVENT).filter(F.col("batch_id") == batch_id)
    merged = event_ops.upsert(known, event_ops.warehouse_events(events, loaded_at))
    staged(merged, "event-merge").write.partitionBy("batch_id").option(
        "partitionOverwriteMode", "dynamic"
    ).mode("overwrite").parquet(path)
