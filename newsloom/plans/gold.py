"""Silver to Gold: six aggregates and a copy of the articles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators import aggregates
from newsloom.operators.ranking import sample_files
from newsloom.plans.silver import ORDER, read_silver
from newsloom.settings import staged
from newsloom.sources.lake import Lake

LAYER, ARTICLES, DASHBOARD = "gold", "articles", "dashboard"


def gold_tables(articles: DataFrame, groups: DataFrame, generated_at: Column) -> dict[str, DataFrame]:
    """The six aggregates; five come from the compact groups."""
    return {
        "articles_by_source": aggregates.articles_by_source(groups),
        "articles_by_category": aggregates.articles_by_category(groups),
        "articles_by_language": aggregates.articles_by_language(groups),
        "articles_by_date": aggregates.articles_by_date(groups),
        "top_keywords": aggregates.top_keywords(articles),
        "summary_stats": aggregates.summary_stats(groups).withColumn(
            "generated_at", generated_at.cast("string")
        ),
    }


def build_gold(
    spark: SparkSession, lake: Lake, run_id: str, generated_at: Column, copy_articles: bool = True
) -> int:
    """Write all Gold tables of a run, then make them the latest. Returns the
    number of tables; without Silver rows nothing is written."""
    articles = read_silver(spark, lake)
    groups = staged(aggregates.article_groups(articles), "article-groups")
    if groups.isEmpty():
        return 0
    tables = gold_tables(articles, groups, generated_at)
    written = dict(tables)
    if copy_articles:
        written[ARTICLES] = articles
    lake.write_tables(written, LAYER, run_id)
    lake.publish(spark, LAYER, run_id)
    return len(tables)


def read_gold(spark: SparkSession, lake: Lake, name: str) -> DataFrame:
    """A Gold table, or no rows when it was never built."""
    return lake.read_latest(spark, LAYER, name, schemas.GOLD_TABLES[name])


def read_all_gold(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """All six tables of the latest run."""
    run_id = lake.latest_run(spark, LAYER)
    return {
        name: lake.read_run(spark, LAYER, name, run_id, schema)
        for name, schema in schemas.GOLD_TABLES.items()
    }


def dashboard_tables(tables: dict[str, DataFrame], sample: DataFrame) -> dict[str, DataFrame]:
    """What a dashboard shows, as tables: the summary, counts, keywords and sample articles."""
    return {
        "summary": tables["summary_stats"],
        "by_source": tables["articles_by_source"],
        "by_language": tables["articles_by_language"],
        "by_date": tables["articles_by_date"],
        "keywords": tables["top_keywords"],
        "articles": sample,
    }


def build_dashboard(spark: SparkSession, lake: Lake, run_id: str) -> int:
    """Write the dashboard tables of a run and make them current; returns their number."""
    file, pos = ORDER
    sample = sample_files(read_silver(spark, lake), file, pos)
    tables = dashboard_tables(read_all_gold(spark, lake), sample)
    lake.write_tables(tables, DASHBOARD, run_id)
    lake.publish(spark, DASHBOARD, run_id)
    return len(tables)


def read_dashboard(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """The dashboard tables of the latest run."""
    run_id = lake.latest_run(spark, DASHBOARD)
    schemas_of = {
        "summary": schemas.GOLD_TABLES["summary_stats"],
        "by_source": schemas.GOLD_TABLES["articles_by_source"],
        "by_language": schemas.GOLD_TABLES["articles_by_language"],
        "by_date": schemas.GOLD_TABLES["articles_by_date"],
        "keywords": schemas.GOLD_TABLES["top_keywords"],
        "articles": schemas.SILVER_ARTICLE + ", file_name string, pos bigint",
    }
    return {name: lake.read_run(spark, DASHBOARD, name, run_id, schema) for name, schema in schemas_of.items()}
