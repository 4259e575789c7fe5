"""One run over all layers, and its report."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators import crawl
from newsloom.plans import bronze, gold, quality, silver, warehouse
from newsloom.sources.lake import Lake
from newsloom.streaming import publish

STEPS = ("bronze", "silver", "streaming", "gold", "warehouse", "quality", "dashboard")
CRAWLS = "crawls"
REPORT = "step string, status string, seconds double, counters map<string,double>, error string"


@dataclass(frozen=True)
class Crawl:
    """What a crawl fetched, and bounds on what is taken from it (none by default)."""

    listings: DataFrame  # site, category_rank, html
    items: DataFrame  # as from ``read_feeds``
    pages: DataFrame  # page_id, url, html
    per_source: int | None = None
    links_per_listing: int | None = None
    max_content: int | None = None

    def articles(self, scraped_at: Column, seen: Observation | None = None) -> DataFrame:
        return bronze.bronze_articles(
            self.listings, self.items, self.pages, scraped_at, seen=seen,
            per_source=self.per_source, links_per_listing=self.links_per_listing, max_content=self.max_content,
        )


def run_lake(
    spark: SparkSession,
    lake: Lake,
    articles: DataFrame | Crawl | None = None,
    *,
    now: datetime | None = None,
    skip: tuple[str, ...] = (),
    force: bool = False,
) -> bool:
    """Bronze, silver, streaming, gold, warehouse, quality, dashboard, in this order.

    ``articles`` are new raw articles with ``pos``, or a crawl to make them from; without
    them Bronze is left as it is. What became of the pages of each site of a crawl is in the step's
    counters and in a report of its own. A failing step ends the run unless ``force`` is set; the
    dashboard is only made when all went well. Every step leaves a row in the run report.
    Returns whether all steps went well.
    """
    now = now or datetime.now(timezone.utc)
    run_id = now.strftime("%Y%m%d_%H%M%S")
    stamp = F.lit(now.strftime("%Y-%m-%dT%H:%M:%S"))

    def add_bronze() -> dict:
        outcomes = {}
        if isinstance(articles, Crawl):
            seen = Observation("pages of a crawl")
            lake.add_bronze(articles.articles(stamp, seen), run_id)
            outcomes = seen.get
            lake.append_report(crawl.outcome_rows(spark, outcomes).withColumn("execution_time", stamp).coalesce(1), CRAWLS)
        else:
            lake.add_bronze(articles, run_id)
        added = lake.read_bronze(spark, schemas.BRONZE_ARTICLE, run_id)
        counts = {r.source: r.article_count for r in crawl.source_counts(added).collect()}
        return {"articles": added.count(), **counts, **outcomes}

    def check() -> dict:
        report = quality.check_lake(spark, lake, stamp.cast("timestamp")).first()
        return {"score": report.quality_score}

    def load() -> dict:
        stats = warehouse.load_warehouse(spark, lake, run_id, stamp)
        return {"tables": len(warehouse.KEYS), **stats}

    jobs: dict[str, Callable[[], dict]] = {
        "bronze": add_bronze,
        "silver": lambda: silver.build_silver(spark, lake, run_id, stamp),
        "streaming": lambda: publish.publish_batch(spark, lake, run_id, stamp),
        "gold": lambda: {"tables": gold.build_gold(spark, lake, run_id, stamp)},
        "warehouse": load,
        "quality": check,
        "dashboard": lambda: {"tables": gold.build_dashboard(spark, lake, run_id)},
    }
    if articles is None:
        skip = (*skip, "bronze")
    rows = []
    for step in STEPS:
        if step == "dashboard" and any(row[1] == "failed" for row in rows):
            break
        rows.append(_run_step(step, jobs[step], step in skip))
        if rows[-1][1] == "failed" and not force:
            break
    done = {row[0] for row in rows}
    rows += [(step, "pending", 0.0, {}, None) for step in STEPS if step not in done]
    success = all(row[1] in ("completed", "skipped") for row in rows)
    report = spark.createDataFrame(rows, REPORT).select(
        stamp.alias("execution_time"), "*", F.lit(success).alias("success")
    )
    lake.append_report(report.coalesce(1), "runs")
    return success


def _run_step(step: str, job: Callable[[], dict], skipped: bool) -> tuple:
    if skipped:
        return step, "skipped", 0.0, {}, None
    started = time.monotonic()
    try:
        counters = {k: float(v) for k, v in job().items() if isinstance(v, (int, float))}
        return step, "completed", round(time.monotonic() - started, 2), counters, None
    except Exception as error:
        return step, "failed", round(time.monotonic() - started, 2), {}, str(error)
