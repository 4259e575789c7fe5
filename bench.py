"""Seconds per headline query; prints one JSON line.

Each query runs once to warm up and then ``BENCH_RUNS`` times (median). Results
go to the no-op sink, which computes every column of every row.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from newsloom.settings import session_options  # noqa: E402
from registry.queries import QUERIES  # noqa: E402

HEADLINE = """
normalize_text normalize_date tokenize
dedup_articles silver_articles silver_build
articles_by_source articles_by_date top_keywords summary_stats
wh_fact_articles event_sequence event_upsert stream_publish
page_links top_links_per_page page_body page_articles bronze_build
rss_items dq_q3_bronze_required lake_run
stream_dedup_exact crawl_cap sample_articles crawl_to_gold
""".split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("newsloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in session_options().items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in names:
        timings = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            timings.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(timings[1:] or timings), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "sum of median seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(os.path.basename(sf_dir.rstrip("/")).removeprefix("sf") or 0),
            }
        )
    )


if __name__ == "__main__":
    main()
