"""Publishing clean articles as events, in batch and as a stream.

Both use the same event columns. In a stream the batch of an event is the file name of
its article and its number the article's place there, so event ids depend neither on how
much a micro-batch takes nor on replays.
"""

from __future__ import annotations

import logging
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from newsloom import schemas
from newsloom.operators.events import build_events
from newsloom.operators.sequence import number_rows
from newsloom.plans import gold, silver, warehouse
from newsloom.plans.quality import EVENT_LAYER, EVENTS
from newsloom.sources.lake import Lake
from newsloom.streaming import epochs

logger = logging.getLogger(__name__)


def batch_events(articles: DataFrame, batch_id: str, event_time: Column, stored: bool = False) -> DataFrame:
    """Events of one batch; articles carry ``file_name`` and ``pos``. ``stored``: see ``number_rows``."""
    file, pos = silver.ORDER
    return build_events(number_rows(articles, file, pos, stored=stored), F.lit(batch_id), event_time)


def latest_articles(spark: SparkSession, lake: Lake) -> DataFrame:
    """Latest Silver articles, else the copy kept in Gold."""
    if lake.latest_path(spark, silver.LAYER, silver.TABLE) is not None:
        return silver.read_silver(spark, lake)
    stored = schemas.SILVER_ARTICLE + ", file_name string, pos bigint"
    return lake.read_latest(spark, gold.LAYER, gold.ARTICLES, stored)


def publish_batch(spark: SparkSession, lake: Lake, batch_id: str, now: Column) -> dict:
    """Write one event batch to the lake and mirror it in the warehouse.

    The lake write is the commit point; a failing mirror is reported, not raised.
    """
    events = batch_events(latest_articles(spark, lake), batch_id, now, stored=True)
    lake.write_run(events, EVENT_LAYER, EVENTS, batch_id)
    stored = spark.read.schema(events.schema).parquet(lake.run_path(EVENT_LAYER, EVENTS, batch_id))
    count = stored.count()
    if count == 0:
        raise RuntimeError("no articles to publish")
    lake.publish(spark, EVENT_LAYER, batch_id)
    try:
        warehouse.upsert_events(spark, lake, stored, batch_id, now)
        mirrored = True
    except Exception as error:  # the mirror must not fail the publication
        logger.warning("event mirror failed: %s", error)
        mirrored = False
    return {"batch_id": batch_id, "event_count": count, "warehouse_loaded": mirrored}


def read_article_stream(
    spark: SparkSession, folder: str, schema: str, pattern: str = "*.parquet",
    batch_bytes: int | None = None, batch_files: int | None = None,
) -> DataFrame:
    """Stream of the files of a folder; with ``batch_bytes`` or ``batch_files`` at most so many per
    micro-batch (but one file at least). Results do not depend on it."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if batch_bytes is not None:
        reader = reader.option("maxBytesPerTrigger", str(batch_bytes))
    elif batch_files is not None:
        reader = reader.option("maxFilesPerTrigger", str(batch_files))
    return reader.parquet(folder)


def stream_events(articles: DataFrame, event_time: Column) -> DataFrame:
    """Events of articles as they come: ``batch_id`` is the ``file_name``, ``sequence`` the
    1-based place in it."""
    file, pos = silver.ORDER
    return build_events(articles.withColumn("sequence", F.col(pos) + 1), F.col(file), event_time)


def publish_stream(
    articles: DataFrame, out: str, checkpoint: str, event_time: Column | None = None
) -> StreamingQuery:
    """Write the events of a stream of articles under ``out``, a folder per query and epoch.

    Runs over what is there now and stops; the next start goes on from there.
    """

    def write(rows: DataFrame, epoch: int) -> None:
        stamp = event_time if event_time is not None else F.lit(
            datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S+00:00")
        )
        epochs.write_epoch(stream_events(rows, stamp), out, epochs.query_id(rows.sparkSession, checkpoint), epoch)

    return (
        articles.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
