"""Output of streams: a folder per query and epoch.

Epochs count from 0 in every checkpoint. Only with the id of the query, which Spark keeps in
the checkpoint, do they name a micro-batch for good; so a replay replaces exactly its own
rows, and a new checkpoint on the same table adds to it.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark wrote to the checkpoint when the query first started."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first()[0])["id"]


def epoch_path(out: str, query: str, epoch: int) -> str:
    return f"{out}/query={query}/epoch={epoch}"


def write_epoch(rows: DataFrame, out: str, query: str, epoch: int, *partitions: str) -> None:
    """Replace the rows of a micro-batch, also those that an earlier attempt made and this one does not."""
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.parquet(epoch_path(out, query, epoch))
