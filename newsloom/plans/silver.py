"""Bronze to Silver: first copy per URL, cleaned, checked."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators import articles as ops
from newsloom.operators.ranking import keep_first_by_url
from newsloom.settings import staged
from newsloom.sources.lake import Lake, exists

LAYER, TABLE = "silver", "articles"
# Beside the rows of a run: old rows that are no longer valid, runs that it goes on from, and Bronze runs in it.
SUPERSEDED, PARTS, INPUTS = "superseded", "parts", "inputs"
MOST_PARTS = 16
ORDER = ("file_name", "pos")
STORED = schemas.SILVER_ARTICLE + ", file_name string, pos bigint, reason string, accepted boolean"


def check_articles(raw: DataFrame, processed_at: Column) -> DataFrame:
    """Cleaned articles with the ``reason`` of each.

    Deduplication comes before the checks: an invalid first copy suppresses
    later good ones.
    """
    kept = keep_first_by_url(raw, list(ORDER))
    return ops.with_reason(ops.clean(kept, processed_at, keep=ORDER))


def silver_stats(raw: DataFrame, checked: DataFrame) -> DataFrame:
    """One row: total, valid, invalid, duplicate."""
    kept = checked.groupBy((F.col("reason") == "ok").alias("valid")).agg(F.count(F.lit(1)).alias("n"))
    seen = raw.select(F.lit(None).cast("boolean").alias("valid")).groupBy("valid").agg(
        F.count(F.lit(1)).alias("n")
    )

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    valid = F.col("valid")
    return (
        kept.unionByName(seen)
        .agg(
            total(valid.isNull()).alias("total"),
            total(valid).alias("valid"),
            total(~valid).alias("invalid"),
        )
        .withColumn("duplicate", F.col("total") - F.col("valid") - F.col("invalid"))
    )


def rejects_by_reason(checked: DataFrame) -> DataFrame:
    return ops.rejected(checked).groupBy("reason").agg(F.count(F.lit(1)).alias("rejected"))


def build_silver(spark: SparkSession, lake: Lake, run_id: str, processed_at: Column, full: bool = False) -> dict[str, int]:
    """Write one Silver run and make it the latest. Returns counts of the lake, and how many articles were ``cleaned``.

    Where Silver has a run already, only Bronze runs that it does not know are cleaned; the new run
    lists the runs whose rows it goes on from. The rows are those of a full build: of a URL that is in old and
    new Bronze runs the first copy counts, and where that is a new one the old row is put on a list
    of superseded rows. After ``MOST_PARTS`` runs the rows are written together. Everything is cleaned again with
    ``full``, and when a Bronze run was repeated or removed or a Silver run id comes again.
    """
    inputs = lake.bronze_runs(spark)
    before = None if full else _growing(spark, lake, run_id, inputs)
    if before is None:
        parts, superseded, fresh = [], None, lake.read_bronze(spark, schemas.BRONZE_ARTICLE)
        rows = keep_first_by_url(fresh, list(ORDER))
    else:
        parts = _parts(spark, lake, before)
        known = _entries(lake.read_list(spark, LAYER, before, INPUTS))
        fresh = lake.read_bronze(spark, schemas.BRONZE_ARTICLE, [r for r in inputs if r not in known])
        rows, superseded = _new_articles(fresh, _read_parts(spark, lake, parts))
    cleaned = Observation("cleaned articles")
    checked = ops.with_reason(ops.clean(rows, processed_at, keep=ORDER))
    # Taken in the tasks that write, of which each counts once, however often others are repeated.
    checked = checked.observe(cleaned, F.count(F.lit(1)).alias("n"))
    if len(parts) >= MOST_PARTS:
        whole = _without(_read_parts(spark, lake, parts), superseded).drop("accepted")
        write_checked(lake, whole.unionByName(checked), run_id)
        parts, superseded = [], None
    else:
        write_checked(lake, checked, run_id)
    if superseded is not None and not superseded.isEmpty():
        lake.write_run(superseded, LAYER, SUPERSEDED, run_id)
    lake.write_list(spark, LAYER, run_id, PARTS, [*parts, run_id])
    lake.write_list(spark, LAYER, run_id, INPUTS, [f"{stamp}@{run}" for run, stamp in sorted(inputs.items())])
    lake.publish(spark, LAYER, run_id)
    raw = lake.read_bronze(spark, schemas.BRONZE_ARTICLE)
    return {**silver_stats(raw, read_checked(spark, lake)).first().asDict(), "cleaned": cleaned.get.get("n") or 0}


def _entries(inputs: list[str]) -> dict[str, str]:
    return {run: stamp for stamp, _, run in (x.partition("@") for x in inputs)}


def _growing(spark: SparkSession, lake: Lake, run_id: str, inputs: dict[str, str]) -> str | None:
    """The latest Silver run, if a new one can go on from it."""
    before = lake.latest_run(spark, LAYER)
    if before is None:
        return None
    known = _entries(lake.read_list(spark, LAYER, before, INPUTS))
    same = bool(known) and all(inputs.get(run) == stamp for run, stamp in known.items())
    return before if same and run_id not in _parts(spark, lake, before) else None


def _new_articles(fresh: DataFrame, old: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The first copies of new articles that count, and ``file_name``, ``pos`` of old rows they take the place of.

    Old rows are looked up by the URLs of the new ones, on three narrow columns."""
    url = F.coalesce("url", F.lit("")).alias("key")
    keys = keep_first_by_url(fresh.select("url", *ORDER), list(ORDER)).select(url, F.struct(*ORDER).alias("place"))
    keys = staged(keys, "new-keys")
    known = old.select(url, F.struct(*ORDER).alias("old")).join(keys.select("key"), "key", "left_semi")
    met = staged(keys.join(known, "key").withColumn("first", F.col("place") < F.col("old")), "met-keys")
    rows = keep_first_by_url(fresh, list(ORDER)).withColumn("key", url)
    rows = rows.join(met.filter("not first").select("key"), "key", "left_anti").drop("key")
    return rows, met.filter("first").select("old.*")


def _without(rows: DataFrame, superseded: DataFrame | None) -> DataFrame:
    return rows if superseded is None else rows.join(superseded, list(ORDER), "left_anti").select(rows.columns)


def _parts(spark: SparkSession, lake: Lake, run_id: str) -> list[str]:
    """The runs whose rows make up a run, itself last."""
    return lake.read_list(spark, LAYER, run_id, PARTS) or [run_id]


def _read_parts(spark: SparkSession, lake: Lake, parts: list[str]) -> DataFrame:
    # Each run is a table of its own, with its own partitions.
    rows = reduce(DataFrame.unionByName, [spark.read.schema(STORED).parquet(lake.run_path(LAYER, TABLE, p)) for p in parts])
    gone = [p for p in (lake.run_path(LAYER, SUPERSEDED, part) for part in parts) if exists(spark, p)]
    lists = [spark.read.schema("file_name string, pos bigint").parquet(p) for p in gone]
    return _without(rows, reduce(DataFrame.unionByName, lists) if lists else None)


def write_checked(lake: Lake, checked: DataFrame, run_id: str) -> None:
    """Accepted and rejected rows go to two folders in one pass; reading either
    is a partition filter."""
    split = checked.withColumn("accepted", F.col("reason") == "ok")
    lake.write_run(split, LAYER, TABLE, run_id, "accepted")


def read_checked(spark: SparkSession, lake: Lake) -> DataFrame:
    """Rows of the latest run with their reasons; none where Silver was never written."""
    run_id = lake.latest_run(spark, LAYER)
    if run_id is None or not exists(spark, lake.run_path(LAYER, TABLE, run_id)):
        return lake.read_latest(spark, LAYER, TABLE, STORED)
    return _read_parts(spark, lake, _parts(spark, lake, run_id))


def read_silver(spark: SparkSession, lake: Lake) -> DataFrame:
    """Accepted articles of the latest run, with their place in Bronze."""
    return read_checked(spark, lake).filter("accepted").drop("accepted", "reason")
