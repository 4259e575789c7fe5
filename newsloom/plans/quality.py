"""Checking every layer of a lake, scoring it and keeping the report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators import quality as ops
from newsloom.operators.quality import ERROR, WARNING
from newsloom.operators.rows import one_row
from newsloom.plans import gold, silver, warehouse
from newsloom.settings import staged
from newsloom.sources import lake as lakes
from newsloom.sources.lake import Lake

FACTS = "lake_facts"
EVENT_LAYER, EVENTS = "streaming", "article_events"
LAYERS = ("bronze", "silver", EVENT_LAYER, "gold")
STORED_EVENT = schemas.EVENT + ", sequence bigint"


def _layer_issues(spark: SparkSession, *issues: Column) -> DataFrame:
    return spark.range(1, numPartitions=1).select(F.inline(F.array(*issues)))


def _flag(value: bool) -> Column:
    return F.lit(bool(value))


def _if_empty(rows: DataFrame, layer: str, message: str) -> DataFrame:
    issue = ops.layer_issue(F.col("n") == 0, layer, "empty_data", WARNING, message)
    return rows.limit(1).agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(issue)))


def row_marks(spark: SparkSession, lake: Lake) -> dict[str, DataFrame]:
    """What the checks find in each row of Bronze and Silver (see ``ops.mark_violations``): texts are read once for
    counts and samples."""
    marks = {}
    for layer, rows, checks in (
        ("bronze", lake.read_bronze(spark, schemas.BRONZE_ARTICLE), ops.bronze_checks),
        ("silver", silver.read_silver(spark, lake), ops.silver_checks),
    ):
        marks[layer] = staged(ops.mark_violations(rows, checks(rows), list(silver.ORDER)), f"{layer}-marks")
    return marks


def _row_issues(rows: DataFrame, checks: list[ops.Check], marks: DataFrame | None) -> DataFrame:
    return ops.count_violations(rows, checks) if marks is None else ops.count_violations(marks, ops.marked_checks(checks))


def bronze_issues(spark: SparkSession, lake: Lake, now: Column, marks: DataFrame | None = None) -> DataFrame:
    path = lake.path("bronze", "articles")
    newest = lakes.newest_file(lakes.list_files(spark, path, "*.parquet")) if lakes.exists(spark, path) else None
    # A folder without data files is as good as none.
    present = newest is not None and newest.first().path is not None
    missing = _layer_issues(
        spark, ops.layer_issue(_flag(not present), "bronze", "missing_data", ERROR, "Layer holds no data files")
    )
    if not present:
        return missing
    rows = lake.read_bronze(spark, schemas.BRONZE_ARTICLE)
    late = ops.layer_issue(
        ops.stale(F.col("modified_at"), now), "bronze", "data_freshness", WARNING, "No new file for a day"
    )
    return (
        missing.unionByName(_row_issues(rows, ops.bronze_checks(rows), marks))
        .unionByName(newest.select(F.inline(F.array(late))))
    )


def file_issues(spark: SparkSession, folder: str, layer: str, pattern: str = "*.json") -> DataFrame:
    """Unreadable files and files that hold no array, among JSON files."""
    audit = lakes.audit_article_files(spark, folder, pattern)
    checks = [
        ops.Check(layer, kind, ERROR, message, F.col("status") == kind)
        for kind, message in (("format_error", "No JSON array"), ("file_error", "Unreadable file"))
    ]
    return ops.count_violations(audit, checks)


def stored_tables(lake: Lake, layer: str) -> dict[str, str]:
    """Where the files of a layer's tables are, with their schemas."""
    if layer == "bronze":
        return {lake.path("bronze", "articles"): schemas.BRONZE_ARTICLE + ", pos bigint"}
    tables = {
        silver.LAYER: {silver.TABLE: schemas.SILVER_ARTICLE + ", file_name string, pos bigint, reason string"},
        EVENT_LAYER: {EVENTS: STORED_EVENT},
        gold.LAYER: {**schemas.GOLD_TABLES, gold.ARTICLES: schemas.SILVER_ARTICLE + ", file_name string, pos bigint"},
    }
    return {lake.run_path(layer, name, "*"): schema for name, schema in tables[layer].items()}


def table_file_issues(spark: SparkSession, lake: Lake, layer: str) -> DataFrame:
    """Parquet files of a layer that cannot be read to their end."""
    audit = lakes.audit_table_files(spark, lake.path(layer), stored_tables(lake, layer))
    check = ops.Check(layer, "file_error", ERROR, "Unreadable file", F.col("status") == "file_error")
    return ops.count_violations(audit, [check])


def silver_issues(spark: SparkSession, lake: Lake, marks: DataFrame | None = None) -> DataFrame:
    present = lake.latest_path(spark, silver.LAYER, silver.TABLE) is not None
    missing = _layer_issues(
        spark, ops.layer_issue(_flag(not present), "silver", "missing_data", ERROR, "Layer holds no data files")
    )
    if not present:
        return missing
    rows = silver.read_silver(spark, lake)
    return missing.unionByName(_row_issues(rows, ops.silver_checks(rows), marks))


def event_issues(spark: SparkSession, lake: Lake, checked_events: int | None = None) -> DataFrame:
    """Checks of the latest events: all of them, or with ``checked_events`` the first so many."""
    if not lakes.exists(spark, lake.path(EVENT_LAYER)):
        return _layer_issues(
            spark, ops.layer_issue(_flag(True), "streaming", "missing_data", WARNING, "Events were never written")
        )
    if not lake.published(spark, EVENT_LAYER):
        return _layer_issues(
            spark, ops.layer_issue(_flag(True), "streaming", "missing_latest", WARNING, "No event run is published")
        )
    events = lake.read_latest(spark, EVENT_LAYER, EVENTS, STORED_EVENT)
    if checked_events is not None:
        events = ops.first_events(events, checked_events)
    empty = _if_empty(events, "streaming", "Published event run has no rows")
    return empty.unionByName(ops.count_violations(events, ops.event_checks(events)))


def gold_issues(spark: SparkSession, lake: Lake) -> DataFrame:
    """Missing tables, empty tables, broken rows and an implausible summary."""
    flags, counted = [], []
    run_id = lake.latest_run(spark, gold.LAYER)
    tables = gold.read_all_gold(spark, lake)
    for name, rows in tables.items():
        present = run_id is not None and lakes.exists(spark, lake.run_path(gold.LAYER, name, run_id))
        flags.append(
            ops.layer_issue(_flag(not present), "gold", "missing_file", ERROR, f"Table {name} was not written")
        )
        if not present:
            continue
        if name == "summary_stats":
            counted.append(ops.count_violations(rows, ops.summary_checks(rows)))
            continue
        counted.append(_if_empty(rows, "gold", f"Table {name} has no rows"))
        checks = ops.gold_checks(rows, name)
        if checks:
            counted.append(ops.count_violations(rows, checks))
    issues = _layer_issues(spark, *flags)
    for part in counted:
        issues = issues.unionByName(part)
    return issues


def consistency_issues(bronze: int, silver_rows: int, gold_total: int | None, spark: SparkSession) -> DataFrame:
    """Row counts of the layers against each other."""
    issues = [
        ops.layer_issue(
            ops.too_few_silver(F.lit(silver_rows), F.lit(bronze)),
            "consistency", "article_count_mismatch", WARNING, "Few Bronze rows reach Silver",
        )
    ]
    if gold_total is not None:
        issues.append(
            ops.layer_issue(
                ops.summary_differs(F.lit(gold_total), F.lit(silver_rows)),
                "consistency", "summary_mismatch", WARNING, "Summary counts other rows than Silver has",
            )
        )
    return _layer_issues(spark, *issues)


def all_issues(spark: SparkSession, lake: Lake, now: Column, marks: dict[str, DataFrame] | None = None) -> DataFrame:
    """Violation counts of every check over the whole lake. ``marks``: from ``row_marks``, where they are there."""
    marks = marks or {}
    counts = {
        row.part: row.n
        for row in warehouse.count_parts(
            {
                "bronze": lake.read_bronze(spark, schemas.BRONZE_ARTICLE),
                "silver": silver.read_silver(spark, lake),
            }
        ).collect()
    }
    summary = gold.read_gold(spark, lake, "summary_stats").first()
    gold_total = None if summary is None else (summary.total_articles or 0)
    issues = (
        bronze_issues(spark, lake, now, marks.get("bronze"))
        .unionByName(silver_issues(spark, lake, marks.get("silver")))
        .unionByName(event_issues(spark, lake))
        .unionByName(gold_issues(spark, lake))
        .unionByName(consistency_issues(counts["bronze"], counts["silver"], gold_total, spark))
    )
    for layer in LAYERS:
        if lakes.exists(spark, lake.path(layer)):
            issues = issues.unionByName(table_file_issues(spark, lake, layer))
    return issues


def lake_facts(spark: SparkSession, lake: Lake) -> DataFrame:
    """``layer``, ``kind`` (``total``, ``language`` or ``source``), ``name``, ``articles``: the articles of Bronze
    and Silver in all, by language and by source, as rows of one pass. A missing value is null."""
    layers = {"bronze": lake.read_bronze(spark, schemas.BRONZE_ARTICLE), "silver": silver.read_silver(spark, lake)}
    parts = [rows.select(F.lit(layer).alias("layer"), "language", "source") for layer, rows in layers.items()]
    sets = [[F.col("layer")], [F.col("layer"), F.col("language")], [F.col("layer"), F.col("source")]]
    counted = parts[0].unionByName(parts[1]).groupingSets(sets, "layer", "language", "source").agg(
        F.grouping("language").alias("all_languages"), F.grouping("source").alias("all_sources"), F.count(F.lit(1)).alias("articles")
    )
    kind = F.when(F.col("all_languages") == 0, "language").when(F.col("all_sources") == 0, "source").otherwise("total")
    return counted.select("layer", kind.alias("kind"), F.coalesce("language", "source").alias("name"), "articles")


def lake_stats(spark: SparkSession, lake: Lake, facts: DataFrame) -> DataFrame:
    """One row: data files per layer, articles in Silver, and sources in Bronze. The counts by
    language and source are rows of a report of their own, ``FACTS``."""
    files = None
    for layer in LAYERS:
        path = lake.path(layer)
        listed = lakes.list_files(spark, path, "*.parquet") if lakes.exists(spark, path) else spark.range(0)
        one = listed.agg(F.count(F.lit(1)).alias("n")).select(F.lit(layer).alias("layer"), "n")
        files = one if files is None else files.unionByName(one)
    counted = files.agg(*[F.max(F.when(F.col("layer") == x, F.col("n"))).alias(f"{x}_files") for x in LAYERS])
    total = facts.agg(
        F.coalesce(F.sum(F.when(F.expr("layer = 'silver' AND kind = 'total'"), F.col("articles"))), F.lit(0)).alias("total_articles"),
        F.count_if(F.expr("layer = 'bronze' AND kind = 'source'")).alias("bronze_sources"),
    )
    return one_row(counted, total)


def sample_issues(spark: SparkSession, lake: Lake, marks: dict[str, DataFrame]) -> DataFrame:
    """The first issues per severity of Bronze and Silver rows, for the report."""
    parts = []
    for layer, rows, checks in (
        ("bronze", lake.read_bronze(spark, schemas.BRONZE_ARTICLE), ops.bronze_checks),
        ("silver", silver.read_silver(spark, lake), ops.silver_checks),
    ):
        parts.append(ops.sample_violations(marks[layer], ops.marked_checks(checks(rows)), list(silver.ORDER)))
    both = parts[0].unionByName(parts[1])
    return ops.first_n(both, ["severity"], ["layer", *silver.ORDER, "check_no"], ops.SAMPLES)


def quality_report(
    issues: DataFrame, samples: DataFrame | None, generated_at: Column, stats: DataFrame | None = None
) -> DataFrame:
    """One row: score, verdict, the checks that fired, sample issues and figures of the lake."""
    fired = issues.filter("violations > 0").agg(
        F.sort_array(F.collect_list(F.struct("layer", "type", "message", "severity", "violations"))).alias("issues")
    )
    parts = [ops.score_issues(issues), fired]
    if samples is not None:
        parts.append(
            samples.agg(F.collect_list(F.struct("layer", "type", "message", "severity")).alias("samples"))
        )
    if stats is not None:
        parts.append(stats.select(F.struct(*stats.columns).alias("stats")))
    return one_row(*parts).select(generated_at.cast("string").alias("generated_at"), "*")


def check_lake(
    spark: SparkSession, lake: Lake, now: Column, fail_on_poor: bool = False
) -> DataFrame:
    """Check the lake, append the report, return its row.

    Files that cannot be read count as issues and do not end the check. Their sound rows take part in
    the other checks; the audit, which reads every file to its end, tells that some are missing.
    """
    name = "spark.sql.files.ignoreCorruptFiles"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        marks = row_marks(spark, lake)
        issues = staged(all_issues(spark, lake, now, marks), "quality-issues")
        facts = staged(lake_facts(spark, lake), "lake-facts")
        report = quality_report(issues, sample_issues(spark, lake, marks), now, lake_stats(spark, lake, facts))
        report = staged(report, "quality-report")
    finally:
        spark.conf.set(name, before)
    lake.append_report(report, "quality")
    lake.append_report(facts.select(now.cast("string").alias("generated_at"), "*").coalesce(1), FACTS)
    if fail_on_poor and not report.first().acceptable:
        raise RuntimeError("data quality is poor")
    return report
