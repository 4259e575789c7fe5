"""Data-quality checks as one pass of counters per layer.

A check is a condition on a row. Counting is a single aggregation however many
checks there are and however often they fire; a row per violation never exists.
A few sample messages per severity come from a top-n over the violations. Where both are wanted, one
pass leaves a bit per check beside the place of each row, and they are taken from that.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.functions.dates import parse_datetime
from newsloom.functions.text import is_blank
from newsloom.operators.ranking import first_n

WARNING = "WARNING"
ERROR = "ERROR"

# What each layer must hold, and how issues weigh.
BRONZE_REQUIRED = ("title", "content", "url", "source")
SILVER_REQUIRED = ("title", "content", "url", "source", "language", "processed_at")
EVENT_REQUIRED = ("event_id", "event_type", "event_time", "batch_id", "url", "payload")
SUMMARY_REQUIRED = ("total_articles", "total_sources", "generated_at")
GOLD_STRUCTURE = {
    "articles_by_source": ("source", "article_count"),
    "articles_by_category": (),
    "articles_by_language": ("language", "article_count"),
    "articles_by_date": (),
    "top_keywords": ("keyword", "frequency"),
}
LANGUAGES = ("en", "ar", "fr")
SHORT_CONTENT = 100
FRESH_HOURS = 24
CHECKED_EVENTS = 50
LEAST_SILVER_SHARE = 0.8
SUMMARY_TOLERANCE = 5
ERROR_WEIGHT = 10
WARNING_WEIGHT = 2
WORST_WEIGHT = 50
EXCELLENT = 90
ACCEPTABLE = 75
SAMPLES = 5


@dataclass(frozen=True)
class Check:
    layer: str
    type: str
    severity: str
    message: str
    condition: Column  # true where the row violates the check


def _missing(df: DataFrame, field: str) -> Column:
    """Absent, NULL and empty are the same."""
    if dict(df.dtypes)[field] == "string":
        return is_blank(F.col(field))
    return F.col(field).isNull()


def _required(df: DataFrame, layer: str, fields: tuple[str, ...], what: str) -> list[Check]:
    return [
        Check(layer, "missing_field", WARNING, f"{what.capitalize()} has no {f}", _missing(df, f)) for f in fields
    ]


def bronze_checks(df: DataFrame) -> list[Check]:
    content = F.coalesce("content", F.lit(""))
    # A character has four bytes at most; only short texts are counted through.
    short = (content != "") & (F.octet_length(content) < 4 * SHORT_CONTENT) & (F.length(content) < SHORT_CONTENT)
    return _required(df, "bronze", BRONZE_REQUIRED, "article") + [
        Check("bronze", "content_quality", WARNING, "Content is below the usual length", short)
    ]


def silver_checks(df: DataFrame) -> list[Check]:
    content = F.coalesce("content", F.lit(""))
    language = F.coalesce("language", F.lit(""))
    date = F.col("publication_date")
    return _required(df, "silver", SILVER_REQUIRED, "processed article") + [
        Check("silver", "normalization_error", WARNING, "Markup left in the text", content.contains("<") | content.contains(">")),
        Check("silver", "language_detection", WARNING, "Language is none of the known codes", ~language.isin(*LANGUAGES)),
        Check(
            "silver", "date_format", WARNING, "Date is no time stamp",
            ~is_blank(date) & parse_datetime(date).isNull(),
        ),
    ]


def event_checks(df: DataFrame) -> list[Check]:
    wrong_type = F.coalesce("event_type", F.lit("")) != "article_published"
    return _required(df, "streaming", EVENT_REQUIRED, "streaming event") + [
        Check("streaming", "invalid_event_type", WARNING, "Event is of another type", wrong_type)
    ]


def gold_checks(df: DataFrame, table: str) -> list[Check]:
    """Row structure of a Gold table; two of the tables have no such check."""
    fields = GOLD_STRUCTURE[table]
    broken = F.lit(False)
    for field in fields:
        broken = broken | F.col(field).isNull()
    return [Check("gold", "structure_error", WARNING, f"Rows of {table} lack a value", broken)] if fields else []


def summary_checks(df: DataFrame) -> list[Check]:
    missing = [
        Check("gold", "missing_key", WARNING, f"Summary has no {f}", F.col(f).isNull())
        for f in SUMMARY_REQUIRED
    ]
    total = F.coalesce("total_articles", F.lit(0))
    return missing + [
        Check("gold", "invalid_stats", WARNING, "No article counted", total <= 0)
    ]


def first_events(events: DataFrame, n: int = CHECKED_EVENTS) -> DataFrame:
    """The first events of a batch, for a quick look; checks run over all events."""
    return events.orderBy("sequence").limit(n)


def count_violations(df: DataFrame, checks: list[Check]) -> DataFrame:
    """One row per check: layer, type, severity, message, violations."""
    counted = df.agg(
        *[
            F.coalesce(F.sum(c.condition.cast("int")), F.lit(0)).alias(f"c{i}")
            for i, c in enumerate(checks)
        ]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(c.layer).alias("layer"),
                F.lit(c.type).alias("type"),
                F.lit(c.severity).alias("severity"),
                F.lit(c.message).alias("message"),
                F.col(f"c{i}").alias("violations"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return counted.select(F.inline(rows))


def sample_violations(df: DataFrame, checks: list[Check], order: list[str], n: int = SAMPLES) -> DataFrame:
    """The first n violations per severity, by row order and then by check."""
    found = F.array(
        *[
            F.when(
                c.condition,
                F.struct(
                    F.lit(i).alias("check_no"),
                    F.lit(c.layer).alias("layer"),
                    F.lit(c.type).alias("type"),
                    F.lit(c.severity).alias("severity"),
                    F.lit(c.message).alias("message"),
                ),
            )
            for i, c in enumerate(checks)
        ]
    )
    rows = df.select(*order, F.inline(F.array_compact(found)))
    return first_n(rows, ["severity"], [*order, "check_no"], n)


def mark_violations(df: DataFrame, checks: list[Check], order: list[str]) -> DataFrame:
    """``order``, and ``hits`` with a bit for each check that a row violates."""
    bits = [F.when(c.condition, F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(checks)]
    return df.select(*order, reduce(Column.bitwiseOR, bits).cast("bigint").alias("hits"))


def marked_checks(checks: list[Check]) -> list[Check]:
    """The same checks on the rows of ``mark_violations``."""
    return [replace(c, condition=F.col("hits").bitwiseAND(F.lit(1 << i)) != 0) for i, c in enumerate(checks)]


def layer_issue(when: Column, layer: str, kind: str, severity: str, message: str) -> Column:
    """0 or 1 violations of a whole layer, as a row of ``count_violations``."""
    return F.struct(
        F.lit(layer).alias("layer"),
        F.lit(kind).alias("type"),
        F.lit(severity).alias("severity"),
        F.lit(message).alias("message"),
        F.coalesce(when.cast("bigint"), F.lit(0)).alias("violations"),
    )


def stale(newest: Column, now: Column) -> Column:
    """Whether the newest file is more than a day old."""
    return newest < now - F.expr(f"INTERVAL {FRESH_HOURS} HOURS")


def too_few_silver(silver: Column, bronze: Column) -> Column:
    return silver < bronze * F.lit(LEAST_SILVER_SHARE)


def summary_differs(gold_total: Column, silver: Column) -> Column:
    return F.abs(F.coalesce(gold_total, F.lit(0)) - silver) > SUMMARY_TOLERANCE


def quality_score(errors: Column, warnings: Column) -> Column:
    weight = errors * ERROR_WEIGHT + warnings * WARNING_WEIGHT
    return F.lit(100.0) - F.least(weight / F.lit(float(WORST_WEIGHT)), F.lit(1.0)) * 100


def verdict(score: Column) -> Column:
    return F.when(score >= EXCELLENT, "EXCELLENT").when(score >= ACCEPTABLE, "GOOD").otherwise("POOR")


def score_issues(issues: DataFrame) -> DataFrame:
    """One row from violation counts: errors, warnings, score, verdict, acceptable."""

    def total(severity: str) -> Column:
        hits = F.when(F.col("severity") == severity, F.col("violations"))
        return F.coalesce(F.sum(hits), F.lit(0)).cast("bigint")

    return (
        issues.agg(total(ERROR).alias("errors"), total(WARNING).alias("warnings"))
        .withColumn("quality_score", quality_score(F.col("errors"), F.col("warnings")))
        .withColumn("verdict", verdict(F.col("quality_score")))
        .withColumn("acceptable", F.col("quality_score") >= ACCEPTABLE)
    )
