"""What a whole run must not do more often than once, and that the shorter ways give the same results."""

from datetime import datetime, timezone

from newsloom.functions import text
from newsloom.operators import aggregates
from newsloom.operators import quality as ops
from newsloom.plans import quality, run
from newsloom.plans.silver import ORDER
from newsloom.sources.lake import Lake
from pyspark.sql import functions as F
from registry.derived import articles

SF_DIR = "/root/testdata/sf0.001"
WORDS = ["abcd", "ABCD.", "abc", "ab9cd", "étés", "كلمة", "،كلمة", "ab,abcdé,efgh", "K" * 4, "İİİİ", "ΑΣΣΑΣ", "_abcd", "a-bcde\nfghi", "with", ""]


def test_keywords_are_looked_for_once_in_each_different_chunk(spark):
    rows = spark.createDataFrame([(f"{a} {b}{c}  {a}", c) for a in WORDS for b in WORDS for c in [*WORDS, None]], "content string, title string")
    counts = aggregates.keyword_counts(rows)
    old = aggregates.keywords(rows).groupBy("keyword").agg(F.count(F.lit(1)).alias("frequency"))
    assert {r.keyword: r.frequency for r in counts.collect()} == {r.keyword: r.frequency for r in old.collect()}
    # The plan is printed from the result down: the pattern is above the first count.
    plan = counts._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") == 2 and plan.index("regexp_extract_all") < plan.rindex("Aggregate [")


def test_checking_a_lake_reads_texts_once_for_counts_and_samples(spark, tmp_path, monkeypatch):
    lake = Lake(f"file:{tmp_path}/lake")
    # Steps that need no more than a lake with Bronze and Silver.
    run.run_lake(spark, lake, articles(spark, SF_DIR), now=datetime(2026, 5, 6, tzinfo=timezone.utc), skip=tuple(s for s in run.STEPS if s not in ("bronze", "silver")))
    seen = []
    count, sample = ops.count_violations, ops.sample_violations
    monkeypatch.setattr(ops, "count_violations", lambda df, *x: seen.append(df.columns) or count(df, *x))
    monkeypatch.setattr(ops, "sample_violations", lambda df, *x: seen.append(df.columns) or sample(df, *x))
    report = quality.check_lake(spark, lake, F.current_timestamp()).first()
    assert seen and not any("content" in columns for columns in seen)
    assert 0 < len(report.samples) <= 2 * ops.SAMPLES


def test_marks_give_the_counts_and_samples_of_the_rows(spark):
    raw = articles(spark, SF_DIR).withColumn("file_name", F.lit("f")).withColumn("processed_at", F.lit(""))
    odd = raw.withColumn("content", F.when(F.col("pos") % 3 == 0, F.expr("repeat('😀', cast(pos % 200 as int))")).otherwise(F.col("content")))
    for rows, checks in ((odd, ops.bronze_checks(odd)), (odd, ops.silver_checks(odd))):
        marks, marked = ops.mark_violations(rows, checks, list(ORDER)), ops.marked_checks(checks)
        counts = ops.count_violations(rows, checks).collect()
        assert any(r.violations for r in counts) and ops.count_violations(marks, marked).collect() == counts
        samples = sorted(ops.sample_violations(rows, checks, list(ORDER)).collect())
        assert sorted(ops.sample_violations(marks, marked, list(ORDER)).collect()) == samples
    length = F.length(F.coalesce("content", F.lit("")))
    short = odd.filter((length > 0) & (length < ops.SHORT_CONTENT)).count()
    markup = odd.filter(F.coalesce("content", F.lit("")).rlike("[<>]")).count()
    found = {r.type: r.violations for rows in (ops.bronze_checks(odd), ops.silver_checks(odd)) for r in ops.count_violations(odd, rows).collect()}
    assert (found["content_quality"], found["normalization_error"]) == (short, markup) and short and markup


def test_cleaning_looks_once_at_texts_without_odd_characters(spark):
    """Every character alone and among others, against the steps one by one with plain patterns."""
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    chars = spark.range(0, 0x11000).filter("id NOT BETWEEN 55296 AND 57343").select(char.alias("c")).filter("c NOT IN ('<', '&')")
    c = F.col("c")
    single = F.regexp_replace(F.regexp_replace(c, text.ODD_SPACE, " "), " {2,}", " ")
    plain = F.trim(F.regexp_replace(single, text.DISALLOWED_CHARS, " "))
    for rows in (chars, *(chars.select(F.concat(F.lit(a), c, F.lit(b), c, c, F.lit("z")).alias("c")) for a in ("x \n", "é  ك “") for b in (" ", "\n\t"))):
        assert rows.filter(text.normalize_text(c) != plain).isEmpty()
