import pytest
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators import aggregates, articles as ops, sequence
from newsloom.operators.ranking import sample_files
from newsloom.plans import silver

RAW = schemas.BRONZE_ARTICLE + ", file_name string, pos bigint"
BODY = "x" * 60


def raw(spark, rows):
    """Rows given as dicts over a valid article."""
    base = dict(title="A good title", author=None, publication_date=None, category=None, content=BODY,
                source="S", url="u", language="en", scraped_at="2026-05-06T10:00:00", file_name="f", pos=0)
    names = schemas.names(RAW)
    full = [{**base, "pos": i, **row} for i, row in enumerate(rows)]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in full], RAW)


def check(spark, rows):
    df = raw(spark, rows)
    checked = silver.check_articles(df, F.lit("now"))
    return checked, silver.silver_stats(df, checked).first().asDict()


@pytest.mark.parametrize("row,reason", [
    ({}, "ok"), ({"title": ""}, "missing_title"), ({"title": None}, "missing_title"), ({"title": "<b></b>"}, "missing_title"),
    ({"title": "abcd"}, "title_too_short"), ({"title": "abcde"}, "ok"), ({"content": None}, "missing_content"),
    ({"content": "x" * 49}, "content_too_short"), ({"content": "x" * 50}, "ok"), ({"url": ""}, "missing_url"),
    ({"url": None}, "missing_url"), ({"title": "", "content": "", "url": ""}, "missing_title"),
    ({"content": "http://" + "x" * 80}, "missing_content"),
])
def test_reasons(spark, row, reason):
    checked, _ = check(spark, [row])
    assert checked.first().reason == reason


def test_an_invalid_first_copy_suppresses_a_good_one(spark):
    checked, stats = check(spark, [{"title": ""}, {}])
    assert [r.reason for r in checked.collect()] == ["missing_title"]
    assert stats == {"total": 2, "valid": 0, "invalid": 1, "duplicate": 1}


def test_empty_urls_are_one_key(spark):
    _, stats = check(spark, [{"url": ""}, {"url": None}, {"url": ""}])
    assert stats == {"total": 3, "valid": 0, "invalid": 1, "duplicate": 2}


def test_first_copy_goes_by_file_then_position(spark):
    checked, _ = check(spark, [
        {"file_name": "b", "pos": 0, "source": "late"}, {"file_name": "a", "pos": 5, "source": "second"},
        {"file_name": "a", "pos": 2, "source": "first"}])
    assert [r.source for r in checked.collect()] == ["first"]


def test_no_rows(spark):
    checked, stats = check(spark, [])
    assert stats == {"total": 0, "valid": 0, "invalid": 0, "duplicate": 0}
    summary = aggregates.summary_stats(ops.accepted(checked)).first()
    assert (summary.total_articles, summary.total_sources, summary.sources, summary.avg_content_length) == (0, 0, [], 0.0)


def test_cleaned_fields(spark):
    row = ops.clean(raw(spark, [{
        "title": "<b>T</b> &amp; u", "author": "", "category": " <i>x</i> ", "language": "", "source": None,
        "publication_date": "6/5/2026", "content": "Hello http://a.b world"}]), F.lit("now")).first()
    assert row.asDict() == {
        "title": "T & u".replace("&", " "), "author": None, "publication_date": "2026-05-06T00:00:00", "category": "x",
        "content": "Hello world", "content_length": 11, "source": "", "url": "u", "language": "en",
        "scraped_at": "2026-05-06T10:00:00", "processed_at": "now"}


def test_a_hot_url_shrinks_before_the_shuffle(spark):
    """A third of the rows share a URL; each input partition passes one on."""
    rows = spark.range(0, 30000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("url"), "id")
    from newsloom.operators.ranking import keep_first_by_url
    kept = keep_first_by_url(rows, ["id"])
    assert kept.count() == 20001
    assert kept.filter("url = 'hot'").first().id == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_numbering(spark):
    """One file holds most rows; positions have gaps."""
    rows = [("b", i * 7 + 2) for i in range(200)] + [("a", i) for i in range(5)] + [("c", 1 << 50)]
    df = spark.createDataFrame(rows, "file_name string, pos bigint").repartition(5)
    got = sequence.number_rows(df, "file_name", "pos").collect()
    assert {(r.file_name, r.pos): r.sequence for r in got} == {k: i + 1 for i, k in enumerate(sorted(rows))}


def test_numbering_has_no_single_task(spark):
    """Also with a row per file and sparse positions no table meets in one task."""
    df = spark.range(0, 4000, numPartitions=4).select(F.col("id").cast("string").alias("f"), (F.col("id") * 99991).alias("pos"))
    numbered = sequence.number_rows(df, "f", "pos")
    assert "SinglePartition" not in numbered._jdf.queryExecution().executedPlan().toString()
    assert [r.f for r in numbered.orderBy("sequence").collect()] == sorted(map(str, range(4000)))


def articles(spark, rows):
    return ops.accepted(check(spark, [{"url": f"u{i}", **r} for i, r in enumerate(rows)])[0])


def test_counts_and_labels(spark):
    df = articles(spark, [
        {"source": "A", "category": ""}, {"source": "A", "category": None}, {"source": "B", "category": "x", "language": "fr"},
        {"source": "", "category": "x", "language": "xx"}])
    rows = lambda d: [tuple(r) for r in d.collect()]
    assert rows(aggregates.articles_by_source(df)) == [("A", 2), ("", 1), ("B", 1)]
    assert rows(aggregates.articles_by_category(df)) == [("Uncategorized", 2), ("x", 2)]
    assert rows(aggregates.articles_by_language(df)) == [("en", "English", 2), ("fr", "French", 1), ("xx", "xx", 1)]


def test_groups_give_the_same_tables(spark):
    df = articles(spark, [
        {"source": s, "category": c, "publication_date": d, "content": BODY + "y" * n}
        for n, (s, c, d) in enumerate([("A", None, "2026-05-06"), ("A", "x", "soon after"), ("B", "", None), ("B", "x", "6/5/2026")])])
    groups = aggregates.article_groups(df)
    for fn in (aggregates.articles_by_source, aggregates.articles_by_category, aggregates.articles_by_language,
               aggregates.articles_by_date, aggregates.summary_stats):
        assert fn(df).collect() == fn(groups).collect()
    total = df.count()
    for fn in (aggregates.articles_by_source, aggregates.articles_by_category):
        assert fn(df).agg(F.sum("article_count")).first()[0] == total
    assert [r.date for r in aggregates.articles_by_date(df).collect()] == ["soon after", "2026-05-06"]


def test_unknown_keys_in_foreign_silver(spark):
    df = spark.createDataFrame([(None, None, None, None, None)], "source string, category string, language string, publication_date string, scraped_at string")
    assert aggregates.articles_by_source(df).first().source == "Unknown"
    assert aggregates.articles_by_language(df).first().language_code == "unknown"
    assert aggregates.articles_by_date(df).count() == 0


def test_keyword_ties_and_stop_words(spark):
    df = spark.createDataFrame([("beta alpha beta have alpha gamma", "Gamma delta with"), ("delta", None)], "content string, title string")
    got = [tuple(r) for r in aggregates.top_keywords(df, 3).collect()]
    assert got == [("alpha", 2), ("beta", 2), ("delta", 2)]


def test_sample_files(spark):
    rows = [(f, i) for f in ("c", "a", "b") for i in range(30)]
    df = spark.createDataFrame(rows, "f string, p int")
    assert [tuple(r) for r in sample_files(df, "f", "p").collect()] == [(f, i) for f in ("a", "b") for i in range(10)]
