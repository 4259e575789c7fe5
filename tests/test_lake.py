import json
import time
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from newsloom import schemas, settings
from newsloom.operators import events as event_ops
from newsloom.operators import quality as ops
from newsloom.plans import gold, quality, run, silver, warehouse
from newsloom.sources import lake as lakes
from newsloom.sources.lake import Lake
from newsloom.streaming import dedup, publish
from tests.test_silver_and_gold import raw


@pytest.fixture
def lake(tmp_path):
    return Lake(f"file:{tmp_path}/lake")


def article(i, **more):
    return {"title": f"Title {i}", "content": f"body {i} " * 20, "url": f"https://x.y/{i}", "source": "BBC News", **more}


def test_json_files(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.json").write_text(json.dumps([article(2), article(1, author="Zoé")], indent=2, ensure_ascii=False))
    (tmp_path / "deep" / "b.json").write_text(json.dumps([article(3)]))
    (tmp_path / "empty.json").write_text("[]")
    (tmp_path / "note.txt").write_text("[]")
    got = lakes.read_article_files(spark, f"file:{tmp_path}", schemas.BRONZE_ARTICLE).orderBy("file_name", "pos").collect()
    assert [r.title for r in got] == ["Title 2", "Title 1", "Title 3"]
    assert got[1].author == "Zoé" and got[0].author is None


def test_file_audit(spark, tmp_path):
    for name, body in {"array": "[1]", "empty": "[]", "object": '{"a": 1}', "broken": '[{"a": 1', "extra": "[1]x", "blank": " ", "number": " 3 "}.items():
        (tmp_path / f"{name}.json").write_text(body)
    got = {r.file_name.rsplit("/", 1)[1][:-5]: r.status for r in lakes.audit_article_files(spark, f"file:{tmp_path}").collect()}
    assert got == {"array": "ok", "empty": "ok", "object": "format_error", "number": "format_error",
                   "broken": "file_error", "extra": "file_error", "blank": "file_error"}
    issues = {r.type: r.violations for r in quality.file_issues(spark, f"file:{tmp_path}", "bronze").collect()}
    assert issues == {"format_error": 2, "file_error": 3}


def test_newest_file_and_exists(spark, tmp_path):
    for name in ("b.json", "a.json"):
        (tmp_path / name).write_text("[]")
        time.sleep(0.05)
    assert lakes.newest_file(lakes.list_files(spark, f"file:{tmp_path}")).first().path.endswith("a.json")
    assert lakes.exists(spark, f"file:{tmp_path}/a.json") and not lakes.exists(spark, f"file:{tmp_path}/none")


def test_latest_json_snapshot(spark, tmp_path):
    def titles(folder):
        rows = lakes.read_latest_file(spark, f"file:{folder}", "articles_latest.json", schemas.SILVER_ARTICLE)
        return [r.title for r in rows.orderBy("file_name", "pos").collect()]

    assert titles(tmp_path / "none") == []
    for name, i in (("b.json", 1), ("a.json", 2)):
        (tmp_path / name).write_text(json.dumps([article(i)]))
        time.sleep(0.05)
    assert titles(tmp_path) == ["Title 2"], "the newest file"
    (tmp_path / "articles_latest.json").write_text(json.dumps([article(4), article(3)]))
    (tmp_path / "c.json").write_text(json.dumps([article(5)]))
    assert titles(tmp_path) == ["Title 4", "Title 3"], "the named file"


def test_missing_tables_are_empty(spark, lake):
    assert gold.read_gold(spark, lake, "top_keywords").count() == 0
    assert lakes.read_or_empty(spark, lake.path("nowhere"), "a int").count() == 0
    assert lake.latest_run(spark, "silver") is None


def test_snapshots(spark, lake):
    first, second = spark.range(3).toDF("n"), spark.range(5).toDF("n")
    lake.write_run(first, "silver", "t", "20260101_000000")
    lake.publish(spark, "silver", "20260101_000000")
    lake.write_run(second, "silver", "t", "20260102_000000")
    assert lake.read_latest(spark, "silver", "t", "n bigint").count() == 3, "not published yet"
    lake.publish(spark, "silver", "20260102_000000")
    assert lake.read_latest(spark, "silver", "t", "n bigint").count() == 5
    lake.write_run(first, "silver", "t", "20260102_000000")
    assert lake.read_latest(spark, "silver", "t", "n bigint").count() == 3, "a repeated run replaces itself"
    assert lake.latest_path(spark, "silver", "other") is None


def test_bronze_keeps_history_and_replaces_repeats(spark, lake):
    day1 = raw(spark, [{"url": "a"}, {"url": "b", "source": "Al Jazeera"}]).drop("file_name")
    lake.add_bronze(day1, "r1")
    lake.add_bronze(day1, "r2")
    lake.add_bronze(day1.filter("url = 'a'"), "r2")
    got = sorted((r.file_name, r.url) for r in lake.read_bronze(spark, schemas.BRONZE_ARTICLE).collect())
    assert got == [("al_jazeera_r1", "b"), ("s_r1", "a"), ("s_r2", "a")]


def test_only_whole_runs_are_read(spark, lake):
    """A run that stops before it is published, or within a table, is never current."""
    one, two = spark.range(1).toDF("n"), spark.range(2).toDF("n")
    files, half = lakes._file_system(spark, lake.path("gold", "run_id=9", "t", "part-0.parquet"))
    files.create(half).close()
    assert lake.latest_run(spark, "gold") is None
    lake.write_run(one, "gold", "t", "1")
    assert lake.latest_run(spark, "gold") == "1"
    lake.publish(spark, "gold", "1")
    lake.write_run(two, "gold", "t", "2")
    assert lake.latest_run(spark, "gold") == "1"
    lake.publish(spark, "gold", "2")
    assert lake.latest_run(spark, "gold") == "2"
    lake.publish(spark, "gold", "1")
    assert lake.read_latest(spark, "gold", "t", "n bigint").count() == 1


def test_streams_share_a_table(spark, tmp_path):
    """A second query with a new checkpoint adds to the table of the first; replays replace; rows
    without a time and rows that come late are kept."""
    schema = schemas.BRONZE_ARTICLE + ", file_name string, pos bigint"
    out = f"file:{tmp_path}/out"
    seen = []
    for n, urls in enumerate((["a", "b", "a"], ["b", "c"])):
        rows = [{"url": u, "scraped_at": None if u == "c" else f"20{30 - n}-01-01T00:00:00"} for u in urls]
        folder = f"file:{tmp_path}/in{n}"
        raw(spark, rows).select([c.split()[0] for c in schema.split(", ")]).write.parquet(folder)
        stream = publish.read_article_stream(spark, folder, schema, batch_bytes=1)
        dedup.keep_first_ever(stream, out, f"file:{tmp_path}/state{n}").awaitTermination()
        seen.append(sorted(r.url for r in spark.read.schema(schema).parquet(out).collect()))
    assert seen == [["a", "b"], ["a", "b", "c"]]
    folders = f"file:{tmp_path}/in*"
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(folders)
    query = (
        dedup.first_article_seen(stream).select("url").writeStream.format("parquet").option("path", f"file:{tmp_path}/once")
        .option("checkpointLocation", f"file:{tmp_path}/once-state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    assert sorted(r.url for r in spark.read.schema("url string").parquet(f"file:{tmp_path}/once").collect()) == ["a", "b", "c"]


def test_work_folder_follows_the_session(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = settings.work_folder(spark)
    assert folder == (named or spark.sparkContext.getCheckpointDir()).rstrip("/")
    assert settings.fresh_folder(spark, "x") != settings.fresh_folder(spark, "x")


def bronze(spark, lake, n=20):
    rows = [{"url": f"u{i}", "title": f"Title {i}", "source": "Reuters" if i % 2 else "BBC News", "content": f"keyword{'abc'[i % 3]} sample " * 9,
             "publication_date": "2026-05-06"} for i in range(n)]
    return raw(spark, rows).drop("file_name")


NOW = datetime(2026, 5, 6, 12, 0, tzinfo=timezone.utc)


def test_a_whole_run(spark, lake):
    assert run.run_lake(spark, lake, bronze(spark, lake), now=NOW)
    assert silver.read_silver(spark, lake).count() == 20
    assert gold.read_gold(spark, lake, "summary_stats").first().total_articles == 20
    facts = warehouse.read_warehouse(spark, lake, "fact_articles")
    assert facts.count() == 20 and facts.first().loaded_at == datetime(2026, 5, 6, 12)
    assert warehouse.read_warehouse(spark, lake, "warehouse_summary").first().id == 1
    events = spark.read.schema(schemas.WAREHOUSE_EVENT).parquet(lake.path(warehouse.LAYER, warehouse.EVENT_TABLE))
    assert events.count() == 20
    board = gold.read_dashboard(spark, lake)
    assert board["summary"].first().total_articles == 20 and board["articles"].count() == 20
    assert sorted(r.source for r in board["by_source"].collect()) == ["BBC News", "Reuters"]
    report = spark.read.json(lake.path("reports", "quality")).first()
    assert (report.errors, report.warnings, report.verdict) == (0, 0, "EXCELLENT")
    steps = {r.step: r.status for r in spark.read.json(lake.path("reports", "runs")).collect()}
    assert set(steps.values()) == {"completed"} and set(steps) == set(run.STEPS)
    # A later run over more Bronze replaces what is current and keeps history.
    assert run.run_lake(spark, lake, bronze(spark, lake, 24), now=NOW.replace(hour=13))
    assert silver.read_silver(spark, lake).count() == 24
    assert lakes.exists(spark, lake.run_path("silver", "articles", "20260506_120000"))
    events = spark.read.schema(schemas.WAREHOUSE_EVENT).parquet(lake.path(warehouse.LAYER, warehouse.EVENT_TABLE))
    assert {r.batch_id: r["count"] for r in events.groupBy("batch_id").count().collect()} == {
        "20260506_120000": 20, "20260506_130000": 24}


def test_failing_steps(spark, lake):
    assert not run.run_lake(spark, lake, now=NOW, skip=("silver",))
    steps = {r.step: r.status for r in spark.read.json(lake.path("reports", "runs")).collect()}
    assert steps == {"bronze": "skipped", "silver": "skipped", "streaming": "failed", "gold": "pending",
                     "warehouse": "pending", "quality": "pending", "dashboard": "pending"}
    forced = Lake(lake.base + "2")
    assert not run.run_lake(spark, forced, now=NOW, skip=("silver",), force=True)
    steps = {r.step: r.status for r in spark.read.json(forced.path("reports", "runs")).collect()}
    assert steps["streaming"] == "failed" and steps["quality"] == "completed" and steps["dashboard"] == "pending"
    summary = warehouse.read_warehouse(spark, forced, "warehouse_summary").first()
    assert (summary.total_articles, summary.generated_at) == (0, None)


def test_events_fall_back_to_gold(spark, lake):
    run.run_lake(spark, lake, bronze(spark, lake), now=NOW)
    other = Lake(lake.base + "-gold")
    lake_articles = lake.read_latest(spark, gold.LAYER, gold.ARTICLES, schemas.SILVER_ARTICLE + ", file_name string, pos bigint")
    other.write_run(lake_articles, gold.LAYER, gold.ARTICLES, "r")
    other.publish(spark, gold.LAYER, "r")
    stats = publish.publish_batch(spark, other, "b", F.lit("2026-05-06T12:00:00"))
    assert stats == {"batch_id": "b", "event_count": 20, "warehouse_loaded": True}


def test_a_failing_mirror_does_not_fail_the_publication(spark, lake, monkeypatch):
    silver_rows = raw(spark, [{}])
    silver.write_checked(lake, silver.check_articles(silver_rows, F.lit("t")), "r")

    def broken(*_):
        raise OSError("down")

    monkeypatch.setattr(warehouse, "upsert_events", broken)
    stats = publish.publish_batch(spark, lake, "b", F.lit("2026-05-06T12:00:00"))
    assert stats["warehouse_loaded"] is False and stats["event_count"] == 1


def test_upsert(spark):
    schema = "event_id string, title string, loaded_at timestamp_ntz"
    known = spark.createDataFrame([("a", "old", datetime(2026, 1, 1)), ("b", "keep", datetime(2026, 1, 1))], schema)
    incoming = spark.createDataFrame([("a", "new", datetime(2026, 1, 2)), ("c", "add", datetime(2026, 1, 2))] + [("c", "add", datetime(2026, 1, 2))] * 50, schema)
    got = sorted(tuple(r) for r in event_ops.upsert(known, incoming).collect())
    assert got == [("a", "old", datetime(2026, 1, 2)), ("b", "keep", datetime(2026, 1, 1)), ("c", "add", datetime(2026, 1, 2))]


def test_event_ids(spark):
    from hashlib import sha256
    df = spark.createDataFrame([("u", 7)], "url string, n bigint")
    got = df.select(event_ops.event_id(F.lit("b"), F.col("n"), F.col("url")).alias("i")).first().i
    assert got == sha256(b"b:7:u").hexdigest()


def test_repeated_keys_fail_the_load(spark):
    warehouse.require_unique(spark.createDataFrame([("a",), ("b",)], "k string"), "k", "t")
    with pytest.raises(ValueError, match="t: key 'a'"):
        warehouse.require_unique(spark.createDataFrame([("a",), ("b",), ("a",)], "k string"), "k", "t")


def test_days_that_are_no_dates(spark):
    by_date = spark.createDataFrame([("2026-05-06", 2), ("2026-02-31", 1), ("il y a 2 h", 3)], "date string, article_count bigint")
    assert [str(r.publication_day) for r in warehouse.fact_articles_by_day(by_date).collect()] == ["2026-05-06"]
    assert sorted(r.date for r in warehouse.rejected_days(by_date).collect()) == ["2026-02-31", "il y a 2 h"]


def test_stream_is_the_batch_and_replays_are_idempotent(spark, tmp_path):
    rows = silver.check_articles(raw(spark, [{"url": f"u{i}"} for i in range(12)]), F.lit("t")).drop("reason")
    rows.coalesce(1).write.parquet(f"file:{tmp_path}/in")
    stored = schemas.SILVER_ARTICLE + ", file_name string, pos bigint"
    out = f"file:{tmp_path}/out"
    batch = publish.stream_events(spark.read.schema(stored).parquet(f"file:{tmp_path}/in"), F.lit("now"))
    for state, times in (("a", 1), ("a", 1), ("b", 2)):
        stream = publish.read_article_stream(spark, f"file:{tmp_path}/in", stored)
        publish.publish_stream(stream, out, f"file:{tmp_path}/{state}", F.lit("now")).awaitTermination()
        got = spark.read.schema(batch.schema).parquet(out).select(batch.columns)
        assert sorted(got.collect()) == sorted(batch.collect() * times), "a new query adds, with the same ids"


def test_stream_dedup(spark, tmp_path):
    schema = "url string, scraped_at string"
    source, out = f"file:{tmp_path}/in", f"file:{tmp_path}/out"

    def step(rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = publish.read_article_stream(spark, source, schema)
        (dedup.first_article_seen(stream, "2 days").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", f"file:{tmp_path}/state").trigger(availableNow=True).start().awaitTermination())
        return sorted(r.url for r in spark.read.schema(schema).parquet(out).collect())

    assert step([("a", "2026-05-01T00:00:00"), ("a", "2026-05-01T01:00:00"), ("b", "2026-05-01T00:00:00")]) == ["a", "b"]
    assert step([("a", "2026-05-02T00:00:00"), ("c", "2026-05-02T00:00:00")]) == ["a", "b", "c"]


def test_exact_stream_dedup_over_epochs_and_replays(spark, tmp_path):
    schema = "url string, file_name string, pos bigint"
    source, out = f"file:{tmp_path}/in", f"file:{tmp_path}/out"

    def step(rows, state="state"):
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        stream = publish.read_article_stream(spark, source, schema)
        dedup.keep_first_ever(stream, out, f"file:{tmp_path}/{state}").awaitTermination()
        return sorted((r.url or "", r.file_name, r.pos) for r in spark.read.schema(schema).parquet(out).collect())

    first = [("a", "f", 1), ("b", "f", 3)]
    assert step([("a", "f", 2), ("a", "f", 1), ("b", "f", 3)]) == first
    assert step([("a", "e", 0), ("c", "g", 0), (None, "g", 1), ("", "g", 2)]) == [("", "g", 1), *first, ("c", "g", 0)]
    assert step([]) == [("", "g", 1), *first, ("c", "g", 0)]


@pytest.mark.parametrize("errors,warnings,score,verdict", [
    (0, 0, 100, "EXCELLENT"), (0, 1, 96, "EXCELLENT"), (1, 0, 80, "GOOD"), (5, 0, 0, "POOR"), (0, 25, 0, "POOR"),
    (9, 99, 0, "POOR"), (1, 2, 72, "POOR"),
])
def test_score(spark, errors, warnings, score, verdict):
    issues = spark.createDataFrame([("ERROR", errors), ("WARNING", warnings)], "severity string, violations bigint")
    row = ops.score_issues(issues).first()
    assert (row.quality_score, row.verdict, row.acceptable) == (score, verdict, score >= 75)


def test_checks_of_an_empty_lake(spark, lake):
    issues = {(r.layer, r.type): r.violations for r in quality.all_issues(spark, lake, F.current_timestamp()).filter("violations > 0").groupBy("layer", "type").agg(F.sum("violations").alias("violations")).collect()}
    assert issues == {("bronze", "missing_data"): 1, ("silver", "missing_data"): 1, ("streaming", "missing_data"): 1, ("gold", "missing_file"): 6}
    with pytest.raises(RuntimeError):
        quality.check_lake(spark, lake, F.current_timestamp(), fail_on_poor=True)


def test_consistency_limits(spark):
    def fired(*counts):
        return {r.type for r in quality.consistency_issues(*counts, spark).filter("violations > 0").collect()}

    assert fired(10, 8, 8) == set()
    assert fired(10, 7, 7) == {"article_count_mismatch"}
    assert fired(10, 10, 15) == set()
    assert fired(10, 10, 16) == {"summary_mismatch"}
    assert fired(10, 10, None) == set()


def test_empty_event_snapshot(spark, lake):
    empty = spark.createDataFrame([], quality.STORED_EVENT)
    lake.write_run(empty, quality.EVENT_LAYER, quality.EVENTS, "b")
    lake.publish(spark, quality.EVENT_LAYER, "b")
    fired = {r.type for r in quality.event_issues(spark, lake).filter("violations > 0").collect()}
    assert fired == {"empty_data"}


def test_jdbc_settings(spark):
    """The target is configuration; no database is opened here."""
    writer = warehouse.jdbc_writer(spark.range(1), "dim_source", "jdbc:none:x", {"user": "u"})
    assert writer is not None
