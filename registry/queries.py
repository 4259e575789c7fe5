"""One query per operator: name -> function(spark, sf_dir) -> DataFrame.

Every query reads the given tables whole. Stamps (processed_at, event_time,
loaded_at, generated_at) are fixed or left out, so results can be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.functions import dates, markup, text
from newsloom.operators import aggregates, crawl, events, extraction, links, quality, ranking, sequence, sites
from newsloom.operators import articles as article_ops
from newsloom.operators.rows import one_row
from newsloom.plans import bronze, gold, run, silver, warehouse
from newsloom.plans import quality as quality_plan
from newsloom.settings import fresh_folder, release, staged
from newsloom.sources import feeds, lake
from newsloom.streaming import dedup, publish
from registry.derived import articles, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

STAMP = "2026-05-06T12:00:00"
BATCH = "20260506_120000"
NEXT_BATCH = "20260506_130000"
# Rows of one derived JSON file, as small as the files of a crawl.
FILE_ROWS = 50


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def raw(spark: SparkSession, sf: str) -> DataFrame:
    return articles(spark, sf).withColumn("file_name", F.lit("articles"))


def checked(spark: SparkSession, sf: str) -> DataFrame:
    return silver.check_articles(raw(spark, sf), F.lit(STAMP))


def clean(spark: SparkSession, sf: str) -> DataFrame:
    return article_ops.accepted(checked(spark, sf))


def stored_clean(spark: SparkSession, sf: str) -> DataFrame:
    """The same, written once for queries that read it several times."""
    return staged(clean(spark, sf), "silver")


def foreign_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Raw articles taken as somebody else's Silver: every check can fire."""
    return raw(spark, sf).withColumn(
        "processed_at", F.when(F.col("pos") % 9 == 0, "").otherwise(F.lit(STAMP))
    )


def new_lake(spark: SparkSession, name: str) -> lake.Lake:
    return lake.Lake(fresh_folder(spark, name))


def bronze_lake(spark: SparkSession, sf: str) -> lake.Lake:
    made = new_lake(spark, "lake")
    made.add_bronze(articles(spark, sf), BATCH)
    return made


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages")


# Scalar functions


@query
def strip_html(spark, sf):
    return raw(spark, sf).select("pos", text.strip_html(F.col("content")).alias("plain"))


@query
def strip_html_pages(spark, sf):
    html = markup.drop_blocks(F.col("html"), ("script", "style"))
    return pages(spark, sf).select("page_id", text.strip_html(html).alias("plain"))


@query
def remove_urls(spark, sf):
    return raw(spark, sf).select("pos", text.remove_urls(F.col("content")).alias("without_urls"))


@query
def collapse_ws(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", text.collapse_whitespace(F.col("text")).alias("collapsed")
    )


@query
def char_filter(spark, sf):
    return raw(spark, sf).select("pos", text.filter_characters(F.col("content")).alias("filtered"))


@query
def normalize_text(spark, sf):
    texts = F.transform(F.array("title", "author", "category", "content"), text.normalize_text)
    return raw(spark, sf).select("pos", texts.alias("texts")).select(
        "pos",
        F.col("texts")[0].alias("title"),
        F.col("texts")[1].alias("author"),
        F.col("texts")[2].alias("category"),
        F.col("texts")[3].alias("content"),
        F.length(F.col("texts")[3]).alias("content_length"),
    )


@query
def normalize_date(spark, sf):
    date = dates.normalize_date(F.col("publication_date"), F.col("scraped_at"))
    return raw(spark, sf).select("pos", date.alias("publication_date"))


@query
def parse_datetime(spark, sf):
    return raw(spark, sf).select(
        "pos",
        dates.parse_datetime(F.col("publication_date")).alias("published"),
        dates.parse_datetime(F.col("scraped_at")).alias("scraped"),
    )


@query
def detect_language(spark, sf):
    return raw(spark, sf).select(
        "pos", text.detect_language(F.col("content"), F.col("source")).alias("detected")
    )


@query
def language_or_detect(spark, sf):
    code = text.language_or_detect(F.col("language"), F.col("content"), F.col("source"))
    return raw(spark, sf).select("pos", code.alias("code")).select(
        "pos", "code", text.language_name(F.col("code")).alias("name")
    )


@query
def publication_day(spark, sf):
    return clean(spark, sf).select(
        "pos", dates.publication_day(F.col("publication_date"), F.col("scraped_at")).alias("day")
    )


@query
def tokenize(spark, sf):
    """Occurrences of each token per article."""
    tokens = text.article_tokens(F.col("content"), F.col("title"))
    return (
        raw(spark, sf)
        .select("pos", F.explode(tokens).alias("token"))
        .groupBy("pos", "token")
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def stopword_filter(spark, sf):
    return aggregates.keyword_counts(raw(spark, sf))


@query
def url_hash(spark, sf):
    return raw(spark, sf).select("pos", text.url_hash(F.col("url")).alias("url_hash"))


# Silver


@query
def dedup_articles(spark, sf):
    return ranking.keep_first_by_url(raw(spark, sf), ["file_name", "pos"]).select("pos", "url")


@query
def validate_articles(spark, sf):
    return checked(spark, sf).select("pos", "url", "reason")


@query
def rejects_by_reason(spark, sf):
    return silver.rejects_by_reason(checked(spark, sf))


@query
def silver_articles(spark, sf):
    return clean(spark, sf).drop("processed_at", "file_name")


@query
def silver_stats(spark, sf):
    return silver.silver_stats(raw(spark, sf), checked(spark, sf))


@query
def silver_profile(spark, sf):
    """Articles per source and known language."""
    known = F.col("language").isin(*quality.LANGUAGES)
    return (
        clean(spark, sf)
        .groupBy("source", F.when(known, F.col("language")).alias("language"))
        .agg(F.count(F.lit(1)).alias("article_count"))
    )


@query
def bronze_sources(spark, sf):
    return raw(spark, sf).agg(
        F.count_distinct(text.null_if_empty(F.col("source"))).alias("sources"),
        F.count(F.lit(1)).alias("articles"),
    )


# Gold


@query
def articles_by_source(spark, sf):
    return aggregates.articles_by_source(clean(spark, sf))


@query
def articles_by_category(spark, sf):
    return aggregates.articles_by_category(clean(spark, sf))


@query
def articles_by_language(spark, sf):
    return aggregates.articles_by_language(clean(spark, sf))


@query
def articles_by_date(spark, sf):
    return aggregates.articles_by_date(clean(spark, sf))


@query
def top_keywords(spark, sf):
    return aggregates.top_keywords(clean(spark, sf))


@query
def summary_stats(spark, sf):
    return aggregates.summary_stats(clean(spark, sf)).select(
        "total_articles",
        "total_sources",
        F.array_join("sources", ",").alias("sources"),
        F.array_join("languages", ",").alias("languages"),
        "avg_content_length",
    )


@query
def article_groups(spark, sf):
    return aggregates.article_groups(clean(spark, sf))


@query
def sample_articles(spark, sf):
    """The first articles of the first files, a file being a source here."""
    by_file = stored_clean(spark, sf).withColumn("file_name", lake.source_key(F.col("source")))
    return ranking.sample_files(by_file, "file_name", "pos").select("file_name", "pos", "url")


@query
def dashboard_extract(spark, sf):
    """The dashboard tables in one row: counts, the first keyword and the sample as joined URLs."""
    rows = stored_clean(spark, sf)
    tables = gold.gold_tables(rows, aggregates.article_groups(rows), F.lit(STAMP))
    by_file = rows.withColumn("file_name", lake.source_key(F.col("source")))
    sample = ranking.sample_files(by_file, "file_name", "pos")
    board = gold.dashboard_tables(tables, sample)
    counts = [
        board[name].agg(F.count(F.lit(1)).alias(column))
        for name, column in (("by_source", "sources"), ("by_language", "languages"), ("by_date", "days"))
    ]
    first = board["keywords"].agg(F.min_by("keyword", F.struct(-F.col("frequency"), "keyword")).alias("first_keyword"))
    urls = F.sort_array(F.collect_list(F.struct("file_name", "pos", "url")))["url"]
    return one_row(
        board["summary"].select("total_articles"), *counts, first, board["articles"].agg(F.array_join(urls, " ").alias("sample_urls"))
    )


# Warehouse


def _star(spark, sf, name):
    rows = clean(spark, sf)
    tables = gold.gold_tables(rows, rows, F.lit(STAMP))
    return warehouse.star_schema(tables, rows)[name]


@query
def wh_dim_source(spark, sf):
    return _star(spark, sf, "dim_source")


@query
def wh_dim_category(spark, sf):
    return _star(spark, sf, "dim_category")


@query
def wh_dim_language(spark, sf):
    return _star(spark, sf, "dim_language")


@query
def wh_fact_articles_by_day(spark, sf):
    return _star(spark, sf, "fact_articles_by_day")


@query
def wh_rejected_days(spark, sf):
    return warehouse.rejected_days(aggregates.articles_by_date(clean(spark, sf)))


@query
def wh_fact_keywords(spark, sf):
    return _star(spark, sf, "fact_keywords")


@query
def wh_fact_articles(spark, sf):
    return _star(spark, sf, "fact_articles")


@query
def wh_summary(spark, sf):
    return _star(spark, sf, "warehouse_summary")


@query
def load_stats(spark, sf):
    rows = stored_clean(spark, sf)
    return warehouse.count_parts(
        {
            "articles": rows,
            "sources": aggregates.articles_by_source(rows),
            "categories": aggregates.articles_by_category(rows),
            "languages": aggregates.articles_by_language(rows),
            "dates": aggregates.articles_by_date(rows),
            "keywords": aggregates.top_keywords(rows),
        }
    )


# Lake


@query
def scan_articles(spark, sf):
    """JSON array files, at most FILE_ROWS articles each, read back in order."""
    folder = _array_files(spark, sf)
    read = lake.read_article_files(spark, folder, schemas.BRONZE_ARTICLE, "*.txt")
    place = F.row_number().over(ranking.Window.partitionBy("file_name").orderBy("pos"))
    return read.withColumn("place", place).drop("file_name", "pos")


def _array_files(spark, sf, value=None):
    """Write the derived articles as one JSON document per file."""
    folder = fresh_folder(spark, "json-arrays")
    fields = F.struct("pos", *schemas.names(schemas.BRONZE_ARTICLE))
    block = F.expr(f"pos div {FILE_ROWS}").alias("block")
    files = (
        articles(spark, sf)
        .groupBy(block)
        .agg(F.to_json(F.array_sort(F.collect_list(fields)), {"ignoreNullFields": "false"}).alias("value"))
    )
    if value is not None:
        files = files.withColumn("value", value)
    files.write.partitionBy("block").text(folder)
    return folder


@query
def json_roundtrip(spark, sf):
    folder = fresh_folder(spark, "json-lines")
    lake.write_json(articles(spark, sf), folder)
    return spark.read.schema(schemas.BRONZE_ARTICLE + ", pos bigint").json(folder)


@query
def bronze_history(spark, sf):
    """Two runs of Bronze, the second one repeated: history stays, repeats replace."""
    made = bronze_lake(spark, sf)
    made.add_bronze(articles(spark, sf), NEXT_BATCH)
    made.add_bronze(articles(spark, sf), NEXT_BATCH)
    return (
        made.read_bronze(spark, schemas.BRONZE_ARTICLE)
        .groupBy("file_name")
        .agg(F.count(F.lit(1)).alias("article_count"))
    )


@query
def latest_snapshot(spark, sf):
    """Two Silver runs; the later one is what is read."""
    made = new_lake(spark, "lake")
    silver.write_checked(made, checked(spark, sf), BATCH)
    made.publish(spark, silver.LAYER, BATCH)
    valid = silver.read_checked(spark, made).filter("accepted").drop("accepted")
    silver.write_checked(made, valid, NEXT_BATCH)
    made.publish(spark, silver.LAYER, NEXT_BATCH)
    return silver.read_checked(spark, made).select("pos", "url", "reason")


@query
def newest_run_without_pointer(spark, sf):
    """With no latest pointer the newest file decides."""
    made = new_lake(spark, "lake")
    for run_id, rows in (
        (BATCH, checked(spark, sf)),
        (NEXT_BATCH, clean(spark, sf).withColumn("reason", F.lit("ok"))),
    ):
        silver.write_checked(made, rows, run_id)
    return silver.read_checked(spark, made).agg(F.count(F.lit(1)).alias("article_count"))


@query
def silver_build(spark, sf):
    """Bronze to Silver through the lake, in the order of the Bronze files."""
    made = bronze_lake(spark, sf)
    silver.build_silver(spark, made, BATCH, F.lit(STAMP))
    return silver.read_silver(spark, made).drop("processed_at")


@query
def lake_run(spark, sf):
    """A whole run over all layers; rows of every table it leaves."""
    made = new_lake(spark, "lake")
    if not run.run_lake(spark, made, articles(spark, sf)):
        raise RuntimeError("the run failed")
    parts = {
        "bronze": made.read_bronze(spark, schemas.BRONZE_ARTICLE),
        "silver": silver.read_silver(spark, made),
        "events": made.read_latest(
            spark, quality_plan.EVENT_LAYER, quality_plan.EVENTS, quality_plan.STORED_EVENT
        ),
        "warehouse_events": lake.read_or_empty(
            spark, made.path(warehouse.LAYER, warehouse.EVENT_TABLE), schemas.WAREHOUSE_EVENT
        ),
        "gold_articles": made.read_latest(spark, gold.LAYER, gold.ARTICLES, schemas.SILVER_ARTICLE),
    }
    for name in schemas.GOLD_TABLES:
        parts[name] = gold.read_gold(spark, made, name)
    for name in schemas.WAREHOUSE_TABLES:
        parts[name] = warehouse.read_warehouse(spark, made, name)
    return warehouse.count_parts(parts)


# Events


@query
def event_sequence_files(spark, sf):
    """Numbering over very many small files with sparse positions."""
    rows = clean(spark, sf).select(
        F.concat(F.lit("f"), F.expr("pos div 3")).alias("file_name"), (F.col("pos") * 1_000_003).alias("pos"), "url"
    )
    return sequence.number_rows(rows, "file_name", "pos")


@query
def event_sequence(spark, sf):
    return sequence.number_rows(stored_clean(spark, sf), "file_name", "pos", stored=True).select("pos", "url", "sequence")


def _events(spark, sf, batch):
    return publish.batch_events(stored_clean(spark, sf), batch, F.lit(STAMP), stored=True)


@query
def build_events(spark, sf):
    return _events(spark, sf, BATCH).select(
        "event_id", "event_type", "batch_id", "source", "url", "title", "publication_date",
        "language", "category", F.col("payload.content_length").alias("payload_length"), "sequence",
    )


@query
def event_upsert(spark, sf):
    """A batch, then its replay with other titles together with a new batch."""
    rows = stored_clean(spark, sf)
    first = publish.batch_events(rows, BATCH, F.lit(STAMP))
    replay = first.withColumn("title", F.upper("title")).unionByName(publish.batch_events(rows, NEXT_BATCH, F.lit(STAMP)))
    known = events.warehouse_events(first, F.lit("2026-05-06T12:00:00"))
    later = events.warehouse_events(replay, F.lit("2026-05-06T13:00:00"))
    return events.upsert(known, later)


@query
def event_upsert_stored(spark, sf):
    """The same through the stored event table, a partition per batch."""
    made = new_lake(spark, "lake")
    rows = stored_clean(spark, sf)
    first = publish.batch_events(rows, BATCH, F.lit(STAMP))
    warehouse.upsert_events(spark, made, first, BATCH, F.lit("2026-05-06T12:00:00"))
    replay = first.withColumn("title", F.upper("title"))
    warehouse.upsert_events(spark, made, replay, BATCH, F.lit("2026-05-06T13:00:00"))
    warehouse.upsert_events(spark, made, publish.batch_events(rows, NEXT_BATCH, F.lit(STAMP)), NEXT_BATCH, F.lit("2026-05-06T13:00:00"))
    return spark.read.schema(schemas.WAREHOUSE_EVENT).parquet(made.path(warehouse.LAYER, warehouse.EVENT_TABLE))


@query
def event_upsert_log(spark, sf):
    """The event log merged by user: known users keep their row, new ones get their first,
    and all time stamps move on."""
    log = table(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("event_id"), "event_type", "value",
        F.col("ts").cast("timestamp_ntz").alias("loaded_at"), F.col("event_id").alias("log_id"),
    )
    known = events.upsert(log.filter("false"), log.filter(F.col("log_id") % 9 == 0))
    return events.upsert(known, log.filter(F.col("log_id") % 9 != 0))


def _article_stream(spark, sf):
    """A file stream over derived articles that come in three files, one per micro-batch."""
    return _streamed(spark, clean(spark, sf), schemas.SILVER_ARTICLE)


def _streamed(spark, rows, schema):
    """A file stream over rows that come in three parts, one after the other, each in as many files as
    there were tasks; a part is a micro-batch."""
    folder = fresh_folder(spark, "articles")
    rows = staged(rows, "stream-rows")
    end = rows.agg(F.max("pos")).first()[0]
    # Rows without a place come first.
    third = F.coalesce(F.expr(f"pos * 3 div {(end or 0) + 1}"), F.lit(0))
    most = 1
    for part in range(3):
        rows.filter(third == part).write.mode("append").parquet(folder)
        most = max(most, len([n for n in lake.names_in(spark, folder) if n.endswith(".parquet")]))
    release(rows)
    return publish.read_article_stream(spark, folder, schema + ", file_name string, pos bigint", batch_files=max(1, -(-most // 3)))


@query
def stream_publish(spark, sf):
    out = fresh_folder(spark, "stream-events")
    stream = publish.publish_stream(
        _article_stream(spark, sf), out, fresh_folder(spark, "stream-state"), F.lit(STAMP)
    )
    stream.awaitTermination()
    stored = schemas.EVENT + ", sequence bigint"
    return spark.read.schema(stored).parquet(out).select(
        "event_id", "batch_id", "url", "title", "language", "sequence"
    )


def _drain(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream over what is there and read what it wrote."""
    spark = stream.sparkSession
    out = fresh_folder(spark, name)
    (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", fresh_folder(spark, name + "-state"))
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(out)


@query
def stream_dedup(spark, sf):
    stream = _streamed(spark, raw(spark, sf), schemas.BRONZE_ARTICLE)
    return _drain(dedup.first_article_seen(stream, "400 days").select("url"), "dedup")


@query
def stream_dedup_exact(spark, sf):
    """Two queries with checkpoints of their own into one table, the second over the same rows again."""
    out = fresh_folder(spark, "dedup-exact")
    stream = _streamed(spark, raw(spark, sf), schemas.BRONZE_ARTICLE)
    for _ in range(2):
        dedup.keep_first_ever(stream, out, fresh_folder(spark, "dedup-exact-state")).awaitTermination()
    schema = schemas.BRONZE_ARTICLE + ", file_name string, pos bigint"
    return spark.read.schema(schema).parquet(out).select("pos", "url")


@query
def stream_dedup_log(spark, sf):
    """Users of the event log, each once."""
    source = table(spark, sf, "events")
    stream = spark.readStream.schema(source.schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    seen = dedup.first_seen(stream, "user_id", "4000 days")
    return _drain(seen.select("user_id"), "dedup-log")


# Pages and feeds


@query
def page_links(spark, sf):
    return links.page_links(pages(spark, sf)).select("page_id", "pos", "href")


@query
def page_links_resolved(spark, sf):
    return links.resolved_links(pages(spark, sf)).select("page_id", "pos", "href")


@query
def link_filter(spark, sf):
    """Links of every kind (derived by their position) under the rule of a site."""
    base = markup.site_base(F.col("url"))
    site = F.element_at(
        F.array(*[F.lit(k) for k in ("hespress", "akhbarona", "barlamane")]),
        (F.col("page_id") % 3 + 1).cast("int"),
    )
    ending = F.element_at(
        F.array(*[F.lit(e) for e in (".html", "/12.html", "/tag/x", "/a/b", "")]),
        (F.col("pos") % 5 + 1).cast("int"),
    )
    rows = links.resolved_links(pages(spark, sf)).select(
        "page_id", "pos", F.concat("href", ending).alias("href"), site.alias("site"), base.alias("base")
    )
    wanted = links.is_article_link(F.col("href"), F.col("site"), F.col("base"))
    return rows.filter(wanted).select("page_id", "pos", "site", "href")


@query
def top_links_per_page(spark, sf):
    """The first distinct links of each page; links repeat through a cut path."""
    base = markup.site_base(F.col("url"))
    based = pages(spark, sf).select("page_id", "html", base.alias("base"))
    found = links.first_links(F.col("html"), F.col("base"), lambda h: h.startswith(F.col("base")), n=3)
    return based.select("page_id", F.posexplode(found).alias("rank", "href"))


@query
def crawl_cap(spark, sf):
    candidates = raw(spark, sf).withColumns(
        {
            "category_rank": F.col("pos") % 6,
            "succeeded": ~text.is_blank(F.col("title")) & ~text.is_blank(F.col("content")),
        }
    )
    return crawl.cap_articles(candidates, "succeeded", sites.ARTICLES_PER_SOURCE).select("source", "url", "category_rank", "pos")


@query
def source_union_counts(spark, sf):
    return crawl.source_counts(raw(spark, sf))


@query
def page_title(spark, sf):
    return pages(spark, sf).select("page_id", markup.page_title(F.col("html")).alias("title"))


@query
def page_body(spark, sf):
    return pages(spark, sf).select("page_id", markup.page_body(F.col("html")).alias("body"))


@query
def body_cut(spark, sf):
    """Page bodies cut to length, empty ones dropped."""
    body = pages(spark, sf).select("page_id", markup.page_body(F.col("html")).alias("body"))
    return body.filter(~text.is_blank(F.col("body"))).select(
        "page_id", extraction.cut_content(F.col("body"), sites.MAX_CONTENT).alias("content")
    )


# Marks that the given pages lack, put before each article.
BYLINE = (
    '<span class="x Post-Author">By <i>Ann </i>&amp; Bo</span><time datetime="2026-05-06">today</time>'
    '<div class="Breadcrumb"><a>Home</a> <a>World <b>news</b></a></div><article>'
)


@query
def page_metadata(spark, sf):
    """All fields of each page, read by the rules of one site."""
    marked = pages(spark, sf).select(
        "page_id", "url", F.lit("hespress").alias("site"),
        F.replace("html", F.lit("<article>"), F.lit(BYLINE)).alias("html"),
    )
    return extraction.parse_pages(marked).drop("site", "url", "error")


def _sited(spark, sf):
    key = F.element_at(
        F.array(*[F.lit(s.key) for s in sites.SITES]), (F.col("page_id") % len(sites.SITES) + 1).cast("int")
    )
    return pages(spark, sf).withColumn("site", key)


@query
def page_articles(spark, sf):
    """Articles of the pages under the rules of all six sites."""
    parsed = extraction.parse_pages(_sited(spark, sf))
    return extraction.finish(parsed, F.lit(STAMP), keep=("page_id",))


@query
def page_outcomes(spark, sf):
    """Per site: pages read, pages that failed, articles made."""
    return crawl.site_outcomes(extraction.parse_pages(_sited(spark, sf)))


def _crawl(spark, sf):
    """The given pages as pages of the six sites, with derived listings and feeds."""
    base = F.element_at(
        F.create_map(*[F.lit(x) for s in sites.SITES for x in (s.key, s.base)]), F.col("site")
    )
    path = F.concat(F.lit("/"), F.col("page_id").cast("string"), F.lit(".html"))
    placed = _sited(spark, sf).withColumn("url", F.concat(base, path))
    anchor = F.struct("page_id", F.concat(F.lit('<a href="'), path, F.lit('">x</a>')).alias("a"))
    listings = placed.groupBy("site", F.expr("page_id div 60").alias("category_rank")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(anchor)), lambda x: x["a"]), " ").alias("html")
    )
    feeds_of = placed.filter(F.col("site").isin([s.key for s in sites.SITES if s.feed]))
    items = feeds_of.select(
        "site", F.lit(0).alias("category_rank"), F.col("page_id").alias("pos"),
        F.concat(F.lit("Item "), F.col("page_id").cast("string")).alias("title"), "url",
        F.lit("Mon, 06 May 2026 12:00:00 GMT").alias("publication_date"),
        F.concat(F.lit("about "), "url").alias("description"), F.lit("world").alias("category"),
    )
    pages_of = placed.select("page_id", "url", "html")
    return run.Crawl(listings, items, pages_of)


@query
def bronze_build(spark, sf):
    """Articles of a crawl, all of them."""
    return _crawl(spark, sf).articles(F.lit(STAMP)).drop("pos")


@query
def crawl_to_gold(spark, sf):
    """A whole run from pages and feeds: what Bronze got, and that all layers follow."""
    made = new_lake(spark, "lake")
    if not run.run_lake(spark, made, _crawl(spark, sf)):
        raise RuntimeError("the run failed")
    board = gold.read_dashboard(spark, made)
    bronze_rows = made.read_bronze(spark, schemas.BRONZE_ARTICLE)
    clean_rows = silver.read_silver(spark, made).groupBy("source").agg(F.count(F.lit(1)).alias("silver"))
    return (
        bronze_rows.groupBy("source").agg(F.count(F.lit(1)).alias("bronze"))
        .join(clean_rows, "source", "left")
        .join(board["by_source"].withColumnRenamed("article_count", "shown"), "source", "left")
        .select("source", "bronze", (F.coalesce("silver", F.lit(0)) == F.coalesce("shown", F.lit(0))).alias("shown_whole"))
    )


@query
def crawl_outcomes(spark, sf):
    """What a run reports of the pages of each site, when the feed of one site and all pages of another are empty."""
    made = new_lake(spark, "lake")
    whole = _crawl(spark, sf)
    blank = F.when(extraction.site_of(F.col("url")) == "hespress", "").otherwise(F.col("html"))
    items = whole.items.filter(F.col("site") != "reuters")
    steps = tuple(s for s in run.STEPS if s != "bronze")
    run.run_lake(spark, made, run.Crawl(whole.listings, items, whole.pages.withColumn("html", blank)), skip=steps)
    schema = "site string, pages bigint, failed bigint, articles bigint"
    return spark.read.schema(schema).json(made.path("reports", run.CRAWLS))


@query
def body_fallback(spark, sf):
    """Guarded pages and pages without a body fall back to the description."""
    rows = pages(spark, sf).select(
        "page_id",
        F.when(F.col("page_id") % 5 == 0, F.concat("html", F.lit("Please enable JS"))).otherwise(F.col("html")).alias("html"),
        F.when(F.col("page_id") % 7 == 0, "").otherwise(markup.page_body(F.col("html"))).alias("body"),
        F.concat(F.lit("about "), "url").alias("description"),
    )
    guarded = extraction.is_guarded(F.col("html"), sites.BY_KEY["reuters"].guards)
    return rows.select(
        "page_id",
        extraction.body_or_description(guarded, F.col("body"), F.col("description")).alias("content"),
    )


def _feed_rows(spark, sf):
    """Feed items derived from documents, spread over the sites with feeds."""
    key = F.element_at(F.array(*[F.lit(s.key) for s in sites.SITES if s.feed]), (F.col("doc_id") % 3 + 1).cast("int"))
    link = (
        F.when(F.col("doc_id") % 10 == 0, "")
        .when(F.col("doc_id") % 3 == 1, F.concat(F.lit("/news/"), "doc_id"))
        .when(F.col("doc_id") % 7 == 0, F.concat(F.lit("https://other.example/"), "doc_id"))
        .otherwise(F.concat(F.lit("https://www.bbc.com/news/"), "doc_id"))
    )
    return table(spark, sf, "documents").select(
        F.when(F.col("doc_id") % 11 == 0, " ").otherwise(F.concat(F.lit("  Item "), "doc_id", F.lit(" "))).alias("title"),
        link.alias("link"),
        F.lit("Mon, 06 May 2026 12:00:00 GMT").alias("pubDate"),
        F.concat(F.lit("<p>"), "text", F.lit("</p> &amp; more")).alias("description"),
        key.alias("site"),
        F.element_at(F.array(F.lit("world"), F.lit("business")), (F.col("doc_id") % 2 + 1).cast("int")).alias("category"),
    )


@query
def rss_items(spark, sf):
    folder = fresh_folder(spark, "feeds")
    (
        _feed_rows(spark, sf).write.format("xml").option("rootTag", "channel").option("rowTag", "item")
        .partitionBy("site", "category").save(folder)
    )
    return feeds.read_feeds(spark, folder, {"bbc_news": ("world", "business"), "reuters": ("business",)}).drop("pos")


@query
def feed_outcomes(spark, sf):
    """Feeds of which the files of one site are no XML: they are counted, and the others give all their items."""
    folder = fresh_folder(spark, "feeds")
    rows = _feed_rows(spark, sf)
    # A feed too large for one task is written in several files.
    rows.hint("rebalance", "site", "category").write.format("xml").option("rootTag", "channel").option("rowTag", "item").partitionBy(
        "site", "category"
    ).save(folder)
    for category in lake.names_in(spark, f"{folder}/site=reuters"):
        for name in lake.names_in(spark, f"{folder}/site=reuters/{category}"):
            files, location = lake._file_system(spark, f"{folder}/site=reuters/{category}/{name}")
            out = files.create(location, True)
            out.write(bytearray(b"\x00\x01 no feed"))
            out.close()
    return feeds.feed_outcomes(spark, folder).select("site", "category", "items", (F.col("unreadable") > 0).alias("unreadable"))


@query
def rss_join_pages(spark, sf):
    """Items joined to their own pages, one to one; unfetched ones drop out. A URL may be that of several pages."""
    fetched = pages(spark, sf).select(F.col("page_id").alias("doc_id"), "url", markup.page_body(F.col("html")).alias("body"))
    return table(spark, sf, "documents").select("doc_id").join(fetched, "doc_id")


# Data quality


def _count(df, checks, *types):
    wanted = [c for c in checks(df) if c.type in types]
    return quality.count_violations(df, wanted)


@query
def dq_q3_bronze_required(spark, sf):
    return _count(raw(spark, sf), quality.bronze_checks, "missing_field")


@query
def dq_q4_bronze_short_content(spark, sf):
    return _count(raw(spark, sf), quality.bronze_checks, "content_quality")


@query
def dq_q7_silver_required(spark, sf):
    return _count(foreign_silver(spark, sf), quality.silver_checks, "missing_field")


@query
def dq_q8_silver_markup(spark, sf):
    return _count(foreign_silver(spark, sf), quality.silver_checks, "normalization_error")


@query
def dq_q9_silver_language(spark, sf):
    return _count(foreign_silver(spark, sf), quality.silver_checks, "language_detection")


@query
def dq_q10_silver_dates(spark, sf):
    return _count(foreign_silver(spark, sf), quality.silver_checks, "date_format")


@query
def dq_silver_clean(spark, sf):
    """All Silver checks over our own Silver."""
    rows = clean(spark, sf)
    return quality.count_violations(rows, quality.silver_checks(rows))


def _broken_events(spark, sf):
    return _events(spark, sf, BATCH).withColumns(
        {
            "event_type": F.when(F.col("sequence") % 5 == 0, "other").otherwise(F.col("event_type")),
            "batch_id": F.when(F.col("sequence") % 7 == 0, "").otherwise(F.col("batch_id")),
        }
    )


@query
def dq_q13_event_required(spark, sf):
    return _count(_broken_events(spark, sf), quality.event_checks, "missing_field")


@query
def dq_q14_event_type(spark, sf):
    return _count(_broken_events(spark, sf), quality.event_checks, "invalid_event_type")


@query
def dq_q2_q6_files(spark, sf):
    """Derived files: arrays, objects and broken JSON in turn."""
    value = (
        F.when(F.col("block") % 3 == 1, F.concat(F.lit('{"articles":'), "value", F.lit("}")))
        .when(F.col("block") % 3 == 2, F.concat("value", F.lit("oops")))
        .otherwise(F.col("value"))
    )
    folder = _array_files(spark, sf, value)
    return quality_plan.file_issues(spark, folder, "bronze", "*.txt")


@query
def dq_q1_q5_bronze_layer(spark, sf):
    """A lake whose files are two days old by the clock given."""
    made = bronze_lake(spark, sf)
    now = F.current_timestamp() + F.expr("INTERVAL 2 DAYS")
    return quality_plan.bronze_issues(spark, made, now)


@query
def dq_q1_no_bronze(spark, sf):
    """A Bronze folder that holds no data file."""
    made = new_lake(spark, "lake")
    made.add_bronze(articles(spark, sf).filter("pos < 0"), BATCH)
    return quality_plan.bronze_issues(spark, made, F.current_timestamp())


@query
def dq_q12_empty_events(spark, sf):
    """A published event batch without events."""
    made = new_lake(spark, "lake")
    made.write_run(_events(spark, sf, BATCH).filter("sequence < 0"), quality_plan.EVENT_LAYER, quality_plan.EVENTS, BATCH)
    made.publish(spark, quality_plan.EVENT_LAYER, BATCH)
    return quality_plan.event_issues(spark, made).filter("type = 'empty_data'")


@query
def dq_report_stats(spark, sf):
    """A whole check of a lake with one damaged Silver file: it ends, and says so."""
    made = bronze_lake(spark, sf)
    silver.build_silver(spark, made, BATCH, F.lit(STAMP))
    damaged = made.path(silver.LAYER, "run_id=damaged", "articles")
    table(spark, sf, "documents").limit(1).select(F.lit("no table").alias("value")).coalesce(1).write.option(
        "compression", "none"
    ).text(damaged + "-text")
    for name in lake.names_in(spark, damaged + "-text"):
        if name.startswith("part-"):
            files, source = lake._file_system(spark, f"{damaged}-text/{name}")
            files.rename(source, spark._jvm.org.apache.hadoop.fs.Path(f"{damaged}-text/x.parquet"))
    report = quality_plan.check_lake(spark, made, F.current_timestamp())
    errors = F.filter("issues", lambda i: i["type"] == "file_error")
    return report.select(
        F.col("stats.total_articles").alias("total_articles"), (F.col("stats.bronze_files") > 0).alias("has_bronze"),
        F.col("stats.gold_files").alias("gold_files"), F.size(errors).cast("bigint").alias("damaged_layers"),
    )


@query
def silver_incremental(spark, sf):
    """Silver built from one Bronze run, and then from a second one that only the new rows are cleaned of."""
    made = new_lake(spark, "lake")
    later = F.coalesce(F.col("pos") % 3 == 0, F.lit(False))
    rows = articles(spark, sf)
    made.add_bronze(rows.filter(~later), BATCH)
    silver.build_silver(spark, made, BATCH, F.lit(STAMP))
    made.add_bronze(rows.filter(later), NEXT_BATCH)
    silver.build_silver(spark, made, NEXT_BATCH, F.lit(STAMP))
    return silver.read_checked(spark, made).select("pos", "url", "title", "content_length", "language", "reason")


@query
def lake_facts(spark, sf):
    """Articles of both layers in all, by language and by source."""
    made = bronze_lake(spark, sf)
    silver.build_silver(spark, made, BATCH, F.lit(STAMP))
    return quality_plan.lake_facts(spark, made)


@query
def dq_damaged_pages(spark, sf):
    """An audit of articles in 64 parts, of which one has its data overwritten while its footers stay whole."""
    folder = fresh_folder(spark, "damaged")
    schema = "pos bigint, title string, url string, content string"
    part = F.coalesce(F.pmod("pos", F.lit(64)), F.lit(0)).alias("part")
    raw(spark, sf).select("pos", "title", "url", "content", part).repartition("part").write.partitionBy("part").parquet(folder)
    for name in lake.names_in(spark, f"{folder}/part=1"):
        if name.endswith(".parquet"):
            _overwrite_data(spark, f"{folder}/part=1/{name}")
    audit = lake.audit_table_files(spark, folder, {folder: schema})
    part = F.regexp_extract("file_name", "/part=([0-9]+)/", 1).cast("bigint").alias("part")
    return audit.groupBy(part).agg(F.sum("rows").alias("n_rows"), F.sum("readable").alias("n_readable"), F.max("status").alias("status"))


def _overwrite_data(spark, path):
    """Zeros in place of all data of a Parquet file; its footer, which gives its own length, stays."""
    data = bytearray(spark.read.format("binaryFile").load(path).first().content)
    footer = 8 + int.from_bytes(data[-8:-4], "little")
    data[4 : len(data) - footer] = bytes(len(data) - footer - 4)
    files, location = lake._file_system(spark, path)
    out = files.create(location, True)
    out.write(data)
    out.close()


@query
def articles_per_language_and_source(spark, sf):
    rows = raw(spark, sf)
    by_language = crawl.counts_by(rows, "language").select(F.lit("language").alias("kind"), F.col("language").alias("name"), "article_count")
    by_source = crawl.counts_by(rows, "source").select(F.lit("source").alias("kind"), F.col("source").alias("name"), "article_count")
    return by_language.unionByName(by_source)


@query
def gold_defaults(spark, sf):
    """Gold of which one table was built: the others read as empty."""
    made = new_lake(spark, "lake")
    made.write_run(aggregates.articles_by_source(clean(spark, sf)), gold.LAYER, "articles_by_source", BATCH)
    made.publish(spark, gold.LAYER, BATCH)
    return warehouse.count_parts(gold.read_all_gold(spark, made))


@query
def run_report(spark, sf):
    """The report of a run in which the event mirror fails: the run goes on."""
    made = new_lake(spark, "lake")
    # A file where the mirror wants a folder.
    files, place = lake._file_system(spark, made.path(warehouse.LAYER, warehouse.EVENT_TABLE))
    files.mkdirs(place.getParent())
    files.create(place, False).close()
    if not run.run_lake(spark, made, articles(spark, sf)):
        raise RuntimeError("the run failed")
    report = spark.read.schema(run.REPORT + ", success boolean").json(made.path("reports", "runs"))
    counters = F.col("counters")
    return report.select(
        "step", "status", "success", F.coalesce(counters["articles"], counters["event_count"]).cast("bigint").alias("rows")
    )


@query
def dq_q11_q12_event_layer(spark, sf):
    """An event layer that was written but never made the latest."""
    made = new_lake(spark, "lake")
    made.write_run(_events(spark, sf, BATCH), quality_plan.EVENT_LAYER, quality_plan.EVENTS, BATCH)
    return quality_plan.event_issues(spark, made)


@query
def dq_q15_q19_gold_layer(spark, sf):
    """Gold with a table missing, one empty and one of broken rows."""
    made = new_lake(spark, "lake")
    rows = stored_clean(spark, sf)
    tables = gold.gold_tables(rows, rows, F.lit(STAMP))
    tables.pop("articles_by_date")
    tables["articles_by_category"] = tables["articles_by_category"].limit(0)
    tables["articles_by_source"] = tables["articles_by_source"].withColumn(
        "source", F.when(~F.col("source").startswith("src"), F.col("source"))
    )
    for name, table_rows in tables.items():
        made.write_run(table_rows.coalesce(1), gold.LAYER, name, BATCH)
    made.publish(spark, gold.LAYER, BATCH)
    return quality_plan.gold_issues(spark, made)


@query
def dq_q16_q17_summary(spark, sf):
    rows = stored_clean(spark, sf)
    empty = aggregates.summary_stats(rows.limit(0)).withColumn(
        "generated_at", F.lit(None).cast("string")
    )
    full = aggregates.summary_stats(rows).withColumn("generated_at", F.lit(STAMP))
    both = empty.unionByName(full)
    return quality.count_violations(both, quality.summary_checks(both))


@query
def dq_q20_q21_consistency(spark, sf):
    """Bronze holds the history of two runs, so Silver looks small beside it;
    Gold was built from all checked rows."""
    counts = warehouse.count_parts(
        {"bronze": raw(spark, sf).unionByName(raw(spark, sf)), "silver": clean(spark, sf), "gold": checked(spark, sf)}
    ).agg(*[F.max(F.when(F.col("part") == p, F.col("n"))).alias(p) for p in ("bronze", "silver", "gold")])
    return counts.select(
        "bronze", "silver", "gold",
        quality.too_few_silver(F.col("silver"), F.col("bronze")).alias("article_count_mismatch"),
        quality.summary_differs(F.col("gold"), F.col("silver")).alias("summary_mismatch"),
    )


@query
def dq_q22_score(spark, sf):
    """Score by source: its articles with no title as errors, no author as warnings."""
    issues = raw(spark, sf).groupBy("source").agg(
        F.sum(text.is_blank(F.col("title")).cast("int")).alias("errors"),
        F.sum(F.col("author").isNull().cast("int")).alias("warnings"),
    )
    # Scaled down to where the score is not yet at its floor.
    scaled = issues.select(
        "source", (F.col("errors") % 3).alias("errors"), (F.col("warnings") % 12).alias("warnings")
    )
    score = quality.quality_score(F.col("errors"), F.col("warnings"))
    return scaled.withColumn("quality_score", score).withColumn("verdict", quality.verdict(F.col("quality_score")))


@query
def dq_q23_report(spark, sf):
    rows = foreign_silver(spark, sf)
    issues = quality.count_violations(rows, quality.silver_checks(rows))
    report = quality_plan.quality_report(issues, None, F.lit(STAMP))
    return report.select(
        "errors", "warnings", "quality_score", "verdict", "acceptable", F.size("issues").cast("bigint").alias("fired")
    )


@query
def dq_w9_sample_issues(spark, sf):
    rows = foreign_silver(spark, sf)
    return quality.sample_violations(rows, quality.silver_checks(rows), ["pos"]).select(
        "pos", "type", "severity", "message"
    )
