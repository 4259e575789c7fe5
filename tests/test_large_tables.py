"""What shows only on larger tables, made small."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsloom.functions import text
from newsloom.llm import topk
from newsloom.operators import extraction, sequence
from newsloom.plans import gold, silver
from newsloom.settings import fresh_folder, staged
from newsloom.sources.lake import names_in
from newsloom.streaming import dedup
from registry import queries as registered
from registry.oracles import ORACLES
from registry.queries import QUERIES
from tests import compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture
def copy_of(spark, tmp_path):
    """The smallest tables with some of them replaced."""

    def make(**changed):
        for name in compare.TABLES:
            rows = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
            changed.get(name, lambda x: x.coalesce(1))(rows).write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return make


def differs(spark, name, folder):
    connection = compare.duckdb.connect()
    for table in compare.TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet/*.parquet')")
    return compare.difference(spark, connection, QUERIES[name], ORACLES[name], folder)


def test_items_meet_their_own_page_where_pages_share_a_url(spark, copy_of):
    shared = F.when(F.col("page_id") % 3 == 0, "https://a.example/same").when(F.col("page_id") % 3 == 1, F.col("url"))
    folder = copy_of(pages=lambda rows: rows.withColumn("url", shared))
    assert differs(spark, "rss_join_pages", folder) == ""


@pytest.fixture
def small_parts(spark):
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "16k")
    yield
    spark.conf.set(name, before)


def test_a_large_feed_is_written_by_several_tasks(spark, small_parts, copy_of, monkeypatch):
    folders = []
    monkeypatch.setattr(registered, "fresh_folder", lambda *x: folders.append(fresh_folder(*x)) or folders[-1])
    assert differs(spark, "feed_outcomes", copy_of(documents=lambda rows: rows.repartition(8))) == ""
    place = f"{folders[0]}/site=bbc_news/category=world"
    assert len([n for n in names_in(spark, place) if n.endswith(".xml")]) > 1


def test_exact_stream_deduplication_stages_digests_only(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(dedup, "staged", lambda rows, name: kept.append(rows.columns) or staged(rows, name))
    query, sql = QUERIES["stream_dedup_exact"], ORACLES["stream_dedup_exact"]
    assert compare.difference(spark, compare.connect(SF_DIR), query, sql, SF_DIR) == ""
    assert kept == [["_key"]] * len(kept) and len(kept) >= 6


def test_few_pages_at_a_time_become_strings():
    n = 1000
    pages = pa.RecordBatch.from_pydict(
        {"page_id": list(range(n)), "site": ["hespress"] * n, "html": [f"<h1>T{i}</h1>" for i in range(n)]}
    )
    parts = list(extraction.PythonParser(["page_id", "site"])(iter([pages])))
    assert max(p.num_rows for p in parts) == extraction.PAGES_AT_A_TIME
    rows = [r for p in parts for r in p.to_pylist()]
    assert [(r["page_id"], r["title"], r["error"]) for r in rows] == [(i, f"T{i}", None) for i in range(n)]


def test_a_second_snapshot_does_not_clean_again(spark, monkeypatch):
    runs = []
    check = silver.check_articles
    monkeypatch.setattr(silver, "check_articles", lambda *x: runs.append(1) or check(*x))
    query, sql = QUERIES["latest_snapshot"], ORACLES["latest_snapshot"]
    assert compare.difference(spark, compare.connect(SF_DIR), query, sql, SF_DIR) == ""
    assert len(runs) == 1


def test_a_run_does_not_copy_stored_articles(spark, monkeypatch):
    copies = []
    for module in (sequence, gold):
        monkeypatch.setattr(module, "staged", lambda rows, name: copies.append(rows.columns) or staged(rows, name))
    assert compare.difference(spark, compare.connect(SF_DIR), QUERIES["lake_run"], ORACLES["lake_run"], SF_DIR) == ""
    assert copies and not any("content" in columns for columns in copies)


def test_texts_are_cleaned_as_by_single_patterns(spark):
    """Every character, in ASCII texts and others, against patterns that take no short cut."""
    char = F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32")
    chars = spark.range(0, 0x11000).filter("id NOT BETWEEN 55296 AND 57343").select(char.alias("c"))
    words = ["abcd", "abc", "ab9cd", "été", "كلمة", "،", "ab", "_abcd", "x" * 9]
    texts = spark.createDataFrame([(f"{a} {b}{c} {a}  {b}. http://x {c}",) for a in words for b in words for c in words], "c string")
    c = F.col("c")
    old = rf"[^{text.WORD}{text.SPACE}\x{{600}}-\x{{6ff}}\x{{c0}}-\x{{24f}}.,!?;:'\x22-]"
    single = F.regexp_replace(F.regexp_replace(c, f"[{text.SPACE}&&[^ ]]", " "), " {2,}", " ")
    count = lambda x: F.length(F.regexp_replace(c, f"[^{x}]+", ""))
    for rows in (chars, chars.select(F.concat(F.lit("é "), c, F.lit("  <")).alias("c")), texts):
        assert rows.filter(text.filter_characters(c) != F.regexp_replace(c, old, " ")).isEmpty()
        assert rows.filter(text.collapse_whitespace(c) != single).isEmpty()
        assert rows.filter(text.remove_urls(c) != F.regexp_replace(c, text.URL_PATTERN, "")).isEmpty()
        whole = F.regexp_extract_all(F.lower(c), F.lit(text._KEYWORD), F.lit(0))
        assert rows.filter(text.keyword_tokens(c) != whole).isEmpty()
        arabic = F.when(c == "", "unknown").when(count(text.ARABIC) > count("a-zA-Z"), "ar").otherwise("en")
        assert rows.filter(text.detect_language(c, F.lit("x")) != arabic).isEmpty()


def test_large_components_and_growing_steps():
    """Sums beyond 2**53 stay exact, and many candidates cost few looks at the bounds."""
    r = np.random.default_rng(3)
    for width in (200, 2**26):
        vectors = r.integers(-width, width, size=(2048, 64))
        queries, ids = vectors[:300], np.arange(2048)
        search = topk._Search(vectors[:32], int((vectors**2).sum(axis=1).max()), 5)
        found = list(search.run(ids, vectors, ids[:300], queries))
        scores = vectors @ queries.T
        expected = [
            (q, i, int(scores[i, q])) for q in range(300) for i in [i for i in np.lexsort((ids, -scores[:, q])) if i != q][:5]
        ]
        assert found == expected
    search = topk._Search(np.zeros((1, 2), np.int64), 2, 2)
    ties = list(search.run(np.array([9, 3, 7, 1]), np.ones((4, 2), np.int64), np.array([3]), np.ones((1, 2), np.int64)))
    assert ties == [(3, 1, 2), (3, 7, 2)]

    looks = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            if isinstance(at, np.ndarray):
                looks.append(len(at))
            return super().__getitem__(at)

    search = topk._Search(vectors[:32], int((vectors**2).sum(axis=1).max()), 5)
    list(search.run(ids, vectors.view(Counted), ids[:20], queries[:20]))
    assert len(looks) <= 3 * 20
