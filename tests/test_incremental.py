"""Silver that grows with Bronze equals Silver built anew, and numbering computes each row once."""

import random

import pytest
from pyspark.sql import functions as F

from newsloom import schemas
from newsloom.operators.sequence import number_rows
from newsloom.plans import silver
from newsloom.sources.lake import Lake

RAW = schemas.BRONZE_ARTICLE + ", pos bigint"
NAMES = [c.split()[0] for c in RAW.split(", ")]


def articles(spark, seed, n=30):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        row = dict.fromkeys(NAMES)
        row |= {
            "title": r.choice(["A title", "x", None]), "content": r.choice(["long text " * 9, "short"]) + str(i),
            "source": r.choice(["BBC", "Al Jazeera", "Zed"]), "url": r.choice([f"u{r.randrange(25)}", None, ""]), "pos": i,
        }
        rows.append(tuple(row[c] for c in NAMES))
    return spark.createDataFrame(rows, RAW)


def rows_of(spark, lake):
    return sorted(map(str, silver.read_checked(spark, lake).drop("processed_at").collect()))


@pytest.mark.parametrize("most", [16, 2])
def test_growing_equals_full(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(silver, "MOST_PARTS", most)
    grown, whole = Lake(f"file:{tmp_path}/grown"), Lake(f"file:{tmp_path}/whole")
    cleaned = []
    for n in range(4):
        for lake in (grown, whole):
            lake.add_bronze(articles(spark, n), f"r{n}")
        stats = silver.build_silver(spark, grown, f"s{n}", F.lit("t"))
        again = silver.build_silver(spark, whole, f"s{n}", F.lit("t"), full=True)
        cleaned.append((stats.pop("cleaned"), again.pop("cleaned")))
        assert stats == again and stats["total"] == 30 * (n + 1)
        assert rows_of(spark, grown) == rows_of(spark, whole)
        # Earlier runs read as they did.
        assert silver._read_parts(spark, grown, silver._parts(spark, grown, "s0")).count() == cleaned[0][0]
    assert all(part < full for part, full in cleaned[1:])


def test_what_changes_is_cleaned_again(spark, tmp_path):
    lake = Lake(f"file:{tmp_path}/lake")
    lake.add_bronze(articles(spark, 1), "r1")
    first = silver.build_silver(spark, lake, "s1", F.lit("t"))
    assert silver.build_silver(spark, lake, "s2", F.lit("t"))["cleaned"] == 0
    assert silver.build_silver(spark, lake, "s2", F.lit("t"))["cleaned"] == first["cleaned"]
    lake.add_bronze(articles(spark, 2), "r1")
    changed = silver.build_silver(spark, lake, "s3", F.lit("t"))
    assert changed["cleaned"] == changed["valid"] + changed["invalid"] > 0
    whole = rows_of(spark, lake)
    silver.build_silver(spark, lake, "s4", F.lit("t"), full=True)
    assert rows_of(spark, lake) == whole


def test_numbering_computes_each_row_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def touch(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    rows = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("a"), F.when(F.col("id") > 3, F.col("id")).alias("b"))
    numbered = number_rows(rows.mapInArrow(touch, rows.schema), "a", "b")
    assert numbered.columns == ["a", "b", "sequence"]
    got = sorted((r.sequence, r.a) for r in numbered.collect())
    assert got == [(i + 1, i) for i in range(5000)]
    assert seen.value == 5000


def test_numbering_with_nulls(spark):
    rows = spark.createDataFrame([(None, 2), ("x", 1), (None, 1), ("a", None), ("a", 0)], "f string, p int")
    got = [tuple(r) for r in number_rows(rows, "f", "p").orderBy("sequence").collect()]
    assert got == [(None, 1, 1), (None, 2, 2), ("a", None, 3), ("a", 0, 4), ("x", 1, 5)]
    assert number_rows(rows.filter("false"), "f", "p").collect() == []


@pytest.mark.parametrize("most", [1 << 27, 1 << 15])
def test_keys_in_a_table_pass_the_filter(spark, monkeypatch, most):
    """Every key of the table passes, and few others."""
    from newsloom.operators import keyfilter

    monkeypatch.setattr(keyfilter, "MOST", most)
    table = spark.range(0, 40_000, 2).select(F.col("id").alias("a"), F.concat(F.lit("u"), "id").alias("b"))
    table = table.unionByName(spark.createDataFrame([(None, "x"), (1, None)], "a bigint, b string"))
    rows = spark.range(40_000).select(F.lit("wide").alias("html"), F.col("id").alias("a"), F.concat(F.lit("u"), "id").alias("b"))
    rows = rows.unionByName(spark.createDataFrame([("n", None, "x"), ("n", 1, None)], "html string, a bigint, b string"))
    passed = keyfilter.maybe_in(rows, table, ["a", "b"])
    assert passed.columns == rows.columns
    got = passed.collect()
    assert sum(r.html == "wide" and r.a % 2 == 0 for r in got) == 20_000 and sum(r.html == "n" for r in got) == 2
    assert most < 1 << 20 or sum(r.html == "wide" and r.a % 2 == 1 for r in got) < 2500
    plan = passed._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    assert keyfilter.maybe_in(rows, table.filter("false"), ["a", "b"]).collect() == []


def test_only_wanted_pages_are_parsed(spark, monkeypatch):
    """Pages that no listing links to are not read."""
    from newsloom.operators import extraction
    from newsloom.plans import bronze

    seen = spark.sparkContext.accumulator(0)
    parse = extraction.parse_pages

    def counted(pages, keep=()):
        def touch(batches):
            for batch in batches:
                seen.add(batch.num_rows)
                yield batch

        return parse(pages.mapInArrow(touch, pages.schema), keep)

    monkeypatch.setattr(extraction, "parse_pages", counted)
    base = "https://www.hespress.com"
    pages = spark.createDataFrame([(i, f"{base}/{i}.html", "<h1>x</h1>") for i in range(3000)], "page_id bigint, url string, html string")
    listing = spark.createDataFrame([("hespress", 0, " ".join(f'<a href="/{i}.html">x</a>' for i in range(40)))], "site string, category_rank int, html string")
    items = spark.createDataFrame([], "site string, category_rank int, pos bigint, title string, url string, publication_date string, description string, category string")
    located = pages.withColumn("site", extraction.site_of(F.col("url")))
    read = bronze.read_wanted(bronze.wanted_articles(listing, items), located)
    assert read.count() == 40
    assert 40 <= seen.value < 400
