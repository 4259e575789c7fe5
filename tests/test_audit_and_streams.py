"""Files read to their end, pages in linear time, and keys of streams in few runs."""

import os
import random
import time

import pytest
from pyspark.sql import functions as F

from newsloom.operators import page_tree
from newsloom.operators.extraction import read_page
from newsloom.operators.sites import SITES
from newsloom.sources import lake as lakes
from newsloom.streaming import dedup, publish


def damage(path, start, end):
    data = bytearray(open(path, "rb").read())
    data[start:end] = bytes(end - start)
    with open(path, "wb") as file:
        file.write(data)
    crc = os.path.join(os.path.dirname(path), f".{os.path.basename(path)}.crc")
    if os.path.exists(crc):
        os.remove(crc)


def data_files(folder):
    return sorted(os.path.join(d, n) for d, _, names in os.walk(folder) for n in names if n.endswith(".parquet"))


def footer_of(path):
    data = open(path, "rb").read()
    return len(data) - 8 - int.from_bytes(data[-8:-4], "little")


SCHEMA = "id bigint, text string, tags array<string>"


@pytest.fixture()
def table(spark, tmp_path):
    rows = spark.range(60_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), F.array(F.lit("a")).alias("tags"))
    rows.repartition(6, "id").write.parquet(f"file:{tmp_path}/t")
    spark.createDataFrame([], SCHEMA).coalesce(1).write.mode("append").parquet(f"file:{tmp_path}/t")
    return str(tmp_path / "t")


def audit(spark, folder, schema=SCHEMA):
    found = lakes.audit_table_files(spark, f"file:{folder}", {f"file:{folder}": schema}).collect()
    return {r.file_name.rsplit("/", 1)[1]: (r.status, r.rows, r.readable) for r in found}


def test_sound_files(spark, table):
    found = audit(spark, table)
    assert {s for s, _, _ in found.values()} == {"ok"}
    assert sum(n for _, n, _ in found.values()) == sum(n for _, _, n in found.values()) == 60_000
    assert len(found) == len(data_files(table))


def test_damage_anywhere_is_found(spark, table):
    files = [f for f in data_files(table) if footer_of(f) > 10_000]
    middle = footer_of(files[0]) // 2
    damage(files[0], middle, middle + 4000)  # some pages, whole footer
    damage(files[1], 4, footer_of(files[1]))  # all pages, whole footer
    damage(files[2], os.path.getsize(files[2]) - 8, os.path.getsize(files[2]))  # the footer
    with open(files[3], "wb") as file:
        file.write(b"no table")
    found = audit(spark, table)
    bad = {os.path.basename(f) for f in files[:4]}
    assert {n for n, r in found.items() if r[0] == "file_error"} == bad
    whole = found[os.path.basename(files[0])]
    assert whole[2] < whole[1]
    # Without the schema of the table only the footers are read.
    shallow = {r.file_name.rsplit("/", 1)[1]: r.status for r in lakes.audit_table_files(spark, f"file:{table}").collect()}
    assert {n for n, s in shallow.items() if s == "file_error"} == {os.path.basename(f) for f in files[2:4]}


def test_names_of_silent_files_come_in_blocks(spark, table, monkeypatch):
    monkeypatch.setattr(lakes, "SILENT_FILES", 2)
    for f in data_files(table)[:5]:
        damage(f, os.path.getsize(f) - 8, os.path.getsize(f))
    assert sum(r[0] == "file_error" for r in audit(spark, table).values()) == 5


@pytest.mark.parametrize("part", ["<a ", "<!--", "<!-- >", "</a ", "< ", "<a b='", "<script></", "&amp;", "<?", '<a "', "<!-->", "<![x"])
def test_a_megabyte_of_anything_is_read_at_once(part):
    started = time.process_time()
    page_tree.parse(part * (1_000_000 // len(part)))
    assert time.process_time() - started < 2


def test_text_behind_the_last_tag():
    assert page_tree.parse("<p>a</p> b < c &lt; <i").text("|") == "a|b < c < <i"
    assert page_tree.parse("<p>a<script>x < y").text() == "a"
    assert page_tree.parse("a<!-- b <i>c</i>").text("|") == "a<!-- b <i>c"
    assert page_tree.parse("").text() == ""
    assert read_page("<h1>T</h1>" + "<a " * 300_000, SITES[0])[-1] is None


# Exact deduplication

ROW = "url string, file_name string, pos bigint"


def drain(spark, source, out, state):
    stream = publish.read_article_stream(spark, source, ROW, batch_files=1)
    dedup.keep_first_ever(stream, out, state).awaitTermination()


def test_keys_stay_in_few_runs(spark, tmp_path, monkeypatch):
    """Twenty micro-batches: each URL once, the first of its batch, and few runs of keys."""
    monkeypatch.setattr(dedup, "FAN", 3)
    source, out, state = (f"file:{tmp_path}/{n}" for n in ("in", "out", "state"))
    r, seen, expected = random.Random(7), set(), []
    for batch in range(20):
        rows = [(f"u{r.randrange(60)}" if r.random() > 0.3 else "hot", f"f{batch}", i) for i in range(15)]
        rows += [(None, f"f{batch}", 90), ("", f"f{batch}", 91)]
        for url, file, pos in rows:
            if (url or "") not in seen:
                seen.add(url or "")
                expected.append((url, file, pos))
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").parquet(source)
        if batch in (0, 11, 19):
            drain(spark, source, out, state)
    got = [(x.url, x.file_name, x.pos) for x in spark.read.schema(ROW).parquet(out).collect()]
    # The order of files is that of their times; each came in a write of its own.
    assert sorted(got, key=str) == sorted(expected, key=str)
    runs = [n for _, names, _ in os.walk(tmp_path / "out" / "_keys") for n in names if "-" in n and n[0].isdigit() and len(n) == 25]
    assert len(runs) <= 10
    keys = dedup.SeenKeys(spark, out, next(iter(os.listdir(tmp_path / "out" / "_keys"))))
    outer, _ = keys.runs(keys.query)
    assert outer[0][0] == 0 and outer[-1][1] == 19 and all(a[1] + 1 == b[0] for a, b in zip(outer, outer[1:]))
    assert keys.before(99).count() == len(seen) == keys.before(99).distinct().count()


def test_a_table_without_keys_is_taken_over(spark, tmp_path):
    source, out = f"file:{tmp_path}/in", f"file:{tmp_path}/out"
    spark.createDataFrame([("a", "x", 0), ("b", "x", 1)], ROW).write.parquet(f"{out}/query=old/epoch=0")
    spark.createDataFrame([("a", "f", 0), ("c", "f", 1)], ROW).coalesce(1).write.parquet(source)
    drain(spark, source, out, f"file:{tmp_path}/state")
    assert sorted(r.url for r in spark.read.schema(ROW).parquet(out).collect()) == ["a", "b", "c"]
