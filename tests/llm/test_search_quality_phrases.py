"""Lexical search, quality and phrases against plain Python, with odd inputs of every kind."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark import Broadcast
from pyspark.sql import functions as F

from newsloom.llm import lexical, phrases, quality
from newsloom.llm.queries import QUERIES
from tests import compare

SF_DIR = "/root/testdata/sf0.001"
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# Lexical search

DOCS = "doc_id bigint, text string, score string, pos int, rank int, n int, terms int, part int"
ITEMS = "item_id bigint, text string, doc_id int, score int"


def ranked(docs, items, k):
    """The whole result by adding up every term of every document."""
    terms = [(d, TERM.findall((t or "").translate(SMALL))) for d, t in docs]
    terms = [(d, ws) for d, ws in terms if ws]
    n_docs, length = len(terms), sum(len(ws) for _, ws in terms)
    df = Counter(w for _, ws in terms for w in set(ws))
    out = []
    for item, text in items:
        scores = []
        for d, ws in terms:
            tf, m = Counter(ws), 50 + (50 * len(ws) * n_docs) // length
            own = set(TERM.findall((text or "").translate(SMALL))) & set(tf)
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * tf[w]) // (1000 * tf[w] + 20 * m)) for w in own)
            if score > 0:
                scores.append((score, d))
        scores.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, i + 1, d, s) for i, (s, d) in enumerate(scores[:k])]
    return sorted(out, key=str)


def texts(seed, n, size, most):
    r = random.Random(seed)
    made = [" ".join(f"Wört{int(r.paretovariate(0.6)) % size}" for _ in range(r.randrange(1, most))) for _ in range(n)]
    return [None, "", " ,;", "ONE one", "é", "x" * 5000, *made, *made[:40], *made[:1] * 30]


def odd_rows(values):
    rows = [(i, t) for i, t in enumerate(values)]
    return rows + [(None, values[10]), (None, values[11]), (12, values[13]), (12, values[12])]


@pytest.mark.parametrize(("k", "postings", "step"), [(5, 1 << 20, 64), (3, 300, 1), (50, 1000, 4)])
def test_search(spark, monkeypatch, k, postings, step):
    monkeypatch.setattr(lexical, "POSTINGS", postings)
    monkeypatch.setattr(lexical, "STEP", step)
    monkeypatch.setattr(lexical, "PIECE", 700)
    docs, items = odd_rows(texts(1, 250, 60, 40)), odd_rows(texts(2, 20, 60, 30))
    docs.append((900, " ".join(texts(3, 300, 60, 20)[6:])))
    frame = spark.createDataFrame([(d, t, "s", 1, 2, 3, 4, 5) for d, t in docs], DOCS).repartition(4)
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], ITEMS)
    got = [tuple(r) for r in lexical.search(frame, asked, k).collect()]
    assert sorted(got, key=str) == ranked(docs, items, k)


def test_search_in_blocks_of_items(spark, monkeypatch):
    monkeypatch.setattr(lexical, "ITEM_BYTES", 400)
    docs, items = odd_rows(texts(1, 60, 30, 20)), odd_rows(texts(2, 12, 30, 10))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = lexical.search(frame, spark.createDataFrame(items, "item_id bigint, text string"), 4).collect()
    assert sorted(map(tuple, got), key=str) == ranked(docs, items, 4)


def test_search_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical.search(empty, items).collect() == []
    assert lexical.search(items.toDF("doc_id", "text"), empty.toDF("item_id", "text")).collect() == []
    assert lexical.search(spark.createDataFrame([(1, None)], "doc_id bigint, text string"), items).collect() == []


def test_search_stops_early():
    """Where the lists agree on the best documents, few are met, and the best are among them."""
    r = np.random.default_rng(4)
    n, many = 20_000, 6
    terms = np.tile(np.arange(many, dtype=np.int32), n)
    tfs = np.repeat(r.pareto(0.8, n) * 5, many) + r.integers(1, 4, n * many)
    tfs = tfs.clip(max=10_000).astype(np.int32)
    block = lexical.Block(np.full(n, 400), np.arange(n + 1) * many, terms, tfs, np.full(many, 900), (n, 400 * n))
    docs, scores = block.search(list(range(many)), 10)
    everything = np.add.reduceat(block.impact, np.arange(n) * many)
    assert sorted(scores)[-10:] == sorted(everything)[-10:]
    assert len(docs) < n / 20
    assert (scores == everything[docs]).all()


# Quality


def test_quality_on_held_out(spark):
    """Held-out labels are met: nearly all clean documents stay and nearly all bad ones go."""
    for folder in (SF_DIR, "/root/testdata/sf0.01"):
        got = {r.doc_id: r for r in QUERIES["op12_quality"](spark, folder).collect()}
        labels = spark.read.parquet(f"{folder}/labels.parquet").collect()
        assert len(got) == spark.read.parquet(f"{folder}/documents.parquet").count()
        for d, row in got.items():
            assert row.held_out == (zlib.crc32(str(d).encode()) % 5 == 0)
            assert 0 <= row.score <= 1 and row.predicted == (row.score >= 0.3)
    held = [(r.quality, got[r.doc_id].predicted) for r in labels if r.doc_id in got and got[r.doc_id].held_out]
    good, bad = [p for q, p in held if q == 1], [p for q, p in held if q == 0]
    assert sum(good) > 0.97 * len(good) and sum(bad) < 0.1 * len(bad)


def test_quality_learns_from_no_held_out_label(spark, tmp_path):
    """Other labels of held-out rows change nothing."""
    for name in ("documents", "labels"):
        frame = spark.read.parquet(f"{SF_DIR}/{name}.parquet")
        if name == "labels":
            frame = frame.withColumn("quality", (frame.quality + quality.held_out().cast("int")) % 2)
        frame.write.parquet(f"{tmp_path}/{name}.parquet")
    one, two = ({r.doc_id: r for r in QUERIES["op12_quality"](spark, folder).collect()} for folder in (SF_DIR, str(tmp_path)))
    assert one == two


def densities(x, sums):
    """The same by numpy's own determinant and solver, class by class."""
    means = {k: s / n for k, n, s, _ in sums}
    covs = {k: (p - np.outer(s, s) / n) / n for k, n, s, p in sums}
    total = sum(n for _, n, _, _ in sums)
    shared = sum(covs[k] * n for k, n, _, _ in sums) / total
    out = {}
    for k in means:
        c = ((1 - quality.POOLED) * covs[k] + quality.POOLED * shared) / quality.SCALE**2
        c = (1 - quality.DIAGONAL) * c + quality.DIAGONAL * np.diag(np.diag(c)) + quality.LEAST_VARIANCE * np.eye(len(c))
        d = (x - means[k]) / quality.SCALE
        out[k] = -0.5 * (d @ np.linalg.solve(c, d) + np.linalg.slogdet(c)[1])
    return out


def test_discriminant_against_plain(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text")
    rows = quality.with_statistics(docs).collect()
    x = np.array([r.stats for r in rows])
    label = np.array([r.doc_id % 2 for r in rows])
    sums = [(k, int((label == k).sum()), x[label == k].sum(0).astype(float), (x[label == k].T @ x[label == k]).astype(float)) for k in (0, 1)]
    marked = spark.createDataFrame([(r.doc_id, r.stats, int(k)) for r, k in zip(rows, label)], "doc_id bigint, stats array<int>, quality int")
    found = quality.class_sums(marked)
    assert all(a[:2] == b[:2] and (a[2] == b[2]).all() and (a[3] == b[3]).all() for a, b in zip(found, sums))
    model = quality.Discriminant(sums)
    for row, score in zip(x, model.scores(x)):
        both = densities(row, sums)
        odds = both[1] - both[0] + math.log(model.prior / (1 - model.prior))
        assert score == pytest.approx(1 / (1 + math.exp(-min(max(odds, -700), 700))), abs=1e-6)


def test_quality_of_odd_rows(spark):
    rows = [(1, None, "a"), (None, "", "b"), (2, " \n", "c"), (3, "x" * 3_000_000, None), (3, "One two. " * 400_000, "d"), (4, "é", "e")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, stats string")
    made = quality.with_statistics(docs)
    labels = spark.createDataFrame([(1, 0), (1, None), (3, 1), (3, 1), (2, 0), (4, 7), (None, 1)], "doc_id bigint, quality int")
    got = quality.predict_quality(made, quality.learn_quality(made, labels)).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 for r in got)
    none = quality.learn_quality(made, labels.filter("false"))
    assert {r.score for r in quality.predict_quality(made, none).collect()} == {0.5}
    assert quality.predict_quality(made.filter("false"), none).collect() == []


def test_statistics_of_long_texts_in_pieces(monkeypatch):
    text = ("One two two THREE! 4 | % e\n" * 50 + "é è. " * 99).encode()
    whole = quality.statistics(text)
    monkeypatch.setattr(quality, "PIECE", 37)
    assert quality.statistics(text) == whole


# Phrases

PIECES, WORDS = re.compile(r"[.,;:!?\x0a-\x0d]"), re.compile(r"[^\x20\x09]+")


def mined(docs, least, percent=80, top=2000):
    """Every phrase by counting, every longer candidate compared with every shorter one."""
    f, n = Counter(), Counter()
    for text, lang in docs:
        for piece in PIECES.split((text or "").translate(SMALL)):
            ws = WORDS.findall(piece)
            n[lang or "und"] += len(ws)
            f.update((lang or "und", tuple(ws[i : i + k])) for k in range(1, 5) for i in range(len(ws) - k + 1))
    frequent = {p: c for p, c in f.items() if c >= least}
    out = []
    for (lang, p), a in frequent.items():
        if len(p) < 2:
            continue
        around = (c for (other, q), c in frequent.items() if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q))))
        if any(100 * c >= percent * a for c in around):
            continue
        cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], n[lang], score))
    out.sort(key=lambda r: (r[0], -r[6], -r[2], r[1].encode()))
    place = Counter()
    rows = []
    for r in out:
        place[r[0]] += 1
        if place[r[0]] <= top:
            rows.append((r[0], place[r[0]], *r[1:]))
    return rows


def prose(seed, n):
    r = random.Random(seed)
    units = ["Big  red dog", "big\tred", "dog", "tip top", "new york city hall", "new york", "a", "A a", "é è"]
    made = ["".join(r.choice(units) + r.choice([" ", " ", "  ", ". ", "\n", ", ", "\x0b"]) for _ in range(r.randrange(1, 25))) for _ in range(n)]
    return [None, "", " \t", "...", "a " * 500, *made, *made[:5] * 3]


@pytest.mark.parametrize(("least", "shard", "top"), [(30, 1 << 21, 2000), (3, 40, 2000), (2, 1, 7), (30, 200, 4)])
def test_phrases(spark, least, shard, top):
    docs = [(t, (None, "en", "und", "fr")[i % 4]) for i, t in enumerate(prose(1, 120))]
    frame = spark.createDataFrame([(t, g, 1, "x", 2) for t, g in docs], "text string, lang string, words int, phrase string, n int").repartition(3)
    got = phrases.mine_phrases(frame, least=least, top=top, shard_words=shard).collect()
    assert sorted(map(tuple, got)) == sorted(mined(docs, least, top=top))


def test_phrases_of_nothing(spark):
    frame = spark.createDataFrame([], "text string, lang string")
    assert phrases.mine_phrases(frame).collect() == []
    assert phrases.mine_phrases(spark.createDataFrame([(None, None), (".", "en")], frame.schema)).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=120))
def test_index_against_counting(row):
    """Both kinds of extension give every phrase with its count and its place in either index."""
    row = [0, *row, 0]
    index = phrases.Index.of("en", [b".", b"x", b"y", b"z"], np.array(row, np.int32))
    found = index.single()
    for length in range(1, phrases.DEPTH + 1):
        found = index.longer(found) if length > 1 else found
        got = {tuple(w): int(s) for w, s in zip(found.words.tolist(), found.size) if s}
        assert got == Counter(tuple(row[i : i + length]) for i in range(len(row) - length + 1) if 0 not in row[i : i + length])
        for starts, line in ((found.left, row), (found.right, row[::-1])):
            order = phrases.sorted_suffixes(np.array(line, np.int32))
            for w, s, n in zip(found.words.tolist(), starts, found.size):
                want = tuple(w) if line is row else tuple(w)[::-1]
                assert all(tuple(line[order[j] : order[j] + length]) == want for j in range(s, s + n))


@pytest.mark.parametrize("bits", [6, 16, 28])
def test_filter_of_frequent_hashes(spark, monkeypatch, bits):
    """Every frequent hash passes, whatever the size of the filter."""
    monkeypatch.setattr(phrases, "FEWEST_BITS", min(bits, 16))
    monkeypatch.setattr(phrases, "MOST_BITS", max(bits, 8))
    r = random.Random(1)
    hashes = [r.randrange(-(2**63), 2**63) for _ in range(500)] + [0, -1, 2**63 - 1, -(2**63)]
    rows = [(h, 1 + i % 3) for i, h in enumerate(hashes)] + [(h, 2) for h in hashes[::2]]
    total = Counter()
    for h, n in rows:
        total[h] += n
    made = phrases._filter(phrases._frequent(spark.createDataFrame(rows, "h bigint, n bigint"), 3))
    frequent = np.array([h for h, n in total.items() if n >= 3], np.int64).view(np.uint64)
    assert made.has(frequent).all()


def test_memory_of_phrase_tasks(spark, monkeypatch, tmp_path):
    """An index goes to disk in groups of few rows and is read row by row, texts come to Python by bytes."""
    groups, settings_seen = [], {}
    names = (phrases.ARROW_BYTES, phrases.READ_ROWS)
    real = phrases.staged

    def spy(df, name, **options):
        settings_seen.setdefault(name, [spark.conf.get(n) for n in names])
        made = real(df, name, **options)
        if name == "phrase-index":
            for file in made.inputFiles():
                meta = pq.ParquetFile(file.removeprefix("file:")).metadata
                groups.extend(meta.row_group(i).num_rows for i in range(meta.num_row_groups))
        return made

    monkeypatch.setattr(phrases, "staged", spy)
    monkeypatch.setattr(phrases, "GROUP_BYTES", 1 << 14)
    before = [spark.conf.get(n) for n in names]
    docs = [(" ".join(random.Random(i).choices("abcdefgh", k=2000)), "en") for i in range(60)]
    got = phrases.mine_phrases(spark.createDataFrame(docs, "text string, lang string").coalesce(1), shard_words=2000).collect()
    assert sorted(map(tuple, got)) == sorted(mined(docs, 30))
    assert sum(groups) == 60 and max(groups) <= 2
    assert settings_seen["phrase-index"][0] == str(phrases.TEXT_BYTES)
    assert settings_seen["frequent-hashes"][1] == settings_seen["phrase-counts"][1] == "1"
    assert [spark.conf.get(n) for n in names] == before


def test_filter_is_small(spark):
    """A filter takes about a byte and a half for each hash, once in a worker, and lets few others through."""
    r = np.random.default_rng(1)
    known, others = r.integers(0, 2**64, (2, 50_000), np.uint64)
    made = phrases._filter(spark.createDataFrame([(int(h),) for h in known.view(np.int64)], "h bigint"))
    assert made.has(known).all()
    assert made.has(others).mean() < 0.02
    assert len(made.bits.value) <= 1.5 * len(known) + 8
    assert isinstance(made.bits, Broadcast)


@pytest.mark.parametrize(("sent", "together", "at_a_time", "least"), [(2**64 - 4, 50, 7, 9), (2**64 - 2**24, 1, 1, 3), (2**64 - 2, 1 << 22, 1 << 16, 5)])
def test_sums_of_hashes(spark, monkeypatch, sent, together, at_a_time, least):
    """Counts too large for the bits beside a hash, shards larger than what is added up at once, batches of one hash."""
    monkeypatch.setattr(phrases, "SENT", np.uint64(sent))
    monkeypatch.setattr(phrases, "TOGETHER", together)
    monkeypatch.setattr(phrases, "SUMS_AT_A_TIME", at_a_time)
    docs = [(t, (None, "en")[i % 2]) for i, t in enumerate(prose(2, 60))]
    got = phrases.mine_phrases(spark.createDataFrame(docs, "text string, lang string").repartition(2), least=least, shard_words=60).collect()
    assert sorted(map(tuple, got)) == sorted(mined(docs, least))


def test_shards_of_many_languages(spark):
    """A task keeps a bounded number of words, whatever the number of languages; texts without words take nothing."""
    docs = [(f"a b c d e {i % 3} a b c d", f"l{i % 100}") for i in range(400)] + [(t, "none") for t in (None, "", " \t ")] * 50
    frame = spark.createDataFrame(docs, "text string, lang string").coalesce(1)
    made = phrases.build_indexes(frame, shard_words=100).select("lang", "n", F.length("before").alias("b")).collect()
    assert len(made) > 101
    assert all(r.b <= 4 * (100 + 100 + 2) for r in made)
    assert Counter(r.lang for r in made if r.lang == "none") == {"none": 1} and max(r.b for r in made if r.lang == "none") == 4
    assert sum(r.n for r in made) == 4000
    got = phrases.mine_phrases(frame, least=3, shard_words=100).collect()
    assert sorted(map(tuple, got)) == sorted(mined(docs, 3))


def test_extensions_in_parts(monkeypatch):
    r = random.Random(3)
    row = np.array([0, *(r.choice([0, 1, 1, 2, 3, 4]) for _ in range(3000)), 0], np.int32)
    index = phrases.Index.of("en", [b".", b"a", b"b", b"c", b"d"], row)
    found = [index.single()]
    found += [index.longer(found[0])]
    whole = [index.sides[0].extend(p.left, p.size, p.right) for p in found]
    monkeypatch.setattr(phrases, "PLACES", 40)
    for p, want in zip(found, whole):
        for a, b in zip(index.sides[0].extend(p.left, p.size, p.right), want):
            assert a.tolist() == b.tolist()


@pytest.mark.parametrize("most", [1, 5, 2**40, 2**62])
def test_stable_order(most):
    for n in (0, 1, 2, 1000):
        key = np.random.default_rng(n).integers(0, most, n) // max(most // 50, 1) * max(most // 50, 1)
        assert phrases.stable_order(key).tolist() == np.argsort(key, kind="stable").tolist()


@pytest.mark.parametrize("name", ["op11_lexical", "op13_phrases"])
def test_queries_by_counting(spark, name):
    connection = compare.connect(SF_DIR)
    docs = connection.execute("SELECT doc_id, text, lang FROM documents").fetchall()
    got = sorted(map(tuple, QUERIES[name](spark, SF_DIR).collect()), key=str)
    if name == "op11_lexical":
        items = connection.execute("SELECT item_id, text FROM benchmark").fetchall()
        assert got == ranked([r[:2] for r in docs], items, 50)
    else:
        assert got == sorted(mined([r[1:] for r in docs], 30), key=str)
