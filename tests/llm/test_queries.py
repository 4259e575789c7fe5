"""Every registered corpus query on the smallest tables, and the pipeline."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from newsloom.llm.oracles import ORACLES
from newsloom.llm.queries import QUERIES, tokenizer
from tests import compare
from tests.llm import plain

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rows(spark):
    table = spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()
    return [(r.doc_id, r.text) for r in table], {r.doc_id: r for r in table}


def result(spark, name, *columns):
    got = QUERIES[name](spark, SF_DIR).select("doc_id", *columns).collect()
    return {r[0]: tuple(r[1:]) for r in got}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, name):
    connection = compare.connect(SF_DIR)
    assert compare.difference(spark, connection, QUERIES[name], ORACLES[name], SF_DIR) == ""


def test_substrings(spark, rows):
    got = result(spark, "op1_substrings", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == plain.substrings(rows[0])


def test_secrets(spark, rows):
    got = result(spark, "op4_secrets", "n_assign", "n_access", "n_hex", "base_sha256")
    assert got == {d: (*plain.base_secrets(t)[0], plain.base_secrets(t)[1]) for d, t in rows[0]}


def test_language(spark, rows):
    got = result(spark, "op8_language", "held_out", "lang_pred", "score")
    want = plain.languages([(d, t, rows[1][d].lang) for d, t in rows[0]])
    assert {d: g[:2] for d, g in got.items()} == {d: w[:2] for d, w in want.items()}
    assert all(got[d][2] == pytest.approx(want[d][2]) for d in want)
    held = [d for d, g in got.items() if g[0]]
    assert sum(got[d][1] == rows[1][d].lang for d in held) > 0.97 * len(held)


def test_encoding(spark, rows):
    import numpy as np
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokenizer())
    library.no_truncation()
    library.no_padding()
    got = result(spark, "op9_bpe", "n_tokens", "ids_sha256", "decoded_sha256")
    for d, t in rows[0]:
        ids = library.encode(t, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False).encode()
        assert got[d] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), plain.sha(decoded))


def test_sharding(spark, rows):
    got = QUERIES["op10_sharding"](spark, SF_DIR).collect()
    assert {r.doc_id: r.size for r in got} == {d: len(t.encode()) + 1 for d, t in rows[0]}
    for shard in range(8):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}


def test_pipeline(spark, rows):
    """The stages one after the other in plain Python give the same documents and tokens."""
    from tokenizers import Tokenizer

    from newsloom.llm import decontaminate, secrets

    kept = [(d, t) for d, t in rows[0] if plain.grams(t)]
    groups = plain.near_duplicates(kept, 5, 80)
    kept = [(d, t) for d, t in kept if groups[d][1] == d]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    facts = plain.contamination(kept, items)
    find, library, want = secrets.finder(), Tokenizer.from_file(tokenizer()), {}
    library.no_truncation()
    library.no_padding()
    automaton = decontaminate.Automaton(items)
    for d, t in kept:
        n, hit, *_ = facts[d]
        if hit > 0.5 * n:
            continue
        data, places, parts, at = t.encode(), [m.span() for m in plain.WORD.finditer(t.encode().lower())], [], 0
        for first, end in automaton.scan(decontaminate.words_of(t))[0]:
            parts.append(data[at : places[first][0]])
            at = places[end - 1][1]
        t = b"".join([*parts, data[at:]]).decode()
        for start, _, end in reversed(find(t)):
            t = t[:start] + "\0" * (end - start) + t[end:]
        while "\0" in t:
            start = t.index("\0")
            end = start + len(t[start:]) - len(t[start:].lstrip("\0"))
            t = t[:start] + "[secret]" + t[end:]
        want[d] = library.encode(t, add_special_tokens=False).ids
    got = {r.doc_id: r.ids for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert got.keys() == want.keys()
    assert got == want


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None


def test_language_stage(spark):
    from newsloom.llm.pipeline import keep_known_languages

    rows = [(i, "the cat sat on the mat", "en") for i in range(10)]
    rows += [(10, "кошка сидела", None), (11, None, "en"), (12, "12 34", None), (13, "a hat", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    assert {r.doc_id for r in keep_known_languages(spark, docs, "").collect()} == {*range(10), 13}
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert keep_known_languages(spark, unlabelled, "").count() == len(rows)
    held = [i for i in range(100) if zlib.crc32(str(i).encode()) % 3 == 1][:1]
    only = spark.createDataFrame([(i, "il gatto dorme", "it") for i in held], docs.schema)
    assert keep_known_languages(spark, only, "").count() == 1
    both = docs.filter("doc_id < 10").union(spark.createDataFrame([(held[0], "кошка сидела", "ru")], docs.schema))
    assert keep_known_languages(spark, both, "").filter("lang = 'ru'").count() == 1
