"""The registered queries of the corpus operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import (
    bpe,
    decontaminate,
    histogram_sort,
    jaccard,
    language,
    lexical,
    licenses,
    phrases,
    quality,
    secrets,
    substring_dedup,
    topk,
    warc,
)
from newsloom.llm.common import table, text_or_empty
from newsloom.settings import fresh_folder, staged

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_substrings(spark, sf):
    return substring_dedup.remove_repeated(table(spark, sf, "documents")).drop("text", "kept")


@query
def op2_jaccard(spark, sf):
    return jaccard.near_duplicates(table(spark, sf, "documents"))


@query
def op3_warc(spark, sf):
    folder = fresh_folder(spark, "warc")
    warc.write_archives(table(spark, sf, "pages"), folder)
    records = warc.read_archives(spark, folder)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op4_secrets(spark, sf):
    return secrets.scan_secrets(table(spark, sf, "documents").select("doc_id", "text")).drop("text")


@query
def op5_licenses(spark, sf):
    return licenses.find_licenses(table(spark, sf, "documents"), licenses.known_licenses(spark))


@query
def op6_topk(spark, sf):
    vectors = table(spark, sf, "embeddings").select("vec_id", topk.quantized(F.col("embedding")).alias("vec"))
    return topk.nearest(vectors, F.col("vec_id") % 50 == 0).withColumn("rank", F.col("rank").cast("int"))


@query
def op7_decontamination(spark, sf):
    items = decontaminate.load_items(table(spark, sf, "benchmark"))
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontaminate.find_contamination(docs, items).drop("text", "hit_runs")
    return decontaminate.with_digest(found).drop("items")


@query
def op8_language(spark, sf):
    docs = table(spark, sf, "documents").withColumn("held_out", language.held_out())
    profiles = language.learn_profiles(docs.filter(~F.col("held_out")))
    return language.predict_language(docs.select("doc_id", "held_out", "text"), profiles).drop("text")


@query
def op9_bpe(spark, sf):
    return bpe.token_digests(table(spark, sf, "documents").select("doc_id", "text"), tokenizer()).drop("text")


@query
def op10_sharding(spark, sf):
    text = text_or_empty()
    docs = table(spark, sf, "documents").select(
        "doc_id",
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        histogram_sort.sort_key(F.col("text"), F.col("doc_id")).alias("key"),
    )
    placed = histogram_sort.histogram_shards(staged(docs, "shard-rows"), F.col("key"), F.col("size"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query
def op11_lexical(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    return lexical.search(docs, table(spark, sf, "benchmark"))


@query
def op12_quality(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", quality.held_out().alias("held_out"))
    rows = staged(quality.with_statistics(docs), "statistics")
    labels = table(spark, sf, "labels").filter(~quality.held_out())
    return quality.predict_quality(rows, quality.learn_quality(rows, labels))


@query
def op13_phrases(spark, sf):
    return phrases.mine_phrases(table(spark, sf, "documents"))
