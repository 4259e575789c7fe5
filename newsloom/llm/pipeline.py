"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame.

All but the last return the columns of ``documents``; ``n_chars`` follows the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsloom.llm import bpe, decontaminate, jaccard, language, secrets
from newsloom.llm.common import table
from newsloom.llm.queries import tokenizer


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("bigint")) if "n_chars" in docs.columns else docs


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told, by profiles of all rows with a language.

    Those without text or letters go, and those of which no n-gram is in any profile (score 0).
    Where no row has a language there are no profiles to judge by, and every document stays.
    """
    profiles = language.learn_profiles(docs)
    if not profiles:
        return docs
    rows = docs.select(F.struct("*").alias("row"), "text")
    judged = language.predict_language(rows, profiles)
    return judged.filter((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") > 0)).select("row.*")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked as near duplicates, the one with the smallest id; see ``jaccard.one_of_each``."""
    return jaccard.one_of_each(docs, words=5, percent=80)


def remove_benchmarks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a document that is mostly benchmark goes."""
    items = decontaminate.load_items(table(spark, sf_dir, "benchmark"))
    return _recounted(decontaminate.remove_contamination(docs, items))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; every document stays."""
    return _recounted(secrets.redact(docs))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, with its id, language and source, and the digest of the text that they decode to."""
    encoded = bpe.encode_and_decode(docs, tokenizer())
    size = F.size("ids").cast("bigint").alias("n_tokens")
    return encoded.select("doc_id", "lang", "source", size, "ids", "decoded_sha256")
