"""A corpus pipeline: each stage takes what the one before it kept.

``run`` applies the stages to ``documents``; every stage is written as Parquet in the
shared folder and read again, so a lost executor costs retries of one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from newsloom.llm import pipeline
from newsloom.llm.common import table
from newsloom.settings import staged

STAGES = [
    ("language", pipeline.keep_known_languages),
    ("near_duplicates", pipeline.keep_one_of_each_group),
    ("decontamination", pipeline.remove_benchmarks),
    ("secrets", pipeline.redact_secrets),
    ("tokens", pipeline.encode),
]

# Language profiles and byte-pair encoding are beyond SQL; tests compare with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
