"""First-of-group and top-n-of-group.

The ``row_number() <= n`` form lets Spark keep n rows per key in each input
partition before it shuffles, so a key that holds a large share of the rows
reaches its reducer as at most n rows per input partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n(df: DataFrame, keys: list[str | Column], order: list[str | Column], n: int) -> DataFrame:
    """The first n rows of each key in the given order."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter(F.col("_rank") <= n).drop("_rank")


def first_n_salted(df: DataFrame, keys: list[str | Column], order: list[str | Column], n: int, salts: int = 64) -> DataFrame:
    """The same for a few keys with very many rows: first within salted parts of
    each key, so that no task gets n rows of a key from every input partition."""
    salt = F.pmod(F.xxhash64(*order), F.lit(salts))
    return first_n(first_n(df, [*keys, salt], order, n), keys, order, n)


def keep_first(df: DataFrame, keys: list[str | Column], order: list[str | Column]) -> DataFrame:
    """One row per key: the first in the given order."""
    return first_n(df, keys, order, 1)


def keep_first_by_url(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """One article per URL. NULL and empty URLs together count as one URL."""
    return keep_first(df, [F.coalesce(F.col("url"), F.lit(""))], order)


def sample_files(
    df: DataFrame, file: str, pos: str, files: int = 2, per_file: int = 10, total: int = 20
) -> DataFrame:
    """The first rows of the first few files: a bounded sample for display.

    The chosen file names (at most ``files`` rows) are broadcast, so only their
    rows reach the ranking. ``df`` is read twice: stage it where it is costly to compute.
    """
    chosen = df.select(file).distinct().orderBy(file).limit(files)
    rows = df.join(F.broadcast(chosen), file, "left_semi")
    return first_n(rows, [file], [pos], per_file).orderBy(file, pos).limit(total)
