"""Putting one-row frames side by side."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def one_row(*parts: DataFrame) -> DataFrame:
    """One row with the columns of all parts, each a frame of at most one row.

    A union and one aggregation, so no join without a key is needed.
    """
    together = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return together.agg(*[F.first(c, ignorenulls=True).alias(c) for c in together.columns])
