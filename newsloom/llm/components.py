"""Connected components by large and small stars, on DataFrames only.

Every round rewrites the edges so that each points to a smaller node; the edges of a
round are a written table, so a lost executor costs retries of one round. Nodes with very
many edges are only ever a key of a sum or of a join that can be split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.settings import release, staged


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step on edges (u, v) with u > v. Large: all larger neighbours of a node move
    to its smallest neighbour. Small: its smaller neighbours and the node itself do."""
    if large:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    joined = both.join(least, "u")
    if large:
        moved = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v"))
        )
    return moved.filter("u <> v").distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())


def connected(edges: DataFrame) -> DataFrame:
    """``node``, ``component`` (its smallest node) for every node that has an edge ``a`` - ``b``."""
    now = staged(
        edges.filter("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(),
        "edges",
    )
    mark = _mark(now)
    while True:
        last, now = now, staged(_star(_star(now, True), False), "edges")
        release(last)
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
