"""Exact nearest vectors by inner product, with a table of distances to pivots.

Vectors are lifted onto a sphere: with one more coordinate all candidates have the same
norm, so a larger inner product is a smaller distance. For each candidate the distances to
all pivots are known; by the triangle inequality the largest difference to the query's own
distances bounds its distance from below, and so its score from above. The candidates of the
highest bounds are evaluated, then more of those left whose bound can still reach the worst of
the best scores, until there are none; scores are exact integers.

Queries and candidates meet in blocks: each pair of a query block and a candidate block
is one group, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIVOTS = 32
BLOCK_ROWS, BLOCK_QUERIES = 2048, 2048
# Candidates evaluated before the first look at the bounds, before the second, and before each later one.
STEPS = (64, 512, BLOCK_ROWS)
FOUND = "query_id bigint, vec_id bigint, score bigint"


def quantized(embedding: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null for vectors that are null or hold
    a null, NaN or infinite component."""
    bad = F.exists(embedding, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    whole = F.transform(embedding, lambda x: F.floor(x.cast("double") * float(scale)))
    return F.when(embedding.isNotNull() & ~bad, whole)


class _Search:
    def __init__(self, pivots: np.ndarray, greatest: int, k: int):
        self.pivots, self.greatest, self.k = pivots, float(greatest), k
        self.lift = np.sqrt(np.maximum(self.greatest - (self.pivots.astype(float) ** 2).sum(axis=1), 0))

    def distances(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        """To each pivot, on the sphere; queries have nothing in the added coordinate."""
        own = (vectors.astype(float) ** 2).sum(axis=1)
        inner = vectors.astype(float) @ self.pivots.T.astype(float)
        if query:
            return np.sqrt(np.maximum(own[:, None] + self.greatest - 2 * inner, 0))
        inner += np.sqrt(np.maximum(self.greatest - own, 0))[:, None] * self.lift
        return np.sqrt(np.maximum(2 * self.greatest - 2 * inner, 0))

    def run(self, ids: np.ndarray, vectors: np.ndarray, query_ids: np.ndarray, queries: np.ndarray) -> Iterator[tuple]:
        table = np.ascontiguousarray(self.distances(vectors, False).T)
        own = self.distances(queries, True)
        # Sums below 2**53 are exact in doubles, whose products are many times faster.
        largest = [float(np.abs(x).max(initial=0)) for x in (vectors, queries)]
        if vectors.shape[1] * largest[0] * largest[1] < 2**53:
            vectors, queries = vectors.astype(float), queries.astype(float)
        for q, (query_id, query) in enumerate(zip(query_ids, queries)):
            apart = np.zeros(len(ids))
            for p in range(len(self.pivots)):
                np.maximum(apart, np.abs(table[p] - own[q, p]), out=apart)
            norm = float((query.astype(float) ** 2).sum()) + self.greatest
            # Rounding of the distances must not cut off an equal score.
            bound = (norm - apart**2) / 2 + 1e-9 * norm + 1e-6
            left = np.flatnonzero(ids != query_id)
            best_ids, best = ids[:0], np.zeros(0, np.int64)
            for step in chain(STEPS, repeat(STEPS[-1])):
                if len(best) == self.k:
                    left = left[bound[left] >= best[-1]]
                if not len(left):
                    break
                order = np.argpartition(-bound[left], step) if len(left) > step else np.arange(len(left))
                some, left = left[order[:step]], left[order[step:]]
                # Gathering most of the rows would cost more than their products.
                scores = vectors[some] @ query if 2 * len(some) < len(ids) else (vectors @ query)[some]
                best_ids, best = self.highest(np.append(best_ids, ids[some]), np.append(best, scores.astype(np.int64)))
            yield from ((int(query_id), int(i), int(s)) for i, s in zip(best_ids, best))

    def highest(self, ids: np.ndarray, scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ``k`` highest scores, ties by the smaller id."""
        if len(scores) > self.k:
            reach = scores >= np.partition(scores, -self.k)[-self.k]
            ids, scores = ids[reach], scores[reach]
        order = np.lexsort((ids, -scores))[: self.k]
        return ids[order], scores[order]


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, pivots: int = PIVOTS) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id``, ``score``: the ``k`` highest inner products.

    ``vectors``: ``vec_id`` and ``vec`` (array of bigint, components below 2**26). Rows with a
    null id or vector take no part. Only vectors of one length are compared. The query's own
    row is left out by its id; rows that repeat an id count once, the smallest vector of
    them. Ties go to the smaller id. Fewer candidates than ``k`` give fewer rows.
    """
    rows = vectors.filter(F.col("vec_id").isNotNull() & F.col("vec").isNotNull())
    rows = rows.groupBy("vec_id").agg(F.min("vec").alias("vec")).withColumn("dim", F.size("vec"))
    rows = rows.withColumn("is_query", is_query)
    norm = F.aggregate("vec", F.lit(0).cast("bigint"), lambda s, x: s + x * x)
    facts = rows.groupBy("dim").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("is_query").alias("queries"), F.max(norm).alias("greatest")
    )
    place = F.row_number().over(Window.partitionBy("dim").orderBy(F.xxhash64("vec_id"), "vec_id"))
    chosen = rows.select("dim", "vec", place.alias("place")).filter(F.col("place") <= pivots)
    shapes = {r.dim: r for r in facts.collect()}
    points: dict[int, list] = {}
    for row in chosen.collect():
        points.setdefault(row.dim, []).append(row.vec)
    known = {
        d: (np.array(points[d], np.int64).reshape(len(points[d]), d), r.greatest) for d, r in shapes.items()
    }
    counts = [
        (d, max(1, -(-r.rows // BLOCK_ROWS)), max(1, -(-r.queries // BLOCK_QUERIES))) for d, r in shapes.items()
    ]
    spark = vectors.sparkSession
    blocks = F.broadcast(spark.createDataFrame(counts, "dim int, row_blocks int, query_blocks int"))
    dealt = rows.join(blocks, "dim").withColumn("hash", F.xxhash64("vec_id"))
    block = lambda n: F.pmod("hash", F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    grid = dealt.select(
        "dim", block("row_blocks").alias("rb"), every("query_blocks").alias("qb"), F.lit(False).alias("asks"), "vec_id", "vec"
    ).unionByName(
        dealt.filter("is_query").select(
            "dim", every("row_blocks").alias("rb"), block("query_blocks").alias("qb"), F.lit(True).alias("asks"), "vec_id", "vec"
        )
    )

    def search(group: pa.Table) -> pa.Table:
        dim = group.column("dim")[0].as_py()
        asks = np.array(group.column("asks"))
        ids = np.array(group.column("vec_id"))
        flat = group.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        matrix = flat.astype(np.int64).reshape(len(ids), dim)
        found = list(_Search(*known[dim], k).run(ids[~asks], matrix[~asks], ids[asks], matrix[asks]))
        columns = list(zip(*found)) or [(), (), ()]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["query_id", "vec_id", "score"])

    found = grid.groupBy("dim", "rb", "qb").applyInArrow(search, FOUND)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
