"""Sharding by histogram sort, with DataFrame functions only.

Rows are ordered by a key of fixed length. Exact bytes and rows are counted
between candidate boundaries over all partitions; cells that still hold too much,
or that straddle a shard boundary by more than the tolerance, are probed at finer
boundaries, until none is left. Then rows move once, to the place they are counted for.

What reaches the driver are counts per cell, never rows. Their number is bounded:
``16 ** FIRST`` cells at first, and each round splits at most ``PARTS + shards`` of
them into ``16 ** NEXT``, as at most ``PARTS`` cells can hold a ``PARTS``-th of the rows.
"""

from __future__ import annotations

from bisect import bisect_right
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Hex digits of the key that the first probes and each refinement tell apart.
FIRST, NEXT = 3, 2
# A cell is one sorting unit: it should hold no more than this part of all rows.
PARTS = 1024


def sort_key(group: Column, row: Column) -> Column:
    """Key of 32 hex digits: rows of equal ``group`` are neighbours, ordered by ``row``.

    Both are hashed, so the first digits spread evenly whatever the values are.
    A null is a value of its own.
    """
    return F.concat(*(F.lpad(F.lower(F.hex(F.xxhash64(c))), 16, "0") for c in (group, row)))


def _common(a: str, b: str) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=True)) if x != y), len(a))


def _count(cells: DataFrame) -> dict[str, tuple]:
    counted = cells.groupBy("_cell").agg(
        F.sum("_size").alias("size"), F.count(F.lit(1)).alias("n"), F.min("_key").alias("lo"), F.max("_key").alias("hi")
    )
    return {r["_cell"]: (r["size"], r["n"], r.lo, r.hi) for r in counted.collect()}


def _wide(cells: dict[str, tuple], shards: int, tolerance: float) -> dict[str, int]:
    """Cells to be probed further, with the length of their new boundaries."""
    size, n = sum(c[0] for c in cells.values()), sum(c[1] for c in cells.values())
    allowed, found, before = tolerance * size / shards, {}, 0
    for prefix in sorted(cells):
        own, rows, lo, hi = cells[prefix]
        # Distance from the nearest edge of the cell to each boundary within it.
        first = before * shards // size + 1 if size else shards
        end = ((before + own) * shards - 1) // size + 1 if size else shards
        astray = any(
            min(t * size / shards - before, before + own - t * size / shards) > allowed
            for t in range(first, min(end, shards))
        )
        if lo != hi and (astray or rows * PARTS > n + PARTS):
            found[prefix] = _common(lo, hi) + NEXT
        before += own
    return found


def cut(sizes: list[int], shards: int) -> list[int]:
    """Shard of each cell: a boundary goes to the cell edge nearest to its target."""
    ends, total, at, out = list(accumulate(sizes)), sum(sizes), 0, []
    edges = [0, *ends]
    for t in range(1, shards):
        goal = t * total / shards
        while at < len(ends) and abs(edges[at + 1] - goal) <= abs(edges[at] - goal):
            at += 1
        out.append(at)
    return [bisect_right(out, i) for i in range(len(sizes))]


class Histogram:
    """Cells of keys with exact counts, and the shard each belongs to."""

    def __init__(self, rows: DataFrame, key: Column, size: Column, shards: int, tolerance: float):
        self.spark = rows.sparkSession
        self.rounds: list[dict[str, int]] = []
        narrow = rows.select(key.alias("_key"), size.cast("bigint").alias("_size"))
        located = narrow.withColumn("_cell", F.substring("_key", 1, FIRST))
        cells = _count(located)
        while wide := _wide(cells, shards, tolerance):
            self.rounds.append(wide)
            own = located.join(self._probes(wide), "_cell")
            cells = {k: v for k, v in cells.items() if k not in wide} | _count(own.withColumn("_cell", self._finer()))
            located = self._refine(located, wide)
        order = sorted(cells)
        self.places, filled = [], {}
        for cell, shard in zip(order, cut([cells[c][0] for c in order], shards), strict=True):
            self.places.append((cell, shard, filled.get(shard, 0)))
            filled[shard] = filled.get(shard, 0) + cells[cell][1]

    def _probes(self, wide: dict[str, int]) -> DataFrame:
        return F.broadcast(self.spark.createDataFrame(list(wide.items()), "_cell string, _length int"))

    @staticmethod
    def _finer() -> Column:
        return F.expr("substring(_key, 1, _length)")

    def _refine(self, located: DataFrame, wide: dict[str, int]) -> DataFrame:
        found = located.join(self._probes(wide), "_cell", "left")
        return found.withColumn("_cell", F.coalesce(self._finer(), "_cell")).drop("_length")

    def place(self, df: DataFrame, key: Column) -> DataFrame:
        """Rows with the same keys get ``_key``, ``_cell``, ``shard`` and ``_before``, the
        rows of the shard in earlier cells. No shuffle: the tables looked up are bounded."""
        located = df.drop("shard").withColumn("_key", key).withColumn("_cell", F.substring("_key", 1, FIRST))
        for wide in self.rounds:
            located = self._refine(located, wide)
        places = self.spark.createDataFrame(self.places, "_cell string, shard int, _before bigint")
        return located.join(F.broadcast(places), "_cell")


def histogram_shards(df: DataFrame, key: Column, size: Column, shards: int = 8, tolerance: float = 0.001) -> DataFrame:
    """``df`` with ``shard`` (0 to ``shards`` - 1) and ``slot`` (its place there, from 0).

    ``key``: string of fixed length, as from ``sort_key``; ``size``: positive integer.
    Each shard is a range of keys; its size differs from an equal part by at most
    ``tolerance`` of it per boundary, or by one row where rows are larger. Rows of
    equal keys are ties: they stay together and their slots are in no particular order.
    Rows of one group stay together unless the group straddles a boundary by more
    than the tolerance. An empty table gives no rows. Columns of ``df`` named
    ``shard`` or ``slot`` are replaced, all others kept. ``df`` is read once per round of probes
    (two or three), so stage it where it is costly to compute.
    """
    # Rows travel as one struct, so that no column of theirs meets a name used here.
    rows = df.select(F.struct("*").alias("row"), key.alias("key"))
    placed = Histogram(df, key, size, shards, tolerance).place(rows, F.col("key"))
    within = F.row_number().over(Window.partitionBy("_cell").orderBy("_key"))
    own = [F.col("row").getField(c).alias(c) for c in df.columns if c.lower() not in ("shard", "slot")]
    return placed.select(*own, "shard", (F.col("_before") + within - 1).alias("slot"))
