"""Gap-free 1-based numbering of a whole table without one big task.

The rows are written once as they come, unless a table holds them already. Only the columns that order them are sorted by ranges
and written with their place in their range, so neither the sampling that a range sort begins with
nor the sort itself computes a row again. The rows per range are counted, and the running sum
over ranges, of which there are as many as tasks and not as many as files or rows, gives
what each range starts at. The numbers then join their rows, one to one.
"""

from __future__ import annotations

from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.settings import staged


def number_rows(df: DataFrame, *order: str, out: str = "sequence", stored: bool = False) -> DataFrame:
    """Add ``out``: the 1-based rank of each row in the given order, which must be total; nulls come first.
    ``stored``: the rows are read from a table that stays, and are not written once more."""
    rows = df if stored else staged(df, "unnumbered")
    # The low 33 bits of a row id count the rows of a task.
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    keys = rows.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)])
    ranges = keys.repartitionByRange(*keys.columns).sortWithinPartitions(*keys.columns)
    numbered = staged(ranges.withColumns({"_range": F.spark_partition_id(), "_place": place}), "numbered")
    sizes = sorted(numbered.groupBy("_range").agg(F.count(F.lit(1)).alias("n")).collect())
    starts = list(accumulate([s.n for s in sizes], initial=0))
    table = df.sparkSession.createDataFrame(
        [(s["_range"], start) for s, start in zip(sizes, starts)], "_range int, _start bigint"
    )
    # A row per task of the sort: bounded by the number of partitions.
    numbers = numbered.join(F.broadcast(table), "_range").withColumn(out, F.col("_start") + F.col("_place") + 1)
    numbers = numbers.drop("_range", "_place", "_start")
    same = [rows[c].eqNullSafe(numbers[f"_{i}"]) for i, c in enumerate(order)]
    return rows.join(numbers, reduce(Column.__and__, same)).drop(*keys.columns)
