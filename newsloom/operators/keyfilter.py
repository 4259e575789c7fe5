"""A filter that drops rows whose key is surely not in another table, before costly work on them.

A bit per hashed key, in buckets that are a column of a small table, so that the rows to
be filtered are not shuffled. Keys that are in the table always pass; about one in sixteen of
the others may pass too, more where the table has more keys than a sixteenth of the most bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Bits of a bucket of Spark's bitmap functions, and of all buckets at most (16 MB).
BUCKET = 1 << 15
MOST = 1 << 27


def _slot(keys: list[str], bits: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(bits)).cast("bigint")


def maybe_in(rows: DataFrame, table: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` without those whose ``keys`` are surely not in ``table``. No shuffle of ``rows``; nulls
    are keys like others. ``table`` is read twice: stage it where it is costly to compute."""
    bits = min(max(BUCKET, 16 * table.count()), MOST)
    # Buckets, and places in them, are counted from 1.
    slot = _slot(keys, bits) + 1
    marked = table.groupBy(F.bitmap_bucket_number(slot).alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("_bits")
    )
    placed = rows.withColumns({"_bucket": F.bitmap_bucket_number(slot), "_place": F.bitmap_bit_position(slot).cast("int")})
    byte = F.conv(F.hex(F.expr("substring(_bits, _place div 8 + 1, 1)")), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.expr("shiftleft(1, _place % 8)")) != 0
    return placed.join(F.broadcast(marked), "_bucket").filter(hit).select(rows.columns)
