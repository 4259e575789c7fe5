"""Helpers of the corpus operators: reading, adding columns by Arrow batches, bounded lookups."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager, contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

Maker = Callable[[], Callable[[pa.RecordBatch], dict[str, list]]]
Batches = Iterator[pa.RecordBatch]

# Bytes of a batch that are worked through at a time.
SLICE = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def slices(batch: pa.RecordBatch, size: int = SLICE) -> Batches:
    """A batch in parts of about ``size`` bytes, so that memory follows neither the rows of a
    batch nor their length, but the longest row."""
    rows = max(1, batch.num_rows * size // max(batch.nbytes, 1))
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Jobs that are run within have these settings; afterwards they are as before."""
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def rows_per_batch(spark: SparkSession, rows: int) -> AbstractContextManager[None]:
    """Jobs that are run within hand at most so many rows at a time to Python: rows may be large."""
    return session_settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(rows)})


def give_back() -> None:
    """Return freed memory to the system. Workers are used again for other tasks and would keep it."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        return  # another C library


def tidy(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` as a task that gives its memory back at its end."""

    def task(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            give_back()

    return task


def add_columns(df: DataFrame, fields: str, maker: Maker) -> DataFrame:
    """``df`` with columns computed per Arrow batch, without a shuffle.

    ``maker`` runs once per task and returns the function that maps a batch to
    a list per new column. A column of ``df`` with the name of a new one is replaced.
    """
    new = T.StructType.fromDDL(fields)
    kept = [f for f in df.schema.fields if f.name not in new.names]
    arrow = to_arrow_schema(new)
    names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = maker()
        for batch in batches:
            for part in slices(batch):
                made = compute(part)
                columns = [part.column(part.schema.get_field_index(n)) for n in names]
                columns += [pa.array(made[f.name], type=f.type) for f in arrow]
                yield pa.RecordBatch.from_arrays(columns, names=[*names, *new.names])

    return df.mapInArrow(tidy(run), T.StructType([*kept, *new.fields]))


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores behind it, so that no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
