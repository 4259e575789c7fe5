"""Ranked lexical search by the Best Position Algorithm.

Documents are read once for each block of items: how often the terms of the items occur in
each goes to a written table, with its number of terms. Weights need counts over all documents,
so they come second. Then tasks take that table in blocks of postings; a block has one list
per term, sorted by impact. A search reads the lists side by side. Each document met is looked up
in all lists (direct access), which marks its position there too. The best position of a
list is the last up to which every position has been marked, however it came about; no document
that was not met can have more than the impacts at the best positions together. The search ends when that is
strictly below the k-th score, so equal scores are all met and ties are settled by id.

Every task returns the best k of its documents per item; they meet in two steps.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from newsloom.llm.common import tidy
from newsloom.settings import staged

K = 50
# Items are searched in blocks of so many bytes of text; their terms and the weights go to every task.
ITEM_BYTES = 4 << 20
# Postings in memory at a time, and bytes of a text that are cut into terms at a time.
POSTINGS, PIECE = 1 << 20, 1 << 20
# Positions read from each list at first; later rounds read half as many as were read before, at least so many.
STEP = 64
# Parts in which the best of the tasks meet first.
PARTS = 64

# ASCII letters become small, all other ASCII but digits a blank; bytes beyond ASCII are parts of terms.
_SHOWN = bytes(
    c if c >= 0x80 or chr(c).isdigit() or 0x61 <= c <= 0x7A else c + 32 if 0x41 <= c <= 0x5A else 0x20 for c in range(256)
)


def term_counts(text: bytes) -> Counter:
    """How often each term occurs; a long text is worked through in pieces that end between terms."""
    shown = text.translate(_SHOWN)
    if len(shown) <= PIECE:
        return Counter(shown.split())
    counts: Counter = Counter()
    start = 0
    while start < len(shown):
        end = shown.find(b" ", start + PIECE)
        end = len(shown) if end < 0 else end
        counts.update(shown[start:end].split())
        start = end
    return counts


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def _item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple]]:
    """Items as (id, distinct terms), a block at a time; the driver holds one block only."""
    block, size = [], 0
    for row in items.select(F.col(item_id).alias("i"), F.col(text).cast("binary").alias("t")).toLocalIterator():
        data = bytes(row.t or b"")
        if block and size + len(data) > ITEM_BYTES:
            yield block
            block, size = [], 0
        block.append((row.i, list(term_counts(data))))
        size += len(data)
    if block:
        yield block


def _id_type(df: DataFrame, name: str) -> str:
    return df.schema[name].dataType.simpleString()


def count_postings(df: DataFrame, terms: dict[bytes, int], doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n`` (terms with repeats), ``terms`` (numbers of those in ``terms``) and ``tfs``
    of every document with a term."""
    schema = T.StructType.fromDDL(f"doc_id {_id_type(df, doc_id)}, n bigint, terms array<int>, tfs array<int>")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, sizes, ends, found, tfs = [], [], [0], [], []
            for i, value in enumerate(batch.column(1)):
                counts = term_counts(value.as_py() or b"")
                if not counts:
                    continue
                rows.append(i)
                sizes.append(counts.total())
                for term in counts.keys() & terms.keys():
                    found.append(terms[term])
                    tfs.append(counts[term])
                ends.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (found, tfs)]
            columns = [batch.column(0).take(pa.array(rows, pa.int64())), pa.array(sizes, pa.int64()), *lists]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(columns, arrow)], names=arrow.names)

    return df.select(F.col(doc_id), F.col(text).cast("binary")).mapInArrow(tidy(run), schema)


class Block:
    """Impact lists of some documents, which are numbered in the order of their ids."""

    def __init__(self, sizes: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray, weights: np.ndarray, mean: tuple[int, int]):
        n_docs, length = mean
        self.ends, self.terms = ends, terms
        doc = np.repeat(np.arange(len(sizes)), np.diff(ends))
        share = 50 + (50 * sizes * n_docs) // length
        tf = tfs.astype(np.int64)
        self.impact = weights[terms] * ((1_000_000_000 * tf) // (1000 * tf + 20 * share[doc]))
        order = np.lexsort((doc, -self.impact, terms))
        bounds = np.searchsorted(terms[order], np.arange(len(weights) + 1))
        self.starts, self.lengths = bounds[:-1], np.diff(bounds)
        self.listed, self.listed_impact = doc[order], self.impact[order]
        # Where in its list each posting of a document stands.
        self.position = np.empty(len(order), np.int64)
        self.position[order] = np.arange(len(order)) - self.starts[terms[order]]
        self.slot = np.full(len(weights), -1)

    def search(self, item: list[int], k: int, floor: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Documents met and their scores, among them all of the best ``k``. ``floor``: the k-th score so
        far of other documents. The number of documents met is what the search evaluated."""
        own = [t for t in item if self.lengths[t]]
        if not own:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        starts, lengths = self.starts[own], self.lengths[own]
        self.slot[own] = np.arange(len(own))
        offsets = np.concatenate([[0], np.cumsum(lengths)])
        marked = np.zeros(offsets[-1], bool)
        best = np.zeros(len(own), np.int64)
        known = np.zeros(len(self.ends) - 1, bool)
        docs, scores = [], []
        read, step = 0, STEP
        while True:
            heads = [self.listed[s + read : s + min(read + step, n)] for s, n in zip(starts, lengths) if read < n]
            met = np.unique(np.concatenate(heads))
            met = met[~known[met]]
            known[met] = True
            # Direct access: every posting of the documents met, in whatever list of the item it is.
            first, many = self.ends[met], self.ends[met + 1] - self.ends[met]
            row = np.repeat(np.arange(len(met)), many)
            at = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many) + first[row]
            slots = self.slot[self.terms[at]]
            row, at, slots = row[slots >= 0], at[slots >= 0], slots[slots >= 0]
            score = np.zeros(len(met), np.int64)
            np.add.at(score, row, self.impact[at])
            marked[offsets[slots] + self.position[at]] = True
            docs.append(met)
            scores.append(score)
            for i in range(len(own)):
                rest = marked[offsets[i] + best[i] : offsets[i + 1]]
                gap = int(rest.argmin()) if len(rest) else 0
                best[i] += len(rest) if len(rest) and rest[gap] else gap
            open_ = best < lengths
            unseen = int(self.listed_impact[starts[open_] + best[open_] - 1].sum())
            together = np.concatenate(scores)
            kth = int(np.partition(together, len(together) - k)[len(together) - k]) if len(together) >= k else 0
            read += step
            step = max(step, read // 2)
            if unseen < max(kth, floor) or unseen == 0 or read >= lengths.max():
                self.slot[own] = -1
                return np.concatenate(docs), together


class Best:
    """The best ``k`` (score, id) of an item so far."""

    def __init__(self, k: int):
        self.k, self.rows = k, []

    def add(self, rows: list[tuple]) -> None:
        both = self.rows + rows
        both.sort(key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))
        self.rows = both[: self.k]

    @property
    def floor(self) -> int:
        return self.rows[-1][0] if len(self.rows) >= self.k else 0


def _by_id(ids: list) -> np.ndarray:
    return np.array(sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] if ids[i] is not None else 0)), np.int64)


def search_postings(postings: DataFrame, items: list[list[int]], weights: np.ndarray, mean: tuple[int, int], k: int) -> DataFrame:
    """``pos`` (the item's), ``doc_id``, ``score``: the best ``k`` of each task for each item."""
    schema = T.StructType.fromDDL(f"pos int, doc_id {_id_type(postings, 'doc_id')}, score bigint")
    arrow = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = [Best(k) for _ in items]
        held, many = [], 0

        def work() -> None:
            table = pa.Table.from_batches(held).combine_chunks()
            ids = table.column("doc_id").to_pylist()
            order = _by_id(ids)
            table = table.take(pa.array(order))
            terms = table.column("terms").combine_chunks()
            block = Block(
                table.column("n").to_numpy(),
                np.concatenate([[0], np.cumsum(terms.value_lengths().to_numpy(zero_copy_only=False))]),
                terms.flatten().to_numpy(zero_copy_only=False),
                table.column("tfs").combine_chunks().flatten().to_numpy(zero_copy_only=False),
                weights,
                mean,
            )
            for item, kept in zip(items, best):
                docs, scores = block.search(item, k, kept.floor)
                order_ = np.lexsort((docs, -scores))[:k]
                kept.add([(int(s), ids[order[d]]) for d, s in zip(docs[order_], scores[order_]) if s > 0])

        for batch in batches:
            # A batch may hold more than a block; it is cut between documents.
            lengths = batch.column("terms").value_lengths().to_numpy(zero_copy_only=False)
            ends, start = np.cumsum(lengths), 0
            while start < batch.num_rows:
                base = ends[start - 1] if start else 0
                stop = max(start + 1, int(np.searchsorted(ends, base + POSTINGS - many, "right")))
                held.append(batch.slice(start, stop - start))
                many += int(ends[stop - 1] - base)
                start = stop
                if many >= POSTINGS or start < batch.num_rows:
                    work()
                    held, many = [], 0
        if held:
            work()
        rows = [(pos, doc, score) for pos, kept in enumerate(best) for score, doc in kept.rows]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)], names=arrow.names)

    # Documents without a term of any item cannot be found, so they are left behind here.
    return postings.filter(F.size("terms") > 0).mapInArrow(tidy(run), schema)


def _best_rows(df: DataFrame, key: list[str], k: int) -> DataFrame:
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = K, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``item_id``, ``rank`` (from 1), ``doc_id``, ``score``: the ``k`` best documents of each item.

    Equal scores go by ascending id, a null id last. Null and empty texts have no terms: such documents
    count nowhere, such items have no rows. Rows that repeat an id are documents, or items, of their
    own. Other columns take no part. No documents or no items give no rows.
    """
    spark = docs.sparkSession
    schema = f"item_id {_id_type(items, item_id)}, rank int, doc_id {_id_type(docs, doc_id)}, score bigint"
    results = []
    for block in _item_blocks(items, item_id, item_text):
        numbers = count()
        terms: dict[bytes, int] = {}
        own = [[terms[t] if t in terms else terms.setdefault(t, next(numbers)) for t in words] for _, words in block]
        postings = staged(count_postings(docs, terms, doc_id, text), "postings")
        n_docs, length = postings.agg(F.count(F.lit(1)), F.sum("n")).first()
        if not n_docs or not terms:
            continue
        weights = np.full(len(terms), weight(n_docs, 0), np.int64)
        for row in postings.select(F.explode("terms").alias("t")).groupBy("t").count().collect():
            weights[row.t] = weight(n_docs, row["count"])
        found = search_postings(postings, own, weights, (n_docs, length), k)
        found = _best_rows(found.withColumn("part", F.spark_partition_id() % PARTS), ["pos", "part"], k)
        found = _best_rows(found.drop("rank", "part"), ["pos"], k)
        names = spark.createDataFrame([(i, x[0]) for i, x in enumerate(block)], f"pos int, item_id {_id_type(items, item_id)}")
        found = found.join(F.broadcast(names), "pos").select("item_id", "rank", "doc_id", "score")
        results.append(found)
    if not results:
        return spark.createDataFrame([], schema)
    if len(results) > 1:
        results = [staged(r, "found") for r in results]
    both = results[0]
    for r in results[1:]:
        both = both.unionByName(r)
    return both
