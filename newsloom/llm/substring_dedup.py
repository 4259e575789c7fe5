"""Exact removal of repeated substrings, by suffix sorting with compared hashes.

A string of WIDTH bytes that occurs twice is found without moving all suffixes: of each
window of WIDTH bytes, the GRAM-byte string with the least hash is its anchor. Equal windows
have equal anchors at equal places, and neighbouring windows mostly share one, so a text
becomes a few runs of windows per hundred bytes. Only runs whose anchor occurs again
are compared.

The runs of an anchor meet in one task. There the suffixes from the anchor on, and the
reversed ones before it, are sorted by a mergesort whose comparisons find the common extension
of two suffixes by binary search over prefix polynomial hashes; neighbours in the
order are then compared byte by byte, so a hash collision cannot decide. Two windows are equal
if their parts before and behind the anchor are in common classes of the two orders.

Anchors that occur very often are not gathered: their runs are cut into single windows,
each dealt out by its own content, and equal ones are combined before they move.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import add_columns, sha256, slices, tidy
from newsloom.settings import staged

WIDTH, GRAM = 100, 32
# Bytes of a text that are hashed at a time; longer texts are worked through in pieces.
PIECE = 1 << 18
# An anchor is dealt out window by window above so many runs, or above the part of all
# runs that leaves at most OFTEN_MOST such anchors.
OFTEN, OFTEN_MOST = 4096, 1 << 20
# Contents a task remembers for combining; rows that are sorted together, and that are sent together.
REMEMBERED, TOGETHER, SENT = 1 << 17, 1 << 14, 1 << 13
# Runs that are gathered before they are sent to be counted; rows that are counted together.
GATHERED, COUNTED = 1 << 19, 1 << 17
_BASE = 0x9E3779B97F4A7C15


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _prefix_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix polynomial hashes modulo 2**64, and the inverse powers that move a difference to place 0."""
    size = 1 << max(12, int(len(data)).bit_length())
    if size not in _POWERS:
        _POWERS.clear()
        _POWERS[size] = _powers(_BASE, size), _powers(pow(_BASE, -1, 1 << 64), size)
    powers, inverse = _POWERS[size]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=sums[1:])
    return sums, inverse


def window_runs(data: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """Runs of consecutive windows with one anchor: hash of the anchor, first window,
    number of windows, and place of the anchor in the first window."""
    if len(data) < width:
        return (np.zeros(0, np.int64),) * 4
    sums, inverse = _prefix_hashes(data)
    h = (sums[gram:] - sums[:-gram]) * inverse[: len(data) - gram + 1]
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
    # The low bits hold the place within the window: of equal grams the leftmost is least.
    least = (h ^ (h >> np.uint64(29))) & ~np.uint64(127)
    grams, covered = width - gram + 1, 1
    while covered < grams:
        step = min(covered, grams - covered)
        least = np.minimum(least[:-step], least[step:] + np.uint64(step))
        covered += step
    place = (least & np.uint64(127)).astype(np.int64)
    anchor = np.arange(len(least)) + place
    first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
    count = np.diff(np.r_[first, len(least)])
    return (least[first] >> np.uint64(7)).astype(np.int64), first, count, place[first]


def _runs_of(text: bytes) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(text, np.uint8)
    parts = []
    for at in range(0, max(1, len(data)), PIECE):
        h, first, count, place = window_runs(data[at : at + PIECE + WIDTH - 1])
        parts.append((h, first + at, count, place))
    return tuple(np.concatenate(p) for p in zip(*parts)) if len(parts) > 1 else parts[0]


class Suffixes:
    """Suffixes of bounded length in a buffer, compared by their common extension."""

    def __init__(self, data: np.ndarray, start: np.ndarray, room: np.ndarray):
        self.data, self.start, self.room = data, start, room
        self.sums, self.inverse = _prefix_hashes(data)

    def extension(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of suffixes i and j, by binary search."""
        a, b = self.start[i], self.start[j]
        low, high = np.zeros(len(i), np.int64), np.minimum(self.room[i], self.room[j])
        base_a, base_b = self.sums[a], self.sums[b]
        move_a, move_b = self.inverse[a], self.inverse[b]
        for _ in range(int(high.max(initial=0)).bit_length()):
            middle = (low + high + 1) >> 1
            same = (self.sums[a + middle] - base_a) * move_a == (self.sums[b + middle] - base_b) * move_b
            low = np.where(same, middle, low)
            high = np.where(same, high, middle - 1)
        return low

    def before(self, i: np.ndarray, j: np.ndarray, ties: np.ndarray) -> np.ndarray:
        """Whether suffix i sorts before j; ``ties`` where they are equal."""
        n = self.extension(i, j)
        end_i, end_j = n == self.room[i], n == self.room[j]
        last = len(self.data) - 1
        less = self.data[np.minimum(self.start[i] + n, last)] < self.data[np.minimum(self.start[j] + n, last)]
        return np.where(end_i & end_j, ties, np.where(end_i, True, np.where(end_j, False, less)))

    def sort(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Order of the suffixes within their groups (which are contiguous), and the
        common prefix of each with the one before it; -1 at the start of a group."""
        n = len(group)
        begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        size = np.diff(np.r_[begin, n])
        begin, size = np.repeat(begin, size), np.repeat(size, size)
        order, block = np.arange(n), 1
        while block < size.max(initial=0):
            active = np.flatnonzero(size > block)
            place = active - begin[active]
            right = (place // block) % 2 == 1
            sibling = (place // block + np.where(right, -1, 1)) * block
            top = np.clip(size[active] - sibling, 0, block)
            own = order[active]
            low, high = np.zeros(len(active), np.int64), top.copy()
            for _ in range(block.bit_length()):
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) >> 1
                other = order[begin[active[open_]] + sibling[open_] + middle]
                # Equal suffixes keep the left block first.
                passed = self.before(other, own[open_], right[open_])
                low[open_] = np.where(passed, middle + 1, low[open_])
                high[open_] = np.where(passed, high[open_], middle)
            merged = begin[active] + place - np.where(right, block, 0) + low
            order = order.copy()
            order[merged] = own
            block *= 2
        common = np.full(n, -1, np.int64)
        same = np.flatnonzero(group[1:] == group[:-1]) + 1
        common[same] = self.extension(order[same - 1], order[same])
        if not self._verified(order, common, same):
            return self._plain_sort(group)
        return order, common

    def _verified(self, order: np.ndarray, common: np.ndarray, same: np.ndarray) -> bool:
        n = common[same]
        ends = np.cumsum(n)
        within = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)
        a, b = np.repeat(self.start[order[same - 1]], n), np.repeat(self.start[order[same]], n)
        return bool((self.data[a + within] == self.data[b + within]).all())

    def _plain_sort(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same by comparing bytes, for the case that hashes collide."""
        parts = [self.data[s : s + r].tobytes() for s, r in zip(self.start, self.room)]
        order = np.array(sorted(range(len(group)), key=lambda i: (group[i], parts[i], i)), np.int64)
        common = np.full(len(group), -1, np.int64)
        for k in range(1, len(order)):
            x, y = parts[order[k - 1]], parts[order[k]]
            if group[order[k]] == group[order[k - 1]]:
                common[k] = next((n for n, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        return order, common


def repeated_windows(
    group: np.ndarray, doc: np.ndarray, at: np.ndarray, place: np.ndarray, texts: list[bytes], width: int = WIDTH
) -> tuple[np.ndarray, np.ndarray]:
    """For runs of windows, the first and last window that also starts earlier (-1 if none).

    ``group``: contiguous ids of anchors; ``doc``, ``at``: document and place of the first window;
    ``place``: the anchor's place in it; ``texts``: the bytes of each run.
    """
    lengths = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    base = np.cumsum(lengths) - lengths
    anchor = base + place
    n = len(group)
    classes = []
    for suffixes in (
        Suffixes(data, anchor, lengths - place),
        Suffixes(data[::-1], len(data) - anchor, place),
    ):
        classes.append(suffixes.sort(group))
    count = lengths - width + 1
    where = at + place
    earliest = np.lexsort((where, doc))
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    rank = np.empty((2, n), np.int64)
    for before in range(int(place.max(initial=0)), -1, -1):
        for side, depth in ((0, width - before), (1, before)):
            order, common = classes[side]
            rank[side, order] = np.cumsum(common < depth)
        window = place - before
        taking = earliest[((window >= 0) & (window < count))[earliest]]
        both = rank[0, taking] * (n + 1) + rank[1, taking]
        _, first, inverse = np.unique(both, return_index=True, return_inverse=True)
        source = taking[first[inverse]]
        later = taking[(doc[source] != doc[taking]) | (where[source] != where[taking])]
        low[later] = np.where(low[later] < 0, window[later], low[later])
        high[later] = window[later]
    return low, high


def _whole_keys(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.Table]:
    """Rows sorted by ``key``, at least ``least`` at a time, all rows of a key together."""
    held: list[pa.RecordBatch] = []
    many = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        many += batch.num_rows
        if many < least:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        key = rows.column("key").to_numpy()
        whole = int(np.searchsorted(key, key[-1]))  # rows before the last key, which may go on
        if whole:
            yield rows.slice(0, whole).combine_chunks()
            held = rows.slice(whole).combine_chunks().to_batches()
            many -= whole
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _anchors(docs: DataFrame) -> DataFrame:
    """Runs whose anchor may occur again: ``doc``, ``hash``, ``at``, ``count``, ``place``, ``total``.

    Runs are gathered by GATHERED. Of each anchor, one row carries how many runs there are among
    these; only where that is one does the answer decide. ``total`` is the number of all runs
    of an anchor, on the rows that carry a number, and 0 on others. Rows come to the answer
    sorted, so that it holds few at a time.
    """
    schema = "key bigint, hash bigint, doc bigint, at bigint, count int, place int, n bigint"

    def collect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple] = []
        gathered = 0

        def sent() -> Iterator[pa.RecordBatch]:
            h, doc, first, count, place = (np.concatenate(p) for p in zip(*parts))
            _, sender, times = np.unique(h, return_index=True, return_counts=True)
            n = np.zeros(len(h), np.int64)
            n[sender] = times
            # Rows that need no answer are dealt out evenly.
            key = np.where(n > 0, h, (doc * 1_000_003 + first) * 7_919)
            whole = pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (key, h, doc, first, count.astype(np.int32), place.astype(np.int32), n)],
                names=["key", "hash", "doc", "at", "count", "place", "n"],
            )
            for at in range(0, whole.num_rows, 1 << 16):
                yield whole.slice(at, 1 << 16)

        for part in (p for batch in batches for p in slices(batch)):
            for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                if text is not None and len(text) * 4 >= WIDTH:
                    h, first, count, place = _runs_of(text.encode("utf-8"))
                    parts.append((h, np.full(len(h), doc), first, count.astype(np.int16), place.astype(np.int8)))
                    gathered += len(h)
                    if gathered >= GATHERED:
                        yield from sent()
                        parts, gathered = [], 0
        if parts:
            yield from sent()

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _whole_keys(batches, COUNTED):
            h, n = rows.column("hash").to_numpy(), rows.column("n").to_numpy()
            asks = n > 0
            _, inverse = np.unique(h[asks], return_inverse=True)
            total = np.zeros(len(h), np.int64)
            total[asks] = np.bincount(inverse, weights=n[asks]).astype(np.int64)[inverse]
            found = rows.select(["doc", "hash", "at", "count", "place"]).append_column("total", pa.array(total))
            yield from found.filter(pa.array(total != 1)).to_batches(max_chunksize=1 << 16)

    return (
        docs.mapInArrow(tidy(collect), schema)
        .repartition("key")
        .sortWithinPartitions("key")
        .mapInArrow(tidy(answer), "doc bigint, hash bigint, at bigint, count int, place int, total bigint")
    )


def _cut(often: set[int]):
    """Runs with their bytes, and spans already known to repeat (with no bytes)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        earliest: dict[tuple, tuple[int, int]] = {}
        out: list[tuple] = []

        def sent() -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary())
            made = pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names=["key", "doc", "at", "place", "text"]
            )
            out.clear()
            return made

        def put(key: int, doc: int, at: int, place: int, text: bytes) -> None:
            """Send a run on, unless the task has had an equal one that is earlier."""
            known = earliest.get((text, place))
            if known is not None and known < (doc, at):
                out.append((xxhash.xxh64_intdigest(f"{doc},{at}") >> 1, doc, at, at + len(text), None))
                return
            if len(earliest) >= REMEMBERED:
                earliest.clear()
            earliest[text, place] = (doc, at)
            out.append((key, doc, at, place, text))

        for part in (p for batch in batches for p in slices(batch, 1 << 19)):
            for doc, text, listed in zip(part.column(0).to_pylist(), part.column(1), part.column(2)):
                if not listed.is_valid or not text.is_valid:
                    continue
                data = text.as_py().encode("utf-8")
                for r in sorted(listed.as_py(), key=lambda r: r["at"]):
                    at, count = r["at"], r["count"]
                    if len(out) >= SENT:
                        yield sent()
                    if r["hash"] not in often:
                        put(r["hash"], doc, at, r["place"], data[at : at + count - 1 + WIDTH])
                        continue
                    for w in range(at, at + count):
                        window = data[w : w + WIDTH]
                        put(xxhash.xxh64_intdigest(window) >> 1, doc, w, 0, window)
        if out:
            yield sent()

    return tidy(run)


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans that repeat, from runs sorted by key."""

    def spans(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        known = rows.filter(pa.compute.is_null(rows.column("text")))
        yield from known.select(["doc", "at", "place"]).rename_columns(["doc", "begin", "end"]).to_batches()
        runs = rows.filter(pa.compute.is_valid(rows.column("text")))
        if runs.num_rows < 2:
            return
        key, doc, at, place = (runs.column(c).to_numpy() for c in ("key", "doc", "at", "place"))
        low, high = repeated_windows(key, doc, at, place, runs.column("text").to_pylist())
        hit = np.flatnonzero(low >= 0)
        yield pa.RecordBatch.from_arrays(
            [pa.array(doc[hit]), pa.array(at[hit] + low[hit]), pa.array(at[hit] + high[hit] + WIDTH)],
            names=["doc", "begin", "end"],
        )

    for rows in _whole_keys(batches, TOGETHER):
        yield from spans(rows)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc``, ``begin``, ``end``: spans of bytes covered by strings of WIDTH bytes that
    also start earlier. Spans of a document may overlap. ``docs``: ``doc`` (bigint), ``text``."""
    anchors = staged(_anchors(docs), "anchors")
    # A row is a run; totals stand on a row per task that holds the anchor, so their sum is larger.
    least = max(OFTEN, anchors.count() // OFTEN_MOST)
    often = {r.hash for r in anchors.filter(F.col("total") > least).select("hash").distinct().collect()}
    listed = anchors.groupBy("doc").agg(F.collect_list(F.struct("hash", "at", "count", "place")).alias("runs"))
    cut = docs.join(listed, "doc", "left").select("doc", "text", "runs").mapInArrow(
        _cut(often), "key bigint, doc bigint, at bigint, place bigint, text binary"
    )
    return cut.repartition("key").sortWithinPartitions("key").mapInArrow(tidy(_compare), "doc bigint, begin bigint, end bigint")


def _kept(text: bytes, spans: list[dict] | None) -> tuple[bytes, int, int]:
    """What is left of a text, the bytes removed, and the number of maximal removed runs."""
    parts, at, removed, runs = [], 0, 0, 0
    for begin, end in sorted((s["begin"], s["end"]) for s in spans or ()):
        if runs == 0 or begin > at:
            parts.append(text[at:begin])
            runs, removed, at = runs + 1, removed + end - begin, end
        elif end > at:
            removed, at = removed + end - at, end
    return b"".join([*parts, text[at:]]), removed, runs


def remove_repeated(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``text``, ``kept`` (binary), ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``.

    From each text, as UTF-8, go all bytes covered by a string of WIDTH bytes that also starts
    earlier: in a document of smaller id, or before in the same document. Strings are judged on
    the input. What is kept may cut a character, so it is binary. A null text counts as
    empty. Rows with a null id come first in the order of documents, as one document. Rows
    that repeat an id are one document too: a string is not earlier than itself, and each
    row loses what any of them would lose. Other columns are left out.
    """
    nowhere = -(1 << 63)
    docs = df.select(F.coalesce(F.col(doc_id).cast("bigint"), F.lit(nowhere)).alias("doc"), F.col(text).alias("text"))
    spans = repeated_spans(docs).groupBy("doc").agg(F.collect_list(F.struct("begin", "end")).alias("spans"))

    def maker():
        def compute(batch):
            out: dict[str, list] = {k: [] for k in ("kept", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
            for value, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                data = (value or "").encode("utf-8")
                found = [s for s in found or () if s["end"] <= len(data)]
                kept, removed, runs = _kept(data, found)
                for name, x in zip(out, (kept, len(data), removed, runs, sha256(kept))):
                    out[name].append(x)
            return out

        return compute

    joined = docs.join(spans, "doc", "left").select("doc", "text", "spans")
    made = add_columns(joined, "kept binary, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string", maker)
    named = F.when(F.col("doc") != nowhere, F.col("doc")).alias(doc_id)
    return made.select(named, F.col("text").alias(text), "kept", "n_bytes", "n_removed", "n_spans", "kept_sha256")
