"""Phrase collocation mining with an FM-index over word ids per shard.

A shard holds the words of some documents of one language; its index has two Burrows-Wheeler
transforms, of the row of words and of the reversed row, with suffixes sorted as deep as
phrases go. A phrase is an interval of suffixes in both. All intervals of a length are extended
by one word at once: to the left by the words that stand before the suffixes of the interval, to
the right in the reversed index; either step moves the other interval along. Phrases
that are reached by both steps have a frequent start and a frequent end. Counts are
interval sizes, summed across shards; a phrase can be frequent only if its parts are, which
cuts what shards send: first hashes of words, then of pairs, and so on, one length after the
other, and at last the phrases themselves with exact counts, of which hardly any is not frequent.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import rows_per_batch, session_settings, tidy
from newsloom.settings import release, staged

DEPTH, LEAST = 4, 30
KEPT_PERCENT = 80
TOP = 2000
SCORE_UNIT = 2_000_000
UNKNOWN = "und"
# Words of a shard; one shard is at least one document.
SHARD_WORDS = 1 << 19
# A task with open shards of many languages closes the largest when together they have so many times these words.
OPEN_SHARDS = 8
# Rows of a written index are at most so large together before they go to disk.
GROUP_BYTES = 16 << 20
# Parquet's writer keeps 100 rows, here of some megabytes each, before it first looks, unless told to look after each.
EACH_ROW = {"parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 1}
# Shards that a task adds up before it sends, if there are enough for all cores.
SHARDS_OF_A_TASK = 12
TEXTS_AT_A_TIME, TEXT_BYTES = 1000, 4 << 20
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
# Rows that Parquet's reader decodes at a time; 4096 of an index would be all of a group.
READ_ROWS = "spark.sql.parquet.columnarReaderBatchSize"
TOGETHER, SUMS_AT_A_TIME = 1 << 22, 1 << 16
# Places of an index whose words are sorted at a time when phrases are extended, unless one phrase has more.
PLACES = 1 << 17
PHRASES_AT_A_TIME = 1 << 15
# The filter of frequent hashes has 2**FEWEST_BITS to 2**MOST_BITS bits, BITS_EACH for each hash. Beyond
# the most it lets more phrases through, which costs shuffle, not results.
FEWEST_BITS, MOST_BITS = 16, 28
BITS_EACH, PROBES = 12, 3
# The bits of a hash that are sent to be added up: the first 40, some thousand times as fine as the largest filter.
# Phrases that share them are taken for one, which may let a rare one through, and never stops a frequent one.
SENT = np.uint64(0xFFFFFFFFFF000000)
# Parts of a language whose best phrases are found first.
PARTS = 64

# ASCII letters become small, ends of pieces a full stop, tabs a blank.
_SHOWN = bytes(
    0x2E if c in b".,;:!?\n\x0b\x0c\r" else 0x20 if c == 9 else c + 32 if 0x41 <= c <= 0x5A else c for c in range(256)
)
END = 0


def stable_order(key: np.ndarray) -> np.ndarray:
    """Places of numbers that are not negative in their order, equal ones by place."""
    bits = max(len(key) - 1, 0).bit_length()
    if int(key.max(initial=0)).bit_length() + bits > 63:
        return np.argsort(key, kind="stable")
    # Numbers with their places behind them are sorted much faster than places by numbers.
    packed = key.astype(np.int64) << bits
    packed |= np.arange(len(key))
    packed.sort()
    packed &= (1 << bits) - 1
    return packed


def sorted_suffixes(row: np.ndarray) -> np.ndarray:
    """Starts of suffixes in the order of their first ``DEPTH`` (4) words, equal ones by start."""
    ranks = row.astype(np.int64)
    for step in (1, 2):
        after = np.append(ranks[step:], np.zeros(min(step, len(ranks)), np.int64))
        key = ranks * (int(ranks.max()) + 1) + after
        order = stable_order(key)
        changes = key[order[1:]] != key[order[:-1]]
        ranks = np.empty(len(row), np.int64)
        ranks[order] = np.concatenate([[0], np.cumsum(changes)])
    return order


def transform(row: np.ndarray) -> np.ndarray:
    """The word before each suffix, in suffix order."""
    return row[sorted_suffixes(row) - 1].astype(np.int32)


class Side:
    """One transform with its rank structure: where a suffix goes when the word before it is put in front."""

    def __init__(self, before: np.ndarray):
        self.before = before
        self.moved = np.empty(len(before), np.int32)
        self.moved[stable_order(before)] = np.arange(len(before), dtype=np.int32)

    def extend(self, start: np.ndarray, size: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, ...]:
        """All extensions of intervals by one word: parent, word, new start here, new start in the other
        index, size."""
        ends = np.cumsum(size, dtype=np.int64)
        cuts = np.searchsorted(ends, np.arange(PLACES, ends[-1] if len(ends) else 0, PLACES))
        cuts = np.unique([0, *cuts.tolist(), len(size)]).tolist()
        parts = [self._extend(a, start[a:b], size[a:b], other[a:b]) for a, b in zip(cuts, cuts[1:])]
        if not parts:
            return (np.zeros(0, np.int32),) * 5
        return tuple(np.concatenate(x) for x in zip(*parts))

    def _extend(self, before: int, start: np.ndarray, size: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, ...]:
        """``extend`` for a part of the intervals, that have ``before`` others before them."""
        first = np.cumsum(size, dtype=np.int64) - size
        parent = np.repeat(np.arange(len(size), dtype=np.int32), size)
        place = np.arange(len(parent), dtype=np.int32) - np.repeat((first - start).astype(np.int32), size)
        key = parent.astype(np.int64) * (int(self.before.max(initial=0)) + 1)
        key += self.before[place]
        order = stable_order(key)
        key = key[order]
        heads = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
        sizes = np.diff(np.append(heads, len(key))).astype(np.int32)
        lead = order[heads]
        parent, place = parent[lead], place[lead]
        word = self.before[place]
        # In the other index the extensions of an interval follow each other in the order of their words.
        along = (other[parent] + heads - first[parent]).astype(np.int32)
        real = word != END
        return parent[real] + np.int32(before), word[real], self.moved[place[real]], along[real], sizes[real]


class Phrases:
    """Phrases of one length in a shard: their words, both intervals, sizes and hashes."""

    def __init__(self, words: np.ndarray, left: np.ndarray, right: np.ndarray, size: np.ndarray):
        self.words, self.left, self.right, self.size = words, left, right, size

    def only(self, chosen: np.ndarray | slice) -> Phrases:
        return Phrases(self.words[chosen], self.left[chosen], self.right[chosen], self.size[chosen])

    def hashes(self, of_words: np.ndarray) -> np.ndarray:
        total = np.zeros(len(self.words), np.uint64)
        for column in self.words.T:
            total = (total * np.uint64(0x9E3779B97F4A7C15)) ^ of_words[column]
            total ^= total >> np.uint64(29)
            total *= np.uint64(0xBF58476D1CE4E5B9)
        return total


class Index:
    """A shard: transforms of its row of words and of the reversed row, and the words by number."""

    def __init__(self, lang: str, words: list[bytes], before: np.ndarray, after: np.ndarray):
        self.lang, self.words = lang, words
        self.sides = Side(before), Side(after)
        seed = xxhash.xxh64_intdigest(lang.encode())
        self.word_hashes = np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)

    @classmethod
    def of(cls, lang: str, words: list[bytes], row: np.ndarray) -> Index:
        return cls(lang, words, transform(row), transform(row[::-1]))

    def single(self) -> Phrases:
        """All words: in both indexes the interval of a word lies behind those of smaller numbers."""
        sizes = np.bincount(self.sides[0].before, minlength=len(self.words)).astype(np.int32)
        start = np.cumsum(sizes, dtype=np.int32) - sizes
        number = np.arange(1, len(self.words), dtype=np.int32)
        return Phrases(number[:, None], start[1:], start[1:], sizes[1:])

    def longer(self, phrases: Phrases) -> Phrases:
        """Phrases one word longer that both start and end with one of ``phrases``."""
        parent, word, left, right, size = self.sides[0].extend(phrases.left, phrases.size, phrases.right)
        # Equal phrases have equal intervals, so their starts in the first index tell.
        both = np.zeros(len(self.sides[0].before), bool)
        both[self.sides[1].extend(phrases.right, phrases.size, phrases.left)[3]] = True
        both = both[left]
        return Phrases(np.column_stack([word[both], phrases.words[parent[both]]]), left[both], right[both], size[both])

    def text(self, phrases: Phrases) -> list[bytes]:
        words = self.words
        return [b" ".join([words[i] for i in row]) for row in phrases.words.tolist()]


def build_indexes(docs: DataFrame, text: str = "text", lang: str = "lang", shard_words: int = SHARD_WORDS) -> DataFrame:
    """``lang``, ``n`` (words), ``words``, ``before``, ``after``: an index per row, from the documents of a task
    in one language, as many as make up ``shard_words``; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # For each language the numbers of its words, and the words of its documents as a row of int32.
        numbers: dict[str, dict[bytes, int]] = {}
        rows: dict[str, bytearray] = {}
        sizes: dict[str, int] = {}

        def close(name: str) -> pa.RecordBatch:
            row = np.frombuffer(rows.pop(name) + bytes(4), np.int32)
            words = list(numbers.pop(name))
            sizes.pop(name)
            index = [transform(row).tobytes(), transform(row[::-1]).tobytes()]
            columns = [[name], [int((row != END).sum())], [b" ".join(words)], [index[0]], [index[1]]]
            types = [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=["lang", "n", "words", "before", "after"]
            )

        for batch in batches:
            for name, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                shown = (value.as_py() or b"").translate(_SHOWN).replace(b".", b" . ").split()
                if name not in numbers:
                    fresh = count(0)
                    numbers[name] = defaultdict(fresh.__next__)
                    numbers[name][b"."]  # the end of a piece is number 0
                    rows[name], sizes[name] = bytearray(), 0
                if not shown:
                    continue
                rows[name] += bytes(4)
                rows[name] += np.fromiter(map(numbers[name].__getitem__, shown), np.int32, len(shown)).tobytes()
                sizes[name] += len(shown)
                if sizes[name] >= shard_words:
                    yield close(name)
                elif sum(sizes.values()) >= OPEN_SHARDS * shard_words:
                    yield close(max(sizes, key=sizes.get))
        for name in list(numbers):
            yield close(name)

    rows = docs.select(F.coalesce(F.col(lang), F.lit(UNKNOWN)).alias("lang"), F.col(text).cast("binary").alias("text"))
    return rows.mapInArrow(tidy(run), "lang string, n bigint, words binary, before binary, after binary")


def _each_index(batches: Iterator[pa.RecordBatch]) -> Iterator[Index]:
    for batch in batches:
        for i in range(batch.num_rows):
            lang, words, before, after = (batch.column(batch.schema.get_field_index(c))[i] for c in ("lang", "words", "before", "after"))
            yield Index(
                lang.as_py(),
                words.as_py().split(b" "),
                np.frombuffer(before.as_buffer(), np.int32),
                np.frombuffer(after.as_buffer(), np.int32),
            )


class Filter:
    """A Bloom filter of hashes, those that may be frequent. Its bits are broadcast, so that a worker has them once."""

    def __init__(self, size: int, probes: int, bits: Broadcast[bytes]):
        self.size, self.probes, self.bits = np.uint64(size), probes, bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """Places are those of ``_places``."""
        words = np.frombuffer(self.bits.value, np.uint64)
        place = (hashes >> np.uint64(32)) * self.size >> np.uint64(32)
        step = hashes >> np.uint64(24) & np.uint64(0xFFFF) | np.uint64(1)
        found = np.ones(len(hashes), bool)
        for _ in range(self.probes):
            place %= self.size
            found &= (words[place >> np.uint64(6)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)
            place += step
        return found


def _places(size: int, probes: int) -> Column:
    """The places of a hash ``h`` in a filter: from its first 32 bits, then on by its bits 24 to 39."""
    first = f"shiftright(shiftrightunsigned(h, 32) * {size}L, 32)"
    step = "(shiftrightunsigned(h, 24) & 65535L | 1L)"
    return F.array(*[F.expr(f"({first} + {i}L * {step}) % {size}L") for i in range(probes)])


def _hash_counts(indexes: DataFrame, filters: list[Filter], least: int) -> DataFrame:
    """``h``, ``n``: the sent bits of hashes of phrases of the next length after those that have filters, with
    counts, in order of the hash; ``least`` stands for larger counts too. Shards of a task are added up
    ``TOGETHER`` hashes at a time, which spares a map side sum. A count is kept in the bits that are not sent, so
    one sort of plain numbers brings them together."""

    most = ~SENT  # and the largest count beside a hash; more takes several numbers

    def packed(index: Index) -> np.ndarray:
        phrases = index.single()
        for known in filters:
            phrases = index.longer(phrases.only(known.has(phrases.hashes(index.word_hashes))))
        hashes, sizes = phrases.hashes(index.word_hashes) & SENT, np.minimum(phrases.size, least).astype(np.uint64)
        parts = [hashes | np.minimum(sizes, most)]
        while (more := sizes > most).any():
            hashes, sizes = hashes[more], sizes[more] - most
            parts.append(hashes | np.minimum(sizes, most))
        return np.concatenate(parts)

    def sums(both: np.ndarray) -> Iterator[pa.RecordBatch]:
        both.sort()
        start = 0
        while start < len(both):
            end = start + SUMS_AT_A_TIME
            if end < len(both):  # what belongs to one hash stays together
                end = int(np.searchsorted(both, both[end] & SENT))
                end = end if end > start else int(np.searchsorted(both, both[start] | most, "right"))
            hashes, sizes = both[start:end] & SENT, both[start:end] & most
            heads = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
            sizes = np.minimum(np.add.reduceat(sizes, heads), np.uint64(least))
            columns = [pa.array(hashes[heads].view(np.int64)), pa.array(sizes.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, names=["h", "n"])
            start = end

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        room, used = np.empty(TOGETHER, np.uint64), 0
        for one in map(packed, _each_index(batches)):
            if used + len(one) > len(room):
                yield from sums(room[:used])
                used = 0
            if len(one) > len(room):
                yield from sums(one)
            else:
                room[used : used + len(one)] = one
                used += len(one)
        yield from sums(room[:used])

    return indexes.mapInArrow(tidy(run), "h bigint, n bigint")


def _frequent(counts: DataFrame, least: int) -> DataFrame:
    """The hashes that reach ``least`` over all shards."""
    summed = counts.repartition("h").groupBy("h").agg(F.sum("n").alias("n"))
    return staged(summed.filter(F.col("n") >= least).select("h"), "frequent-hashes")


def _filter(found: DataFrame) -> Filter:
    """A filter of hashes. What the driver gets are its bits, 64 in a row, of which there are bounded many."""
    many = max(int(found.count()), 1)
    size = min(max(1 << FEWEST_BITS, many * BITS_EACH), 1 << MOST_BITS) + 63 >> 6 << 6
    # As many probes as a filter of that size is good for.
    probes = min(max(round(0.7 * size / many), 1), PROBES)
    grouped = found.select(F.explode(_places(size, probes)).alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(
        F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("v")
    )
    table = grouped.toArrow()
    words = np.zeros(size >> 6, np.uint64)
    words[table.column("w").to_numpy()] = table.column("v").to_numpy().view(np.uint64)
    return Filter(size, probes, found.sparkSession.sparkContext.broadcast(words.tobytes()))


def _phrase_counts(indexes: DataFrame, filters: list[Filter], depth: int) -> DataFrame:
    """``lang``, ``words`` (their number), ``phrase``, ``n`` per shard, of all that may be frequent."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for index in _each_index(batches):
            phrases = index.single()
            for length in range(1, depth + 1):
                if length > 1:
                    phrases = index.longer(phrases)
                if length <= len(filters):
                    phrases = phrases.only(filters[length - 1].has(phrases.hashes(index.word_hashes)))
                for i in range(0, len(phrases.size), PHRASES_AT_A_TIME):
                    part = phrases.only(slice(i, i + PHRASES_AT_A_TIME))
                    columns = [
                        pa.array([index.lang] * len(part.size), pa.string()),
                        pa.array(np.full(len(part.size), length, np.int32)),
                        pa.array(index.text(part), pa.binary()).cast(pa.string()),
                        pa.array(part.size, pa.int64()),
                    ]
                    yield pa.RecordBatch.from_arrays(columns, names=["lang", "words", "phrase", "n"])

    return indexes.mapInArrow(tidy(run), "lang string, words int, phrase string, n bigint")


def _part(start: int, length: Column) -> Column:
    return F.array_join(F.slice("w", start, length), " ")


def score_phrases(counts: DataFrame, totals: DataFrame, percent: int = KEPT_PERCENT, top: int = TOP) -> DataFrame:
    """The ranked phrases from frequent ones of all lengths (``lang``, ``words``, ``phrase``, ``f``)
    and the number of words of each language (``lang``, ``n``)."""
    longer = counts.filter("words > 1")
    # A longer candidate that holds a phrase also holds one that is a word longer than the phrase, and that
    # is at least as frequent; so extensions by one word to the left and to the right decide.
    ends = F.array(
        F.expr("substring(phrase, instr(phrase, ' ') + 1)"),
        F.expr("substring_index(phrase, ' ', words - 1)"),
    )
    extended = (
        longer.filter("words > 2").select("lang", "f", F.explode(F.array_distinct(ends)).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("f").alias("most"))
    )
    kept = longer.join(extended, ["lang", "phrase"], "left").filter(
        F.col("most").isNull() | (F.col("most").cast("decimal(20,0)") * 100 < F.col("f").cast("decimal(20,0)") * percent)
    )
    cuts = kept.select(
        "lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w"),
        F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"),
    ).select(
        "lang", "phrase", "a", "k", _part(1, F.col("k")).alias("head"),
        F.expr("array_join(slice(w, k + 1, size(w) - k), ' ')").alias("tail"),
    )
    single = counts.select("lang", F.col("phrase").alias("head"), F.col("f").alias("l"))
    scored = cuts.join(single, ["lang", "head"]).join(single.toDF("lang", "tail", "r"), ["lang", "tail"])
    scored = scored.withColumn("score", F.expr(f"cast(a as decimal(20,0)) * {SCORE_UNIT} div (cast(l as decimal(20,0)) + r)"))
    # Of the cuts, the lowest score, then the shortest first part; a phrase has three at most.
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.score", "cut.l", "cut.r")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    place = F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))
    best = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(PARTS))).withColumn("rank", place)
    best = best.filter(F.col("rank") <= top)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    best = best.withColumn("rank", place.cast("bigint")).filter(F.col("rank") <= top)
    return best.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def mine_phrases(
    docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST, percent: int = KEPT_PERCENT,
    top: int = TOP, depth: int = DEPTH, shard_words: int = SHARD_WORDS,
) -> DataFrame:
    """``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``: the best phrases of each language.

    A null language is ``und``; null and empty texts have no words. Repeated rows count
    as often as they are there. Other columns take no part. An empty table gives no rows.
    """
    if not 2 <= depth <= DEPTH:
        raise ValueError(f"phrases have 2 to {DEPTH} words")
    spark = docs.sparkSession
    with rows_per_batch(spark, TEXTS_AT_A_TIME), session_settings(spark, {ARROW_BYTES: str(TEXT_BYTES)}):
        indexes = build_indexes(docs, text, lang, shard_words)
        indexes = staged(indexes, "phrase-index", **{"parquet.block.size": GROUP_BYTES, "compression": "zstd"}, **EACH_ROW)
    tasks = max(indexes.count() // SHARDS_OF_A_TASK, 2 * spark.sparkContext.defaultParallelism)
    dealt = indexes.coalesce(tasks)
    filters: list[Filter] = []
    for _ in range(depth):
        with rows_per_batch(spark, 1), session_settings(spark, {READ_ROWS: "1"}):
            found = _frequent(_hash_counts(dealt, filters, least), least)
        filters.append(_filter(found))
        release(found)
    with rows_per_batch(spark, 1), session_settings(spark, {READ_ROWS: "1"}):
        counts = _phrase_counts(dealt, filters, depth).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))
        counts = staged(counts.filter(F.col("f") >= least), "phrase-counts")
    for known in filters:
        known.bits.destroy()
    totals = staged(indexes.groupBy("lang").agg(F.sum("n").alias("n")), "phrase-totals")
    release(indexes)
    return score_phrases(counts, totals, percent, top)
