"""Exact Jaccard join of documents on word shingles, by prefixes of token combinations.

Shingles are in one order for all documents: rare ones first, then frequent ones, by hash.
Two sets that are similar enough lack only so many of each other's shingles, so a long
enough prefix of each must share some. Rare shingles are indexed singly. Frequent shingles
are dealt into classes; of each class, pairs of shingles are indexed, and the prefix is
made longer by the one shingle per class that a pair cannot promise. Unrelated documents
that share a frequent shingle seldom share two of one class. Very large sets
index pairs only, as they share some rare shingle with any other large set.

Documents with one set are one class from the start, known by a hash of the set; only classes
are indexed and compared. Classes that share an index entry are candidates. They are not
compared all with all: first each with the smallest class it may be similar to; those links
give components; and only candidates still in different components are compared with each
other. Every link left out lies within a component, so components are exact.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import slices, tidy
from newsloom.llm.components import connected
from newsloom.settings import release, staged

WORDS = 4
PERCENT = 85
# A shingle is frequent above this many documents, or above the part of all shingles that
# keeps the frequent ones, which every task gets, to at most FREQUENT_MOST.
FREQUENT, FREQUENT_MOST = 32, 1 << 22
# Shingles counted at a time; those seen less often among them are not added up.
COUNTED, LEAST_COUNT = 1 << 21, 4
# Sets up to SINGLE shingles index single shingles only, larger ones class pairs of frequent
# ones, and from LARGE on class pairs of all shingles. Sets that may be similar to one on the
# other side of such a limit do both.
SINGLE, CLASSES, LARGE = 40, 16, 512
# Bits of the sketch that bounds the difference of two sets from below.
SKETCH = 256
# Members of a group that are compared in one task at a time, and pairs a task holds back.
CHUNK, PAIRS_HELD = 1024, 1 << 21
REMEMBERED = 1 << 17
BITMAP_BITS = 1 << 24

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5)]


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _MIX[0]
    return h ^ (h >> np.uint64(32))


def shingles(text: str | None, words: int, hashes: dict) -> np.ndarray:
    """The set of shingles of a text as sorted 64-bit hashes; a text of fewer words
    than a shingle is one shingle. Only A-Z change case; words end at ASCII white space."""
    parts = text.encode("utf-8").lower().split() if text else []
    if not parts:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(hashes.__getitem__, parts), np.uint64, len(parts))
    n = min(words, len(h))
    combined = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        combined = _mixed(combined + h[i : len(h) - n + 1 + i] * _MIX[i % 4])
    return np.unique(combined)


def class_of(tokens: np.ndarray) -> int:
    """The number of a set's class."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little", signed=True)


def _needed(n: int, percent: int) -> int:
    """Length of a prefix that a similar set cannot lack altogether."""
    return n - -(-n * percent // 100) + 1


def _class_pairs(tokens: np.ndarray, free: int, needed: int, classes: int) -> np.ndarray:
    """Pairs of the tokens of a class, over the shortest prefix that promises ``needed`` in all;
    ``free`` of them come from single tokens."""
    kind = (_mixed(tokens) % np.uint64(classes)).astype(np.int64)
    seen: dict[int, list[int]] = {}
    promised, out = free, []
    for token, k in zip(tokens.tolist(), kind.tolist()):
        if promised >= needed:
            break
        others = seen.setdefault(k, [])
        promised += bool(others)
        out += [(other, token) for other in others]
        others.append(token)
    if not out:
        return np.zeros(0, np.uint64)
    pairs = np.array(out, np.uint64)
    return _mixed(pairs[:, 0] * _MIX[1] + pairs[:, 1] + _MIX[2])


def signatures(tokens: np.ndarray, frequent: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Index entries of a set. ``tokens`` and ``frequent`` are sorted."""
    n = len(tokens)
    if n == 0:
        return tokens
    needed = _needed(n, percent)
    at = np.searchsorted(frequent, tokens)
    common = np.zeros(n, bool)
    inside = at < len(frequent)
    common[inside] = frequent[at[inside]] == tokens[inside]
    rare, often = tokens[~common], tokens[common]
    out = []
    if n <= SINGLE:
        out.append(np.concatenate([rare, often])[:needed])
    if 100 * n >= percent * SINGLE and percent * n <= 100 * LARGE:
        out.append(rare[:needed])
        if len(rare) < needed:
            out.append(_class_pairs(often, len(rare), needed, CLASSES))
    if n >= LARGE:
        # The number of classes doubles with the size; near the next step both numbers are used.
        level = (n // LARGE).bit_length() - 1
        for step in (level, level + 1) if 100 * n >= percent * (LARGE << (level + 1)) else (level,):
            pairs = _class_pairs(np.concatenate([rare, often]), 0, needed, (LARGE // 2) << step)
            out.append(pairs + np.uint64(step + 1))
    return np.unique(np.concatenate(out))


def sketch(tokens: np.ndarray) -> bytes:
    """A bit per bucket: whether it holds an odd number of tokens. A token that only one of two
    sets has changes one bit, so the sets differ by at least as many tokens as the sketches by bits."""
    counts = np.bincount((tokens % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH)
    return np.packbits(counts & 1).tobytes()


def _possible(na, nb, sa, sb, percent: int) -> np.ndarray:
    """Whether pairs can be similar, by their sizes and sketches."""
    differ = np.maximum(np.bitwise_count(sa ^ sb).sum(axis=1, dtype=np.int64), np.abs(na - nb))
    # With d tokens in one set only, the overlap is (na + nb - d) / 2 and the union (na + nb + d) / 2.
    return 100 * (na + nb - differ) >= percent * (na + nb + differ)


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(-1, SKETCH // 64)


def _frequent(docs: DataFrame, words: int) -> np.ndarray:
    """The frequent shingles, sorted. Those that come to the driver hold more than a
    FREQUENT_MOST-th of all shingles each, so they are fewer than that many."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, held, size = _WordHashes(), [], 0

        def count() -> pa.RecordBatch:
            tokens, times = np.unique(np.concatenate(held), return_counts=True)
            often = times >= LEAST_COUNT
            return pa.RecordBatch.from_arrays(
                [pa.array(np.append(tokens[often], np.uint64(0)).view(np.int64)),
                 pa.array(np.append(times[often], times.sum())),
                 pa.array(np.append(np.zeros(often.sum(), bool), True))],
                names=["token", "n", "sum"],
            )

        for part in (p for batch in batches for p in slices(batch)):
            for text in part.column(1).to_pylist():
                tokens = shingles(text, words, hashes)
                held.append(tokens)
                size += len(tokens)
                if size >= COUNTED:
                    yield count()
                    held.clear()
                    size = 0
        if size:
            yield count()

    counted = docs.mapInArrow(tidy(run), "token bigint, n bigint, sum boolean").groupBy("sum", "token").agg(
        F.sum("n").alias("n")
    )
    counted = staged(counted, "shingle-counts")
    total = counted.filter("sum").agg(F.sum("n")).first()[0] or 0
    least = max(FREQUENT, total // FREQUENT_MOST)
    found = counted.filter(~F.col("sum") & (F.col("n") > least)).select("token").toPandas()["token"]
    release(counted)
    return np.sort(found.to_numpy(np.int64).view(np.uint64))


def _index(docs: DataFrame, frequent: np.ndarray, words: int, percent: int) -> DataFrame:
    """Per document: ``mark``, ``n`` and ``cls`` (its set's hash; null without shingles), and for the first document of
    a class in a task ``sketch`` and ``sigs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = _WordHashes(), set()
        for part in (p for batch in batches for p in slices(batch)):
            n, classes, sketches, sigs = [], [], [], []
            for text in part.column(1).to_pylist():
                tokens = shingles(text, words, hashes)
                cls = class_of(tokens) if len(tokens) else None
                keep = cls is not None and cls not in known
                known.add(cls)
                n.append(len(tokens))
                classes.append(cls)
                sketches.append(sketch(tokens) if keep else None)
                sigs.append(signatures(tokens, frequent, percent).view(np.int64) if keep else None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), pa.array(n, pa.int64()), pa.array(classes, pa.int64()), pa.array(sketches, pa.binary()),
                 pa.array(sigs, pa.list_(pa.int64()))],
                names=["doc", "mark", "n", "cls", "sketch", "sigs"],
            )

    return docs.mapInArrow(tidy(run), "doc bigint, mark bigint, n bigint, cls bigint, sketch binary, sigs array<bigint>")


def _filter_pairs(pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a``, ``b`` with ``na``, ``nb``, ``sa``, ``sb`` that can be similar."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b, na, nb, sa, sb = batch.columns
                keep = _possible(na.to_numpy(), nb.to_numpy(), _matrix(sa), _matrix(sb), percent)
                yield batch.select(["a", "b"]).filter(pa.array(keep))

    return pairs.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a bigint, b bigint")


def _links(docs: DataFrame, classes: DataFrame, pairs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs of classes whose sets are similar: every pair is verified on whole sets.

    Only sets of classes that occur in a pair are made and shuffled, from one document (``rep``) of
    each. Which these are is told to the tasks by a bitmap of fixed size; at more documents than
    it can tell apart it lets others pass, and the join leaves them out.
    """
    met = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    ids = classes.select("cls", F.col("rep").alias("doc")).join(met, "cls").select("doc").distinct()
    slot = F.pmod(F.xxhash64("doc"), F.lit(BITMAP_BITS)).cast("bigint")
    # Both buckets of 2**15 bits and the places that go into them are counted from 1.
    marked = ids.groupBy(F.bitmap_bucket_number(slot + 1).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(slot + 1)).alias("bits")
    )
    bits = np.zeros(BITMAP_BITS // 8, np.uint8)
    for row in marked.collect():
        bits[(row.bucket - 1) * 4096 : row.bucket * 4096] = np.frombuffer(bytes(row.bits), np.uint8)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known = _WordHashes(), set()
        for part in (p for batch in batches for p in slices(batch)):
            places = part.column(1).to_numpy()
            hit = bits[places >> 3] >> (places & 7).astype(np.uint8) & 1
            some = part.column(0).filter(pa.array(hit.astype(bool)))
            found = {}
            for text in some.to_pylist():
                tokens = shingles(text, words, hashes)
                cls = class_of(tokens)
                if len(tokens) and cls not in known:
                    known.add(cls)
                    found[cls] = tokens.tobytes()
            columns = [pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["cls", "set"])

    sets = docs.select("text", slot.alias("slot")).mapInArrow(tidy(run), "cls bigint, set binary")
    # Not renamed, so that both joins share one exchange of the sets.
    left = pairs.join(sets.alias("x"), F.col("a") == F.col("x.cls")).select("a", "b", F.col("x.set").alias("set_a"))
    both = left.join(sets.alias("y"), F.col("b") == F.col("y.cls")).select("a", "b", "set_a", F.col("y.set").alias("set_b"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (p for batch in batches for p in slices(batch)):
            keep = []
            for x, y in zip(part.column(2).to_pylist(), part.column(3).to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                shared = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * shared >= percent * (len(x) + len(y) - shared))
            yield part.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return both.select("a", "b", "set_a", "set_b").mapInArrow(tidy(verify), "a bigint, b bigint").distinct()


def _group_pairs(members: DataFrame, percent: int) -> DataFrame:
    """Pairs of members of a group and chunk that are in different components and can be
    similar. ``members``: hub, chunk, key, probe, doc, comp, n, sketch; within a chunk,
    probes are compared with all that are not probes there.

    Groups with one hub are mostly about the same documents and meet in one task per
    chunk, which sends a pair once however many groups it is in.
    """

    def pairs_of(rows: pa.Table) -> np.ndarray:
        hub, chunk, key, probe, doc, comp, n = (rows.column(i).to_numpy() for i in range(7))
        sketches = _matrix(rows.column(7))
        fresh = (hub[1:] != hub[:-1]) | (chunk[1:] != chunk[:-1]) | (key[1:] != key[:-1])
        start = np.flatnonzero(np.r_[True, fresh])
        size = np.diff(np.r_[start, len(key)])
        left_of = np.repeat(start + size, size)
        found = [np.zeros((2, 0), np.int64)]
        for apart in range(1, int(size.max())):
            i = np.flatnonzero(np.arange(len(key)) + apart < left_of)
            j = i + apart
            ok = (probe[i] ^ probe[j]) & (comp[i] != comp[j]) & (doc[i] != doc[j])
            ok &= 100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])
            i, j = i[ok], j[ok]
            ok = _possible(n[i], n[j], sketches[i], sketches[j], percent)
            found.append(np.stack([np.maximum(doc[i], doc[j])[ok], np.minimum(doc[i], doc[j])[ok]]))
        return np.unique(np.concatenate(found, axis=1), axis=1)

    def last_change(*columns: np.ndarray) -> int:
        """Rows before the last value, which may go on."""
        other = np.flatnonzero(np.any([c != c[-1] for c in columns], axis=0))
        return int(other[-1]) + 1 if len(other) else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        pairs = np.zeros((2, 0), np.int64)

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < 16 * CHUNK:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            hub, chunk, key = (rows.column(i).to_numpy() for i in range(3))
            whole = last_change(hub, chunk)
            cut = whole or last_change(key)
            if cut:
                pairs = np.unique(np.concatenate([pairs, pairs_of(rows.slice(0, cut).combine_chunks())], axis=1), axis=1)
                if whole or pairs.shape[1] > PAIRS_HELD:
                    yield sent()
                    pairs = pairs[:, :0]
            held = rows.slice(cut).combine_chunks().to_batches()
        if held:
            pairs = np.unique(np.concatenate([pairs, pairs_of(pa.Table.from_batches(held).combine_chunks())], axis=1), axis=1)
        yield sent()

    dealt = members.repartition("hub", "chunk").sortWithinPartitions("hub", "chunk", "key")
    columns = ("hub", "chunk", "key", "probe", "doc", "comp", "n", "sketch")
    return dealt.select(*columns).mapInArrow(tidy(run), "a bigint, b bigint")


def _grouped(df: DataFrame, doc_id: str, text: str, words: int, percent: int) -> DataFrame:
    """A row per row: ``doc``, ``mark`` (of its text), ``n``, ``cls`` and ``best``, the document of its component that
    has the smallest id (``best.doc``), or if ids are equal or null, mark; null without shingles."""
    docs = df.select(F.col(doc_id).cast("bigint").alias("doc"), F.col(text).alias("text"), F.xxhash64(text).alias("mark"))
    frequent = _frequent(docs, words)
    base = staged(_index(docs, frequent, words, percent), "jaccard-index")
    classes = base.filter("sigs is not null").groupBy("cls").agg(
        F.min("doc").alias("rep"), F.first("n").alias("n"), F.first("sketch").alias("sketch"), F.first("sigs").alias("sigs")
    )
    classes = staged(classes, "jaccard-classes")
    # The hub of a group is its smallest id: copies mostly come after what they were made from, and
    # are nearer to it than to each other.
    entries = classes.select("cls", "rep", F.explode("sigs").alias("sig"))
    hubs = entries.groupBy("sig").agg(F.min("rep").alias("hub"), F.min("cls").alias("_a"), F.max("cls").alias("_b"))
    hubs = hubs.filter("_a < _b").drop("_a", "_b")
    other = (~F.col("rep").eqNullSafe(F.col("hub"))).alias("other")
    groups = staged(entries.join(hubs, "sig").select("sig", "cls", "hub", other), "jaccard-groups")
    facts = classes.select("cls", "n", "sketch")

    def side(key: str, name: str) -> DataFrame:
        return classes.select(F.col(key).alias(name), F.col("n").alias(f"n{name}"), F.col("sketch").alias(f"s{name}"))

    stars = groups.filter("other").select(F.col("cls").alias("a"), F.col("hub").alias("b")).distinct()
    likely = _filter_pairs(stars.join(side("cls", "a"), "a").join(side("rep", "b"), "b"), percent)
    nearest = likely.groupBy("a").agg(F.min("b").alias("rep"))
    one_each = nearest.join(classes.select("rep", F.col("cls").alias("b")), "rep").select("a", "b").filter("a <> b")
    one_each = staged(one_each, "jaccard-stars")
    first = staged(_links(docs, classes, one_each, words, percent), "jaccard-links")
    parts = staged(connected(first), "jaccard-parts")
    release(one_each)

    def part(rows: DataFrame, node: str, out: str) -> DataFrame:
        named = parts.select(F.col("node").alias(node), F.col("component").alias(out))
        return rows.join(named, node, "left").withColumn(out, F.coalesce(out, node))

    # Any component would do as that of the hub: of two members in different ones, one is a probe.
    hub_parts = part(classes.select(F.col("rep").alias("hub"), "cls"), "cls", "hub_comp")
    hub_parts = hub_parts.groupBy("hub").agg(F.min("hub_comp").alias("hub_comp"))
    located = part(groups.drop("other"), "cls", "comp").join(hub_parts, "hub", "left")
    located = located.withColumn("probe", ~F.col("comp").eqNullSafe(F.col("hub_comp")))
    located = staged(located, "jaccard-located")
    release(groups)
    mixed = located.groupBy("sig").agg(F.count(F.lit(1)).alias("rows"), F.count_if("probe").alias("probes")).filter("probes > 0")
    open_rows = located.join(mixed, "sig").join(facts, "cls")
    # Probes of a group meet its members in a grid of chunks, so no task gets a whole large group.
    rows, probes = (F.ceil(F.col(c) / CHUNK).cast("int") for c in ("rows", "probes"))
    every = lambda n: F.sequence(F.lit(0), n - 1)
    one = lambda n: F.array(F.pmod(F.xxhash64("cls"), n).cast("int"))
    grid = open_rows.select("*", F.explode(one(rows)).alias("r"), F.lit(False).alias("asks")).select(
        "*", F.explode(every(probes)).alias("p")
    ).unionByName(
        open_rows.filter("probe").select("*", F.explode(every(rows)).alias("r"), F.lit(True).alias("asks")).select(
            "*", F.explode(one(probes)).alias("p")
        )
    )
    members = grid.select(
        "hub",
        F.col("sig").alias("key"),
        F.shiftleft(F.col("r").cast("bigint"), 31).bitwiseOR(F.col("p").cast("bigint")).alias("chunk"),
        F.col("asks").alias("probe"), F.col("cls").alias("doc"), "comp", "n", "sketch",
    )
    rest = staged(_group_pairs(members, percent).distinct(), "jaccard-rest")
    release(located)
    links = staged(first.unionByName(_links(docs, classes, rest, words, percent)), "jaccard-all-links")
    release(rest, first, parts, classes)
    whole = connected(links)
    release(links)
    # Classes without links are components of their own.
    own = F.struct(F.col("doc").isNull().alias("none"), "doc", "mark")
    least = base.filter("cls is not null").groupBy("cls").agg(F.min(own).alias("least"))
    placed = least.join(whole, least.cls == whole.node, "left").select("cls", "least", F.coalesce("component", "cls").alias("root"))
    named = placed.groupBy("root").agg(F.min("least").alias("best"))
    placed = staged(placed.join(named, "root").select(F.col("cls").alias("at"), "best"), "jaccard-components")
    # Rows without shingles are dealt out evenly; they find no class.
    at = F.coalesce("cls", F.xxhash64("mark", "doc"))
    joined = base.select("doc", "mark", "n", "cls", at.alias("at")).join(placed, "at", "left")
    return joined.select("doc", "mark", "n", "cls", F.when(F.col("cls").isNotNull(), F.col("best")).alias("best"))


def near_duplicates(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id``: the smallest id reachable by links; a row per row.

    Two documents link when 100 * |intersection| >= ``percent`` * |union| of their shingle
    sets. Null or empty texts have no shingles and no links. Rows that repeat an id are
    documents of their own, each with the links of its text, and so are rows with a null id; a group
    in which no row has an id has a null ``component_id``. Other columns take no part. Shingles, and sets
    of them, are told apart by 64-bit hashes.
    """
    return _grouped(df, doc_id, text, words, percent).select(
        F.col("doc").alias(doc_id),
        F.col("n").alias("n_shingles"),
        F.when(F.col("cls").isNull(), F.col("doc")).otherwise(F.col("best.doc")).alias("component_id"),
    )


def one_of_each(
    df: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """The rows of ``df`` without near duplicates: of each group of linked rows one stays, that of the
    smallest id. Rows with a null id stay only where no row of their group has one; of rows
    with equal or null ids the one with the least hash of its text stays, and of rows that repeat
    both id and text, one. Rows without shingles all stay."""
    grouped = staged(_grouped(df, doc_id, text, words, percent).filter("cls is not null"), "jaccard-grouped")
    stays = F.col("doc").eqNullSafe(F.col("best.doc")) & (F.col("mark") == F.col("best.mark"))
    leaving = grouped.filter(~stays).select("doc", "mark").distinct()
    again = staged(grouped.filter(stays).groupBy("doc", "mark").count().filter("count > 1").drop("count"), "jaccard-again")
    row = df.select(F.struct("*").alias("row"), F.col(doc_id).cast("bigint").alias("doc"), F.xxhash64(text).alias("mark"))

    def among(keys: DataFrame, how: str, rows: DataFrame) -> DataFrame:
        keys = keys.toDF("_doc", "_mark")
        return rows.join(keys, F.col("doc").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark")), how)

    kept = among(leaving, "left_anti", row)
    if not again.isEmpty():
        # Only rows that occur again are numbered.
        place = F.row_number().over(Window.partitionBy("doc", "mark").orderBy(F.xxhash64(*[f"row.`{c}`" for c in df.columns])))
        first = among(again, "left_semi", kept).withColumn("place", place).filter("place = 1").drop("place")
        kept = among(again, "left_anti", kept).unionByName(first)
    return kept.select("row.*")
