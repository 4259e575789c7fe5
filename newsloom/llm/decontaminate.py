"""Benchmark passages in training texts, by a generalised suffix automaton.

The automaton holds every run of words of every benchmark item. A text is streamed
through it word by word; after each word the automaton is in the state of the longest
run that ends there and occurs in an item. Where that run has the length of a window,
the window's words are hit.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import repeat

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsloom.llm.common import add_columns, texts_of, unused
from newsloom.settings import release, staged

WINDOW = 10
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# Text of the items of one automaton, which takes some hundred times as much memory in a task.
PART_BYTES = 1 << 20


def words_of(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8; only A-Z change case."""
    return WORD.findall(text.encode("utf-8").lower()) if text else []


class Automaton:
    """Generalised suffix automaton over the words of items.

    ``items``: (item id, text). Items without words are left out.
    """

    def __init__(self, items: Iterable[tuple[object, str | None]], window: int = WINDOW):
        self.window = window
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        runs = []
        for item, text in items:
            run = [self.vocab.setdefault(w, len(self.vocab)) for w in words_of(text)]
            if run:
                runs.append((str(item), run))
                self._add(run)
        # Items per window, at the state that holds the window; short items count whole.
        self.windows: list[set[str]] = [set() for _ in self.link]
        self.short: list[list[tuple[int, str]]] = [[] for _ in self.link]
        for item, run in runs:
            self._mark(item, run)
        order = sorted(range(1, len(self.link)), key=self.length.__getitem__)
        # The ancestor that holds the suffix as long as a window, and short items of all ancestors.
        self.holder = [0] * len(self.link)
        for s in order:
            up = self.link[s]
            self.holder[s] = s if self.length[up] < window else self.holder[up]
            self.short[s] = sorted(self.short[s] + self.short[up])

    def _state(self, length: int, copied: int | None = None) -> int:
        self.next.append({} if copied is None else dict(self.next[copied]))
        self.link.append(-1 if copied is None else self.link[copied])
        self.length.append(length)
        return len(self.link) - 1

    def _split(self, p: int, word: int) -> int:
        """The state reached from ``p`` by ``word``, made to end exactly one word after ``p``."""
        q = self.next[p][word]
        if self.length[q] == self.length[p] + 1:
            return q
        own = self._state(self.length[p] + 1, q)
        self.link[q] = own
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = own
            p = self.link[p]
        return own

    def _add(self, run: list[int]) -> None:
        last = 0
        for word in run:
            if word in self.next[last]:
                last = self._split(last, word)
                continue
            new, p = self._state(self.length[last] + 1), last
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = new
                p = self.link[p]
            self.link[new] = 0 if p < 0 else self._split(p, word)
            last = new

    def _mark(self, item: str, run: list[int]) -> None:
        state = 0
        for i, word in enumerate(run):
            state = self.next[state][word]
            if i + 1 >= self.window:
                s = state
                while self.length[self.link[s]] >= self.window:
                    s = self.link[s]
                self.windows[s].add(item)
        if len(run) < self.window:
            self.short[state].append((len(run), item))

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Maximal runs of hit words as (first, last + 1), and the items that occur."""
        runs: list[tuple[int, int]] = []
        items: set[str] = set()
        nexts, links, lengths, window = self.next, self.link, self.length, self.window
        state = long = 0
        for i, word in enumerate(map(self.vocab.get, words)):
            if word is None:
                state = long = 0
                continue
            while state and word not in nexts[state]:
                state = links[state]
                long = lengths[state]
            if word not in nexts[state]:
                continue
            state, long = nexts[state][word], long + 1
            hit = 0
            if long >= window:
                hit = window
                items |= self.windows[self.holder[state]]
            for n, item in self.short[state]:
                if n > long:
                    break
                hit = max(hit, n)
                items.add(item)
            if hit:
                first = i + 1 - hit
                while runs and runs[-1][1] >= first:
                    first = min(first, runs.pop()[0])
                runs.append((first, i + 1))
        return runs, items


class Items:
    """A benchmark in a written table, dealt into parts of about ``part_bytes`` of text.

    The driver reads one part at a time, and tasks hold the automaton of one part at a time.
    Items of equal id and text meet in one part; a null text has no words and is left out, a null id is ``None``.
    """

    def __init__(self, benchmark: DataFrame, item_id: str, text: str, part_bytes: int):
        rows = benchmark.select(F.col(item_id).cast("string").alias("item"), F.col(text).alias("text"))
        rows = staged(rows.filter(F.col("text").isNotNull()).withColumn("hash", F.xxhash64("item", "text")), "items")
        size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        self.rows, self.parts = rows, max(1, -(-size // part_bytes))

    def __len__(self) -> int:
        return self.parts

    def __iter__(self) -> Iterator[list[tuple[str, str]]]:
        for part in range(self.parts):
            own = self.rows.filter(F.pmod("hash", F.lit(self.parts)) == part).orderBy("hash", "item", "text")
            yield [(str(row.item), row.text) for row in own.collect()]


def load_items(
    benchmark: DataFrame, item_id: str = "item_id", text: str = "text", part_bytes: int = PART_BYTES
) -> Items:
    """The benchmark as parts to look for one after the other; see ``Items``."""
    return Items(benchmark, item_id, text, part_bytes)


def _join(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for first, end in sorted(runs):
        if out and first <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((first, end))
    return out


# What is known of a text: its words, the runs hit so far, the items found so far.
Known = tuple[list[bytes], list[tuple[int, int]], set[str]]


def _scanned(
    df: DataFrame, items: Items | list, text: str, window: int, fields: str, finish: Callable[[str | None, Known], tuple]
) -> DataFrame:
    """``df`` with ``fields``, which ``finish`` makes from each text and what was found in it.

    The whole table is passed once per part of the items, without a shuffle; between passes rows are
    written with what was found so far, and superseded tables are removed.
    """
    runs_so_far, items_so_far = unused(df, "runs_so_far"), unused(df, "items_so_far")
    progress = f"{runs_so_far} array<struct<first: int, end: int>>, {items_so_far} array<string>"
    many = max(len(items), 1)

    def maker(part: list, later: bool, last: bool):
        names = T.StructType.fromDDL(fields if last else progress).names

        def start():
            automaton = Automaton(part, window)

            def compute(batch):
                texts = texts_of(batch, text)
                before = zip(texts_of(batch, runs_so_far), texts_of(batch, items_so_far)) if later else repeat(((), ()))
                made = []
                for t, (hit, found) in zip(texts, before):
                    words = words_of(t)
                    runs, ids = automaton.scan(words)
                    runs = _join([*runs, *((r["first"], r["end"]) for r in hit)])
                    ids.update(found)
                    made.append(finish(t, (words, runs, ids)) if last else (_as_rows(runs), sorted(ids)))
                return dict(zip(names, map(list, zip(*made)))) if made else {n: [] for n in names}

            return compute

        return start

    rows, written = df, None
    for i, part in enumerate(items if len(items) else [[]]):
        last = i == many - 1
        rows = add_columns(rows, fields if last else progress, maker(part, i > 0, last))
        if not last:
            rows = staged(rows, "benchmark-part")
            if written is not None:
                release(written)
            written = rows
    return rows.drop(runs_so_far, items_so_far) if many > 1 else rows


def _as_rows(runs: list[tuple[int, int]]) -> list[dict[str, int]]:
    return [{"first": first, "end": end} for first, end in runs]


def find_contamination(df: DataFrame, items: Items | list, text: str = "text", window: int = WINDOW) -> DataFrame:
    """``df`` with what each whole text shares with benchmark items; no shuffle.

    ``n_words``, ``n_hit``, ``hit_runs`` (runs of hit words, end exclusive), ``items`` (ids of the
    items with occurring windows, sorted as text). A window is ``window`` consecutive words
    of an item, or a shorter item whole. Null texts have no words. Columns of these names are replaced.
    ``items``: as from ``load_items``, or lists of (id, text).
    """

    def finish(t: str | None, known: Known) -> tuple:
        words, runs, ids = known
        return len(words), sum(end - first for first, end in runs), _as_rows(runs), sorted(ids)

    fields = "n_words bigint, n_hit bigint, hit_runs array<struct<first: int, end: int>>, items array<string>"
    return _scanned(df, items, text, window, fields, finish)


def with_digest(found: DataFrame) -> DataFrame:
    """``n_items``, ``items_sha256`` and ``contaminated`` from the columns of ``find_contamination``."""
    return found.withColumns(
        {
            "n_items": F.size("items").cast("bigint"),
            "items_sha256": F.sha2(F.array_join("items", ","), 256),
            "contaminated": F.col("n_hit") > 0,
        }
    )


def remove_contamination(
    df: DataFrame, items: Items | list, text: str = "text", window: int = WINDOW, most: float = 0.5
) -> DataFrame:
    """``df`` without benchmark passages: a hit run goes with all between its words; a text
    of which more than the part ``most`` is hit goes whole. Other rows are unchanged."""

    def finish(t: str | None, known: Known) -> tuple:
        words, runs, _ = known
        if not runs:
            return t, True
        if sum(end - first for first, end in runs) > most * len(words):
            return None, False
        data = t.encode("utf-8")
        places = [m.span() for m in WORD.finditer(data.lower())]
        parts, at = [], 0
        for first, end in runs:
            parts.append(data[at : places[first][0]])
            at = places[end - 1][1]
        return b"".join([*parts, data[at:]]).decode("utf-8"), True

    clean, keep = unused(df, "clean"), unused(df, "keep")
    made = _scanned(df, items, text, window, f"{clean} string, {keep} boolean", finish).filter(F.col(keep))
    return made.withColumn(text, F.col(clean)).select(df.columns)
