"""Language by rank-order profiles of letter n-grams.

A profile is the list of a language's most frequent n-grams of 1 to 3 letters, words
padded with a blank. A document is compared by the out-of-place distance: for each of
its own most frequent n-grams, how far its rank is from the rank in the profile, or the
most there can be if it is not there. The nearest profile wins.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsloom.llm.common import add_columns, slices, texts_of, tidy

RANKS = 300
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
# Characters that are worked through together when n-grams are counted.
TOGETHER = 1 << 18


@functools.cache
def _letters() -> np.ndarray:
    """Whether a character of the basic plane belongs to a word."""
    return np.array([LETTER.match(chr(c)) is not None for c in range(0x10000)])


def gram_codes(text: str) -> np.ndarray:
    """The 1- to 3-grams of the words of a text, each word padded with a blank, as sorted numbers.

    A number holds three characters of 21 bits, one up, so that numbers sort as strings do.
    """
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[np.minimum(points, 0xFFFF)]
    for i in np.flatnonzero(points > 0xFFFF):
        letter[i] = LETTER.match(chr(points[i])) is not None
    # Words with one blank between them, and one at both ends.
    after = np.r_[False, letter[:-1]] if len(letter) else letter
    shown = np.where(letter, points, ord(" "))[letter | after]
    if not len(shown):
        return np.zeros(0, np.uint64)
    row = np.concatenate([[ord(" ")], shown, [ord(" ")] if shown[-1] != ord(" ") else []]).astype(np.uint64) + np.uint64(1)
    blank = row == np.uint64(ord(" ") + 1)
    first = row << np.uint64(42)
    two = first[:-1] | row[1:] << np.uint64(21)
    three = two[:-1] | row[2:]
    # A blank is no n-gram of its own, and no n-gram reaches from one word into the next.
    return np.sort(np.concatenate([first[~blank], two, three[~blank[1:-1]]]))


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct numbers of a sorted array, and how often each occurs."""
    starts = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]]) if len(codes) else np.zeros(0, np.int64)
    return codes[starts], np.diff(np.r_[starts, len(codes)])


def to_code(gram: str) -> int:
    return sum((ord(c) + 1) << shift for c, shift in zip(gram, (42, 21, 0)))


def to_gram(code: int) -> str:
    parts = (code >> 42, code >> 21 & 0x1FFFFF, code & 0x1FFFFF)
    return "".join(chr(p - 1) for p in parts if p)


def gram_counts(df: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``lang``, ``gram``, ``n`` over all texts. What is shuffled are the sums of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = {}
        size: dict[str, int] = {}
        sums: dict[str, tuple[np.ndarray, np.ndarray]] = {}

        def fold(name: str) -> None:
            codes, n = counted(gram_codes("\n".join(held.pop(name))))
            size[name] = 0
            known, before = sums.get(name, (codes[:0], n[:0]))
            both, place = np.unique(np.concatenate([known, codes]), return_inverse=True)
            sums[name] = both, np.bincount(place, weights=np.concatenate([before, n]), minlength=len(both)).astype(np.int64)

        for part in (p for batch in batches for p in slices(batch)):
            for name, value in zip(texts_of(part, "lang"), texts_of(part, "text")):
                if value:
                    held.setdefault(name, []).append(value)
                    size[name] = size.get(name, 0) + len(value)
                    if size[name] > TOGETHER:
                        fold(name)
        for name in list(held):
            fold(name)
        for name, (codes, n) in sums.items():
            grams = [to_gram(c) for c in codes.tolist()]
            columns = [pa.array([name] * len(grams), pa.string()), pa.array(grams, pa.string()), pa.array(n, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "gram", "n"])

    found = df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(
        tidy(run), "lang string, gram string, n bigint"
    )
    return found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def learn_profiles(df: DataFrame, text: str = "text", lang: str = "lang", ranks: int = RANKS) -> dict[str, list[str]]:
    """The ``ranks`` most frequent n-grams of each language, ties by n-gram, from all rows
    with a language; rows without one are left out. What comes to the driver is ``ranks``
    strings per language, however many rows there are."""
    counts = gram_counts(df.filter(F.col(lang).isNotNull()), text, lang)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    best = counts.withColumn("place", place).filter(F.col("place") <= ranks)
    profiles: dict[str, list[str]] = {}
    for row in sorted(best.collect(), key=lambda r: (r.lang, r.place)):
        profiles.setdefault(row.lang, []).append(row.gram)
    return profiles


class Judge:
    """Compares texts with profiles."""

    def __init__(self, profiles: dict[str, list[str]], ranks: int = RANKS):
        self.ranks = ranks
        self.names = sorted(profiles)
        places = [{to_code(g): i for i, g in enumerate(profiles[n])} for n in self.names]
        self.codes = np.array(sorted({c for p in places for c in p}), np.uint64)
        # The last row is for n-grams that are in no profile.
        self.place = np.array(
            [[p.get(c, ranks) for p in places] for c in self.codes.tolist()] + [[ranks] * len(places)], np.int64
        ).reshape(len(self.codes) + 1, len(places))

    def judge(self, text: str | None) -> tuple[str, float]:
        """Language and score: 1 minus the distance as a part of the greatest possible one."""
        # Signs such as a superscript two are in words, but are no letters.
        if not self.names or not text or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        codes, n = counted(gram_codes(text))
        if len(codes) > self.ranks:
            least = np.partition(n, len(n) - self.ranks)[len(n) - self.ranks]
            codes, n = codes[n >= least], n[n >= least]
        # By count; n-grams of equal counts stay in their order.
        own = codes[np.argsort(-n, kind="stable")][: self.ranks]
        at = np.searchsorted(self.codes, own)
        at[self.codes[np.minimum(at, len(self.codes) - 1)] != own] = len(self.codes)
        place = self.place[at]
        apart = np.where(place == self.ranks, self.ranks, np.abs(place - np.arange(len(own))[:, None])).sum(axis=0)
        nearest = int(np.argmin(apart))  # the first name among equals
        return self.names[nearest], 1.0 - float(apart[nearest]) / (self.ranks * len(own))


def predict_language(df: DataFrame, profiles: dict[str, list[str]], text: str = "text", ranks: int = RANKS) -> DataFrame:
    """``df`` with ``lang_pred`` and ``score`` (0 to 1) of each whole text; no shuffle.

    A text that is null or has no letters is ``und`` with score 0, as is every text when
    there are no profiles. Ties go to the first language by name. Columns of these names are replaced.
    """

    def maker():
        judge = Judge(profiles, ranks)

        def compute(batch):
            both = [judge.judge(t) for t in texts_of(batch, text)]
            return {"lang_pred": [b[0] for b in both], "score": [b[1] for b in both]}

        return compute

    return add_columns(df, "lang_pred string, score double", maker)


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, mod 3, is 1.
    A null id counts as empty text and so takes part in learning."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 3 == 1
