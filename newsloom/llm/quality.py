"""Quality by regularised quadratic discriminant analysis of document statistics.

Each text becomes a few statistics (shares of kinds of characters, lengths, repetition),
transformed so that they are nearer to normal and rounded to fixed point. Each class has
its mean and covariance from exact sums over all labelled rows. A covariance is shrunk
twice: towards the one pooled over the classes, then towards a diagonal. A score is the difference
of the log densities: Mahalanobis distances through Cholesky factors, which are computed once.
"""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import add_columns

STATISTICS = """
log_words log_bytes_per_word upper digits exclamation bars signs stops other_ascii
variety most_frequent repeated_next repeated_lines words_per_line words_per_sentence capitalised
""".split()
# Statistics are kept as whole multiples of 1 / SCALE, so that sums are exact in any order.
SCALE = 256
# Parts of a class covariance that come from the pooled one, and of the result that come from a diagonal.
POOLED, DIAGONAL = 0.5, 0.1
# A statistic varies by this much at least.
LEAST_VARIANCE = 1e-3
THRESHOLD = 0.3
# Bytes of a text that are cut into words at a time.
PIECE = 1 << 20

_LINE = re.compile(rb"[^\n]+")


def _pieces(data: bytes):
    """A text in pieces that end at a blank or line end."""
    start = 0
    while start < len(data):
        end = len(data)
        if end - start > PIECE:
            places = [p for p in (data.find(b" ", start + PIECE), data.find(b"\n", start + PIECE)) if p >= 0]
            end = min(places, default=end)
        yield data[start:end]
        start = end


def statistics(data: bytes) -> list[int]:
    """The statistics of one text in UTF-8, in units of 1 / ``SCALE``; an empty text has its own place, all zero."""
    n_words = capitals = repeated = 0
    characters = np.zeros(256, np.int64)
    words_seen: Counter = Counter()
    last = b""
    for piece in _pieces(data):
        characters += np.bincount(np.frombuffer(piece, np.uint8), minlength=256)
        words = piece.split()
        if not words:
            continue
        n_words += len(words)
        repeated += sum(map(operator.eq, words, words[1:])) + (words[0] == last)
        last = words[-1]
        words_seen.update(words)
    if not n_words:
        return [0] * len(STATISTICS)
    capitals = sum(n for w, n in words_seen.items() if 0x41 <= w[0] <= 0x5A)
    lines = Counter(hash(m.group()) for m in _LINE.finditer(data))
    n_lines = sum(lines.values())
    size = len(data)

    def number(signs: bytes) -> int:
        return int(characters[list(signs)].sum())

    upper, lower = int(characters[0x41:0x5B].sum()), int(characters[0x61:0x7B].sum())
    digits = int(characters[0x30:0x3A].sum())
    stops, exclamation, bars, signs = number(b".,;:?"), number(b"!"), number(b"|"), number(b"#$%&*")
    letters = upper + lower + int(characters[0x80:].sum())
    blank = number(b" \n\t\r")
    other = size - letters - digits - blank - stops - exclamation - bars - signs
    values = [
        math.log1p(n_words),
        math.log((size - blank) / n_words),
        math.sqrt(upper / max(letters, 1)),
        math.sqrt(digits / size),
        math.sqrt(exclamation / n_words),
        math.sqrt(bars / n_words),
        math.sqrt(signs / n_words),
        math.sqrt(stops / n_words),
        math.sqrt(max(other, 0) / size),
        math.log(len(words_seen)) / math.log(n_words) if n_words > 1 else 1.0,
        math.sqrt(max(words_seen.values()) / n_words),
        math.sqrt(repeated / n_words),
        math.sqrt(1 - len(lines) / n_lines),
        math.log1p(n_words / n_lines),
        math.log1p(n_words / (1 + number(b".!?"))),
        math.sqrt(capitals / n_words),
    ]
    return [math.floor(v * SCALE + 0.5) for v in values]


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from learning: crc32 of its id as text, mod 5, is 0.
    A null id counts as empty text, which is 0 too."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit(""))) % 5 == 0


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` without its text, with ``stats``; no shuffle. Null texts count as empty."""

    def maker():
        def compute(batch):
            column = batch.column(batch.schema.get_field_index("_bytes"))
            return {"stats": [statistics(v.as_py() or b"") for v in column]}

        return compute

    rows = df.withColumn("_bytes", F.col(text).cast("binary")).drop(text)
    return add_columns(rows, "stats array<int>", maker).drop("_bytes")


def class_sums(labelled: DataFrame, label: str = "quality") -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """For each class its number of rows, sums and sums of products of the statistics: a few hundred
    whole numbers per class reach the driver, however many rows there are."""
    size = len(STATISTICS)
    pairs = list(combinations_with_replacement(range(size), 2))

    def of(i: int) -> Column:
        return F.col("stats")[i].cast("bigint")

    rows = labelled.filter(F.col(label).isin(0, 1)).groupBy(F.col(label).cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.sum(of(i)).alias(f"s{i}") for i in range(size)],
        *[F.sum(of(i) * of(j)).alias(f"p{i}_{j}") for i, j in pairs],
    )
    found = []
    for row in sorted(rows.collect(), key=lambda r: r.label):
        products = np.zeros((size, size))
        for i, j in pairs:
            products[i, j] = products[j, i] = row[f"p{i}_{j}"]
        found.append((row.label, row.n, np.array([float(row[f"s{i}"]) for i in range(size)]), products))
    return found


class Discriminant:
    """Two normal densities with shrunk covariances."""

    def __init__(self, sums: list[tuple[int, int, np.ndarray, np.ndarray]], pooled: float = POOLED, diagonal: float = DIAGONAL):
        counts = {label: n for label, n, _, _ in sums}
        # One row is added to each class, so a class without rows has a share as well.
        self.prior = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
        self.factors: list[tuple[np.ndarray, np.ndarray, float]] = []
        if len(sums) < 2:
            return
        means = [s / n for _, n, s, _ in sums]
        scatters = [p - np.outer(s, s) / n for _, n, s, p in sums]
        total = sum(n for _, n, _, _ in sums)
        unit = SCALE * SCALE
        shared = sum(scatters) / total / unit
        for (_, n, _, _), mean, scatter in zip(sums, means, scatters):
            own = (1 - pooled) * scatter / n / unit + pooled * shared
            own = (1 - diagonal) * own + diagonal * np.diag(np.diag(own)) + LEAST_VARIANCE * np.eye(len(own))
            lower = np.linalg.cholesky(own)
            self.factors.append((mean / SCALE, np.linalg.inv(lower), 2 * float(np.log(np.diag(lower)).sum())))

    def scores(self, stats: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of statistics; the share of label 1 if a class had no rows."""
        if not self.factors:
            return np.full(len(stats), round(self.prior, 9))
        x = stats / SCALE
        bad, good = (((x - mean) @ inverse.T) ** 2 @ np.ones(x.shape[1]) + log for mean, inverse, log in self.factors)
        odds = (bad - good) / 2 + math.log(self.prior / (1 - self.prior))
        return np.round(1 / (1 + np.exp(-np.clip(odds, -700, 700))), 9)


def learn_quality(rows: DataFrame, labels: DataFrame, doc_id: str = "doc_id", label: str = "quality") -> Discriminant:
    """The discriminant from all ``rows`` (``doc_id``, ``stats``) that ``labels`` marks.

    Labels other than 0 and 1 and null labels teach nothing; equal label rows count once, and
    an id with both labels teaches both. Without labels every score is the share of label 1, one half.
    """
    marks = labels.select(doc_id, label).filter(F.col(label).isin(0, 1)).distinct()
    return Discriminant(class_sums(rows.select(doc_id, "stats").join(marks, doc_id)))


def predict_quality(rows: DataFrame, model: Discriminant) -> DataFrame:
    """``rows`` with ``score`` and ``predicted`` instead of ``stats``; no shuffle."""

    def maker():
        def compute(batch):
            column = batch.column(batch.schema.get_field_index("stats"))
            stats = column.flatten().to_numpy().reshape(len(column), -1)
            scores = model.scores(stats)
            return {"score": scores, "predicted": (scores >= THRESHOLD).astype(np.int32)}

        return compute

    return add_columns(rows, "score double, predicted int", maker).drop("stats")
