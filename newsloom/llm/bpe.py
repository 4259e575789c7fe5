"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding.

A merge at one place can depend on what stands to its right, but only through a
chain of overlapping tokens whose ranks fall strictly towards the right: a token is
undone by an earlier merge that took part of it, which was itself undone by a still
earlier one, and so on. ``lookahead`` follows all such chains of a merge list and gives
the number of symbols after which a token cannot change any more. The transducer
keeps a window of that length, emits every token that ends before it and drops its
symbols, so memory stays constant however long a run without breaks is.

Why restarting at an emitted boundary is right: no merge crosses a boundary of the
final result, so both sides merge independently of each other.
"""

from __future__ import annotations

import codecs
import functools
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain, islice

from pyspark.sql import DataFrame

from newsloom.llm.common import Maker, add_columns, sha256, texts_of

# Words whose tokens a task remembers, twice: the newest, and those before them.
REMEMBERED = 1 << 16
# Characters of a text that are cut into words at a time.
PIECE = 1 << 16
NEVER = 1 << 60
# Runs of more symbols are merged with a heap; a window takes in so many beyond the lookahead.
SHORT = 48
STEP = 4096


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies:
    itself where it is printable, else the next letter from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


def lookahead(parts: Iterable[tuple[str, ...]]) -> int:
    """Symbols beyond a token's end that can still change it.

    ``parts``: the symbols of each merged token, in the order of the merges. For a
    token, ``reach`` is how far behind its end a chain of overlapping, strictly earlier
    tokens can lead. The next one in the chain begins within the token, so that it starts
    with an end of it (``heads``), or holds it whole (``inner``); both tables give how far
    earlier tokens lead behind the piece they share.
    """
    heads: dict[tuple[str, ...], int] = {}
    inner: dict[tuple[str, ...], int] = {}
    most = 0
    for token in parts:
        n = len(token)
        reach = max([inner.get(token, 0), *(heads.get(token[i:], 0) for i in range(1, n))])
        most = max(most, n + reach)
        for end in range(1, n):
            heads[token[:end]] = max(heads.get(token[:end], 0), n - end + reach)
            for start in range(end):
                piece = token[start:end]
                inner[piece] = max(inner.get(piece, 0), n - end + reach)
    return most


# White space that is not a separator by category.
BLANKS = "\t\n\v\f\r\x85"


# Letters and numbers of Unicode 16, and capitals of Unicode 16 and 17 with the
# first of their small letters, which Python's own tables do not have yet.
NEWER = {
    "L": """1c89-1c8a a7cb-a7cd a7da-a7dc 105c0-105f3 10d4a-10d65 10d6f-10d85 10ec2-10ec4 11380-11389
         1138b-1138b 1138e-1138e 11390-113b5 113b7-113b7 113d1-113d1 113d3-113d3 11bc0-11be0 13460-143fa
         16100-1611d 16d40-16d6c 18cff-18cff 1e5d0-1e5ed 1e5f0-1e5f0""",
    "N": "10d40-10d49 116d0-116e3 11bf0-11bf9 16130-16139 16d70-16d79 1ccf0-1ccf9 1e5f1-1e5fa",
    "Z": "",
}
NEWER_CAPITALS = """1c89-1c89:1c8a a7cb-a7cb:264 a7cc-a7cc:a7cd a7ce-a7ce:a7cf a7d2-a7d2:a7d3 a7d4-a7d4:a7d5
    a7da-a7da:a7db a7dc-a7dc:19b 10d50-10d65:10d70 16ea0-16eb8:16ebb"""


def _span(text: str) -> range:
    first, last = (int(x, 16) for x in text.split("-"))
    return range(first, last + 1)


SMALL = {
    c: int(small, 16) + i
    for item in NEWER_CAPITALS.split()
    for span, small in [item.split(":")]
    for i, c in enumerate(_span(span))
} | {ord("Σ"): "σ"}


@functools.cache
def _ranges(category: str, most: int, more: str = "") -> str:
    """The inside of a character class: all characters of a general category up to ``most``, and ``more``."""
    newer = {c for span in NEWER[category].split() for c in _span(span)}
    own = [
        c for c in range(most + 1)
        if unicodedata.category(chr(c))[0] == category or chr(c) in more or c in newer
    ]
    starts = [c for i, c in enumerate(own) if i == 0 or own[i - 1] != c - 1]
    ends = [c for i, c in enumerate(own) if i + 1 == len(own) or own[i + 1] != c + 1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(starts, ends))


def _spelled_out(pattern: str, most: int) -> str:
    """A pattern with its character properties written as ranges."""
    for escape, inside in (
        (r"\p{L}", _ranges("L", most)), (r"\p{N}", _ranges("N", most)), (r"\s", _ranges("Z", most, BLANKS))
    ):
        pattern = pattern.replace(f"[{escape}]", f"[{inside}]").replace(escape, inside)
    return pattern


class WordBpe:
    """Encoder and decoder for a tokenizer file with word ends, read from its JSON text.

    Built for files whose normalizer is NFC, one blank for white space, lower case;
    whose words are cut by a pattern and mapped to byte letters; with a suffix on the
    last symbol of a word, and special tokens taken literally.
    """

    def __init__(self, spec: dict):
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.special.items()}
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[int] = []
        symbols = {i: self._symbols(t) for t, i in self.vocab.items()}
        made = []
        for rank, (a, b) in enumerate(model["merges"]):
            self.rank[self.vocab[a], self.vocab[b]] = rank
            self.made.append(self.vocab[a + b])
            made.append(symbols[self.vocab[a]] + symbols[self.vocab[b]])
        self.lookahead = lookahead(made)
        letters = byte_letters()
        self.bytes = {c: b for b, c in enumerate(letters)}
        self.within = [self.vocab[c] for c in letters]
        self.last = [self.vocab[c + self.suffix] for c in letters]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        # Character classes within the basic plane are much faster than those beyond it.
        self.words = [re.compile(_spelled_out(pattern, most)) for most in (0x7F, 0xFFFF, sys.maxunicode)]
        self.astral = re.compile("[\U00010000-\U0010ffff]")
        self.capitals = [chr(c) for c in SMALL if c <= 0xFFFF]
        self.marks = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        self.spelled: dict[int, tuple[bytes | None, str]] = {}
        self.new: dict[str, Iterable[int]] = {}
        self.old: dict[str, Iterable[int]] = {}

    def forget(self) -> None:
        """Drop the remembered words."""
        self.new, self.old = {}, {}

    def _symbols(self, token: str) -> tuple[str, ...]:
        if token.endswith(self.suffix) and len(token) > len(self.suffix):
            stem = token[: -len(self.suffix)]
            return (*stem[:-1], stem[-1] + self.suffix)
        return tuple(token)

    def _merge(self, ids: list[int]) -> list[int]:
        """Apply merges, the lowest rank first and the leftmost among equals."""
        if len(ids) > SHORT:
            return self._merge_long(ids)
        rank = self.rank
        ranks = [rank.get(pair, NEVER) for pair in zip(ids, ids[1:])]
        while ranks:
            low = min(ranks)
            if low == NEVER:
                break
            i = ranks.index(low)
            ids[i] = self.made[low]
            del ids[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get((ids[i], ids[i + 1]), NEVER)
            if i:
                ranks[i - 1] = rank.get((ids[i - 1], ids[i]), NEVER)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap of pairs and links between neighbours."""
        rank, n = self.rank, len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(rank[p], i, *p) for i, p in enumerate(zip(ids, ids[1:])) if p in rank]
        heapq.heapify(heap)
        while heap:
            low, i, a, b = heapq.heappop(heap)
            j = after[i] if ids[i] == a else -1
            if j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = self.made[low], -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for left in (before[i], i):
                pair = (ids[left], ids[after[left]]) if left >= 0 and after[left] >= 0 else None
                if pair in rank:
                    heapq.heappush(heap, (rank[pair], left, *pair))
        return [i for i in ids if i >= 0]

    def stream(self, symbols: Iterator[int], width: dict[int, int] | None = None) -> Iterator[int]:
        """Tokens of a run of symbol ids, each as soon as it is stable."""
        width = width if width is not None else self.widths()
        window: list[int] = []
        for symbol in symbols:
            window.append(symbol)
            if len(window) >= STEP + self.lookahead:
                stable, done = len(window) - self.lookahead, 0
                for token in self._merge(window[:]):
                    if done + width[token] > stable:
                        break
                    done += width[token]
                    yield token
                del window[:done]
        yield from self._merge(window)

    def widths(self) -> dict[int, int]:
        return {i: len(self._symbols(t)) for t, i in self.vocab.items()}

    def _word(self, word: str) -> list[int]:
        data = word.encode("utf-8")
        symbols = [self.within[b] for b in data]
        symbols[-1] = self.last[data[-1]]
        if len(symbols) < STEP + self.lookahead:
            return self._merge(symbols)
        return list(self.stream(iter(symbols)))

    def normalize(self, text: str) -> str:
        """NFC and lower case. White space separates words and is dropped, however it is written."""
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if any(map(text.__contains__, self.capitals)) or self.astral.search(text):
                # Lower case letter by letter: a capital sigma has no final form here.
                text = text.translate(SMALL)
        return text.lower()

    def _plain(self, text: str) -> Iterator[list[int]]:
        """Ids of a text without marks, a piece at a time. Pieces end at blanks, which no word crosses
        and nothing is composed with."""
        start = 0
        while start < len(text):
            end = len(text)
            if end - start > PIECE:
                places = [p for p in (text.find(c, start + PIECE) for c in " \n") if p >= 0]
                end = min(places, default=end)
            yield self._piece(text[start:end])
            start = end

    def _piece(self, text: str) -> list[int]:
        out: list[int] = []
        text = self.normalize(text)
        plane = 0 if text.isascii() else 2 if self.astral.search(text) else 1
        for word in self.words[plane].findall(text):
            ids = self.new.get(word)
            if ids is None:
                ids = self.old.get(word)
                if ids is None:
                    ids = self._word(word)
                if len(word) < 64:
                    if len(self.new) >= REMEMBERED:
                        self.old, self.new = self.new, {}
                    self.new[word] = ids
            out += ids
        return out

    def stream_text(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, a piece at a time; nothing but the text itself grows with its length."""
        at = 0
        for mark in self.marks.finditer(text):
            yield from self._plain(text[at : mark.start()])
            yield [self.special[mark.group()]]
            at = mark.end()
        yield from self._plain(text[at:] if at else text)

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return list(chain.from_iterable(self.stream_text(text)))

    def decode_tokens(self, ids: Iterable[int]) -> str:
        """Tokens as they are spelled, blank between them: what a file without a decoder gives."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])

    def decode(self, ids: Iterable[int]) -> Iterator[str]:
        """Readable text, piece by piece: letters back to bytes, bytes to text.

        A state machine holds the bytes of a character that is not complete yet;
        malformed bytes give U+FFFD. A word end gives a blank.
        """
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        spelled = self.spelled
        for i in ids:
            if i not in spelled:
                spelled[i] = self._spelling(i)
            stem, behind = spelled[i]
            if stem is None:
                yield machine.decode(b"", True) + behind
                machine.reset()
            else:
                yield machine.decode(stem) + behind
        yield machine.decode(b"", True)

    def _spelling(self, i: int) -> tuple[bytes | None, str]:
        """The bytes of a token and what follows them; of a special token no bytes, and its text."""
        token = self.tokens[i]
        if i in self.special.values():
            return None, token
        ended = token.endswith(self.suffix)
        stem = token[: -len(self.suffix)] if ended else token
        return bytes(self.bytes[c] for c in stem), " " if ended else ""


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """The tokenizer of a file, once per process, without words remembered by earlier tasks."""
    if path not in _LOADED:
        with open(path, encoding="utf-8") as file:
            _LOADED[path] = WordBpe(json.load(file))
    _LOADED[path].forget()
    return _LOADED[path]


def encode_texts(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` (array of int) of each whole text. ``path`` names the
    tokenizer file where the executors find it. A null or empty text has no ids.
    A column named ``ids`` is replaced. No shuffle; rows are independent."""

    def maker():
        bpe = load(path)
        return lambda batch: {"ids": [bpe.encode(t or "") for t in texts_of(batch, text)]}

    return add_columns(df, "ids array<int>", maker)


def encode_and_decode(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """``df`` with ``ids`` of each whole text and ``decoded_sha256``, the digest of the readable text that
    the decoder makes of them again, in UTF-8. Null counts as empty. Columns of these names are replaced."""

    def maker():
        import numpy as np

        bpe = load(path)

        def compute(batch):
            made, digests = [], []
            for t in texts_of(batch, text):
                ids, digest = [], hashlib.sha256()

                def taken(t=t, ids=ids):
                    for part in bpe.stream_text(t or ""):
                        ids.append(np.array(part, np.int32))
                        yield from part

                pieces = bpe.decode(taken())
                while some := list(islice(pieces, 4096)):
                    digest.update("".join(some).encode("utf-8"))
                made.append(np.concatenate(ids) if ids else np.zeros(0, np.int32))
                digests.append(digest.hexdigest())
            return {"ids": made, "decoded_sha256": digests}

        return compute

    return add_columns(df, "ids array<int>, decoded_sha256 string", maker)


def decode_ids(df: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``df`` with ``decoded``: readable text of token ids; null ids give an empty text."""

    def maker():
        bpe = load(path)
        return lambda batch: {"decoded": ["".join(bpe.decode(i or [])) for i in texts_of(batch, ids)]}

    return add_columns(df, "decoded string", maker)


def token_digests(df: DataFrame, path: str, text: str = "text") -> DataFrame:
    """Encode and decode again, and keep counts and digests: ``n_tokens``,
    ``ids_sha256`` (ids as little-endian unsigned 32-bit), ``decoded_sha256``."""
    return add_columns(df, "n_tokens bigint, ids_sha256 string, decoded_sha256 string", _digests(path, text))


def _digests(path: str, text: str) -> Maker:
    def maker():
        import numpy as np

        bpe = load(path)

        def compute(batch):
            n, ids_sha, text_sha = [], [], []
            for t in texts_of(batch, text):
                ids = bpe.encode(t or "")
                n.append(len(ids))
                ids_sha.append(sha256(np.array(ids, "<u4").tobytes()))
                text_sha.append(sha256(bpe.decode_tokens(ids).encode("utf-8")))
            return {"n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha}

        return compute

    return maker
