"""Finding secrets: a keyword automaton, anchored patterns at its hits, checksums.

One Aho-Corasick pass over the lower-cased text finds every keyword; only there is a
pattern tried, anchored at the keyword. Plain hexadecimal runs have no keyword, so their
pattern runs over the whole text. Tokens that embed a checksum are reported only when it
is right.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsloom.llm.common import add_columns, sha256, texts_of, unused

KINDS = ("assign", "access", "hex", "checked")
# The published forms of secrets and the least length of each.
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LENGTH, ACCESS_LENGTH = 6, 20
# Tokens of 30 base-62 digits and their CRC-32 in 6 more.
CHECKED_PREFIXES = ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "npm_")
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

Span = tuple[int, int, int]  # start, kind, end


def checksum(body: str) -> str:
    value, digits = zlib.crc32(body.encode("ascii")), ""
    for _ in range(6):
        value, digit = divmod(value, 62)
        digits = BASE62[digit] + digits
    return digits


def _automaton() -> ahocorasick.Automaton:
    words = ahocorasick.Automaton()
    for kind, keys in ((0, ASSIGN_WORDS), (1, ("akia",)), (3, CHECKED_PREFIXES)):
        for key in keys:
            words.add_word(key, (kind, len(key)))
    words.make_automaton()
    return words


def _lower(text: str) -> str:
    """Lower case with every character in its place."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if c < "\x80" else c for c in text)


def finder() -> Callable[[str], list[Span]]:
    """A function from a text to its spans, by start and then kind."""
    words = _automaton()

    def near(text: str) -> list[Span]:
        spans = []
        hits = sorted((end + 1 - n, kind) for end, (kind, n) in words.iter(_lower(text)))
        free = [0, 0, 0, 0]  # where the next match of a kind may start
        for start, kind in hits:
            if start < free[kind]:
                continue
            match = (ASSIGN, ACCESS, None, CHECKED)[kind].match(text, start)
            if match is None:
                continue
            free[kind] = match.end()
            right = (
                len(match[2]) >= ASSIGN_LENGTH if kind == 0
                else match.end() - start >= ACCESS_LENGTH if kind == 1
                else checksum(match[1]) == match[2]
            )
            if right:
                spans.append((start, kind, match.end()))
        return spans

    def find(text: str) -> list[Span]:
        spans = near(text)
        spans += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
        return sorted(spans)

    return find


def written(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in spans)


def scan_secrets(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` with the secrets of each whole text; no shuffle.

    ``n_assign``, ``n_access``, ``n_hex``: matches of the base kinds; ``base_sha256``: digest
    of their spans; ``spans``: all spans as ``kind:start:end`` in code points, by start and
    then kind. A null text is taken as empty: no spans. Columns of these names are replaced.
    """

    def maker():
        find = finder()

        def compute(batch):
            out: dict[str, list] = {k: [] for k in ("n_assign", "n_access", "n_hex", "base_sha256", "spans")}
            for t in texts_of(batch, text):
                spans = find(t or "")
                base = [s for s in spans if s[1] < 3]
                for kind, name in enumerate(("n_assign", "n_access", "n_hex")):
                    out[name].append(sum(s[1] == kind for s in base))
                out["base_sha256"].append(sha256(written(base).encode("ascii")))
                out["spans"].append(written(spans))
            return out

        return compute

    return add_columns(
        df, "n_assign bigint, n_access bigint, n_hex bigint, base_sha256 string, spans string", maker
    )


def redact(df: DataFrame, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``df`` with every span of a secret in ``text`` replaced by ``mark``; overlapping
    spans by one. A null text stays null; a text without secrets is unchanged."""

    def maker():
        find = finder()

        def clean(t: str | None) -> str | None:
            if t is None:
                return None
            parts, at = [], 0
            for start, _, end in find(t):
                if start >= at:
                    parts += [t[at:start], mark]
                at = max(at, end)
            return "".join([*parts, t[at:]]) if parts else t

        return lambda batch: {made: [clean(t) for t in texts_of(batch, text)]}

    made = unused(df, "clean")
    return add_columns(df, f"{made} string", maker).withColumn(text, F.col(made)).select(df.columns)

