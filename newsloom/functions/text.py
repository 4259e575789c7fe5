"""Text cleaning, language detection and tokenising as native Spark expressions.

Every function takes and returns a Column and mentions its input once (or binds it, see
``bound``), so a long chain stays one expression tree that is evaluated once per row.  Java's
``\\w``, ``\\s`` and ``\\b`` are ASCII-only; the classes below spell out the
Unicode sets instead.
"""

from __future__ import annotations

import html.entities
import json
import unicodedata
from collections.abc import Callable, Collection

from pyspark.sql import Column
from pyspark.sql import functions as F

# Character classes (to be used inside [...]).
WORD = r"\p{L}\p{N}_"
SPACE = r"\p{IsWhite_Space}\x1c-\x1f"

# Patterns that decide what the cleaned text looks like.
URL_PATTERN = rf"http[^{SPACE}]+|www[^{SPACE}]+"
DISALLOWED_CHARS = rf"[^{WORD}{SPACE}\x{{600}}-\x{{6ff}}\x{{c0}}-\x{{24f}}.,!?;:'\x22-]"
ODD_SPACE = f"[{SPACE}&&[^ ]]"
# Those of them below 256, one by one, as Java looks up single ones in a table. Above them
# the rest of Latin and the Arabic block are allowed and hold no space, so only all others are looked at.
_LOW_SPACE = (9, 10, 11, 12, 13, 28, 29, 30, 31, 0x85, 0xA0)
_LOW_DISALLOWED = [
    n for n in range(0xC0)
    if unicodedata.category(chr(n))[0] not in "LN" and chr(n) not in " _.,!?;:'\"-" and n not in _LOW_SPACE
]
_HIGH = r"\x{250}-\x{5ff}\x{700}-\x{10ffff}"
ARABIC = r"\x{600}-\x{6ff}"
KEYWORD_CHARS = rf"[a-zA-Z{ARABIC}]{{4,}}"

# Languages by source name, and language names by code.
REGIONAL_SOURCES = ["hespress", "akhbarona", "barlamane", "lakom"]
ENGLISH_SOURCES = ["bbc", "reuters", "cnn"]
ARABIC_OR_ENGLISH_SOURCES = ["aljazeera", "al jazeera"]
LANGUAGE_NAMES = {"en": "English", "ar": "Arabic", "fr": "French", "unknown": "Unknown"}

# Stop words of at least four letters (shorter ones can never be
# a keyword).
STOP_WORDS = """
with from were been have does will would could should might this that these
those they their your about than then also more after said says over into what
when which
dans pour avec elle elles nous vous leur plus
just like
""".split()

TAG = r"(?s)<(?:!--.*?-->|/[^>]*+>|[A-Za-z!?][^>]*+>)"

# A keyword begins and ends where word and non-word characters meet. Marks and
# punctuation of the Arabic block are non-word characters that a keyword may
# begin with; only there is the second form of the start tried.
_START = rf"(?:(?<![{WORD}])(?=[{WORD}])|(?=[{ARABIC}])(?<=[{WORD}])(?![{WORD}]))"
_END = rf"(?:(?<![{WORD}])(?=[{WORD}])|(?<=[{WORD}])(?![{WORD}]))"
_KEYWORD = _START + KEYWORD_CHARS + _END

# Named character references come from the Python standard library's HTML5
# table. Names without a semicolon are the legacy ones, which also match as a
# prefix of a longer word.
_ENTITY_JSON = json.dumps(html.entities.html5)
_LEGACY_NAMES = sorted(
    (n for n in html.entities.html5 if not n.endswith(";")), key=len, reverse=True
)
_LEGACY_PREFIX = "^(?:" + "|".join(_LEGACY_NAMES) + ")"
_NUMERIC = r"^#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
# What the code points 128-159 mean in practice (Windows-1252).
_C1_CHARS = "".join(
    bytes([b]).decode("cp1252", errors="ignore") or chr(b) for b in range(128, 160)
)


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` mentions it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _code_point_char(n: Column) -> Column:
    """One character from its code point, under HTML's rules for bad ones."""
    utf32 = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    bad = (n == 0) | n.between(0xD800, 0xDFFF) | (n > 0x10FFFF)
    dropped = (
        n.between(1, 8)
        | (n == 11)
        | n.between(14, 31)
        | (n == 127)
        | n.between(0xFDD0, 0xFDEF)
        | ((n % 65536) >= 65534)
    )
    return (
        F.when(bad, F.lit("�"))
        .when(n.between(128, 159), F.substring(F.lit(_C1_CHARS), n - 127, F.lit(1)))
        .when(dropped, F.lit(""))
        .otherwise(utf32)
    )


def _decode_reference(seg: Column) -> Column:
    """Decode the text that followed an ``&``; unknown references stay as text."""
    table = F.from_json(F.lit(_ENTITY_JSON), "map<string,string>")

    def rest(matched: Column) -> Column:
        return F.substring(seg, F.length(matched) + 1, F.length(seg))

    numeric = F.regexp_extract(seg, _NUMERIC, 0)
    digits = F.regexp_extract(seg, r"^#[xX]?0*([0-9a-fA-F]*)", 1)
    too_long = F.length(digits) > 8
    code_point = (
        F.when(digits == "", F.lit(0))
        .when(too_long, F.lit(0x110000))
        .otherwise(
            F.when(seg.rlike("^#[xX]"), F.conv(digits, 16, 10))
            .otherwise(F.conv(digits, 10, 10))
            .cast("bigint")
        )
    )
    # With its semicolon a name must match whole; a legacy name also as a prefix.
    named = F.regexp_extract(seg, r"^[^\t\n\f <&#;]{1,32};", 0)
    legacy = F.regexp_extract(seg, _LEGACY_PREFIX, 0)
    found = F.filter(
        F.transform(
            F.filter(F.array(named, legacy), lambda name: name != ""),
            lambda name: F.struct(name.alias("name"), F.try_element_at(table, name).alias("char")),
        ),
        lambda hit: hit["char"].isNotNull(),
    )
    hit = F.try_element_at(found, F.lit(1))
    return (
        F.when(~seg.rlike("^[A-Za-z#]"), F.concat(F.lit("&"), seg))
        .when(seg.startswith("amp;"), F.concat(F.lit("&"), F.substring(seg, F.lit(5), F.length(seg))))
        .when(numeric != "", F.concat(_code_point_char(code_point), rest(numeric)))
        .otherwise(
            F.coalesce(F.concat(hit["char"], rest(hit["name"])), F.concat(F.lit("&"), seg))
        )
    )


def unescape_html(c: Column) -> Column:
    """Decode HTML character references exactly once (``&amp;lt;`` -> ``&lt;``)."""
    decoded = F.transform(
        F.split(c, "&"),
        lambda seg, i: F.when(i == 0, seg).otherwise(_decode_reference(seg)),
    )
    return F.array_join(decoded, "")


def strip_html(c: Column) -> Column:
    """Drop tags and comments, join the text pieces by one space, then decode
    character references.

    Tags go first, so an escaped ``&lt;b&gt;`` stays text.  Text inside
    ``script`` and ``style`` is kept as text here (a ``<`` in it opens a tag);
    page extraction drops those blocks beforehand.  An unfinished reference or
    tag at the end is kept as text.
    """

    def without_tags(text: Column) -> Column:
        pieces = F.filter(F.split(text, TAG), lambda x: x != "")
        return F.when(text.contains("<"), F.array_join(pieces, " ")).otherwise(text)

    def unescaped(text: Column) -> Column:
        return F.when(text.contains("&"), unescape_html(text)).otherwise(text)

    # Most texts have no markup, and splitting them would cost more than looking for it.
    return bound(bound(F.coalesce(c, F.lit("")), without_tags), unescaped)


def _blank_each(c: Column, low: Collection[int], chars: str) -> Column:
    """Each character of a class becomes a blank; ``low`` are those below 256, for which one look at a table does."""

    def high_too(text: Column) -> Column:
        return F.when(text.rlike(f"[{_HIGH}]"), F.regexp_replace(text, f"[{_HIGH}&&{chars}]", " ")).otherwise(text)

    return bound(F.regexp_replace(c, f"[{_escaped(low)}]", " "), high_too)


def _escaped(chars: Collection[int]) -> str:
    return "".join(rf"\x{n:02x}" for n in chars)


def remove_urls(c: Column) -> Column:
    """Remove anything from ``http`` or ``www`` up to the next space."""

    def without_urls(text: Column) -> Column:
        return F.when(text.contains("http") | text.contains("www"), F.regexp_replace(text, URL_PATTERN, "")).otherwise(text)

    return bound(c, without_urls)


def collapse_whitespace(c: Column) -> Column:
    """Each run of Unicode white space becomes one blank.

    Two passes that match little are cheaper than one that matches every blank.
    """
    return bound(_blank_each(c, _LOW_SPACE, ODD_SPACE), _single_blanks)


def _single_blanks(text: Column) -> Column:
    return F.when(text.contains("  "), F.regexp_replace(text, " {2,}", " ")).otherwise(text)


def filter_characters(c: Column) -> Column:
    """Replace each character outside the allow-list by a space."""
    return _blank_each(c, _LOW_DISALLOWED, DISALLOWED_CHARS)


def normalize_text(c: Column) -> Column:
    """Strip tags, URLs, extra space and odd characters, in that order.

    The character filter runs after the space collapse, so doubled spaces may
    remain and count towards the length. NULL becomes ``''``.

    Line feeds, which most texts have, are replaced as bytes; most have no other character that the last two
    steps replace, and one look for any is cheaper than both.
    """
    odd = f"[{_escaped([*_LOW_SPACE, *_LOW_DISALLOWED])}{_HIGH}]"

    def look(text: Column) -> Column:
        return F.struct(text.alias("text"), text.rlike(odd).alias("odd"))

    def filtered(looked: Column) -> Column:
        spaced = F.when(looked["odd"], _blank_each(looked["text"], _LOW_SPACE, ODD_SPACE)).otherwise(looked["text"])
        return bound(
            bound(spaced, _single_blanks), lambda text: F.when(looked["odd"], filter_characters(text)).otherwise(text)
        )

    lines = F.replace(remove_urls(strip_html(c)), F.lit("\n"), F.lit(" "))
    return F.trim(bound(bound(lines, look), filtered))


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def is_blank(c: Column) -> Column:
    """True for NULL and for the empty string."""
    return F.coalesce(c, F.lit("")) == ""


def _count_chars(c: Column, char_class: str) -> Column:
    return F.length(F.regexp_replace(c, f"[^{char_class}]+", ""))


def _mentions(source: Column, names: list[str]) -> Column:
    return F.lower(F.coalesce(source, F.lit(""))).rlike("|".join(names))


def detect_language(text: Column, source: Column) -> Column:
    """Language code from the source name and the count of Arabic and ASCII
    letters; a tie is not Arabic."""
    mostly_arabic = text.rlike(f"[{ARABIC}]") & (_count_chars(text, ARABIC) > _count_chars(text, "a-zA-Z"))
    return (
        F.when(is_blank(text), "unknown")
        .when(_mentions(source, REGIONAL_SOURCES), F.when(mostly_arabic, "ar").otherwise("fr"))
        .when(_mentions(source, ENGLISH_SOURCES), "en")
        .otherwise(F.when(mostly_arabic, "ar").otherwise("en"))
    )


def language_or_detect(language: Column, text: Column, source: Column) -> Column:
    """The given language when there is one, else the detected one."""
    return F.coalesce(null_if_empty(language), detect_language(text, source))


def language_name(code: Column) -> Column:
    """Display name of a language code; an unknown code is its own name."""
    names = F.create_map(*[F.lit(x) for pair in LANGUAGE_NAMES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, code), code)


def keyword_tokens(text: Column) -> Column:
    """Array of lower-case words of four or more ASCII or Arabic-block letters.

    A word that also holds an accented letter, a digit or ``_`` is left out
    whole. A word holds no blank, so the words of a text are those of what stands between its blanks.
    """
    return F.regexp_extract_all(F.lower(text), F.lit(_KEYWORD), F.lit(0))


def _title_and_content(content: Column, title: Column) -> Column:
    return F.concat(F.coalesce(content, F.lit("")), F.lit(" "), F.coalesce(title, F.lit("")))


def article_tokens(content: Column, title: Column) -> Column:
    return keyword_tokens(_title_and_content(content, title))


def article_chunks(content: Column, title: Column) -> Column:
    """Array of what stands between blanks, as it is: splitting at one character needs no pattern."""
    return F.split(_title_and_content(content, title), " ")


def is_stop_word(word: Column) -> Column:
    return word.isin(STOP_WORDS)


def url_hash(url: Column) -> Column:
    return F.sha2(F.coalesce(url, F.lit("")), 256)
