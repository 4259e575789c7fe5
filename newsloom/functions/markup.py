"""Reading simple parts of raw HTML with native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsloom.functions.dates import strip_space
from newsloom.functions.text import TAG, unescape_html

_HREF = r"""(?i)<a\s(?:[^>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+)"""


def drop_comments(html: Column) -> Column:
    return F.regexp_replace(html, r"(?s)<!--.*?-->", "")


def drop_blocks(html: Column, tags: tuple[str, ...]) -> Column:
    """Remove whole elements that do not nest in themselves, such as script."""
    names = "|".join(tags)
    return F.regexp_replace(html, rf"(?is)<({names})(?:\s[^>]*)?>.*?</\1\s*>", "")


def first_block(html: Column, tag: str) -> Column:
    """Inside of the first such element, to its end tag or the end; '' if none."""
    return F.regexp_extract(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)(?:</{tag}\s*>|\z)", 1)


def text_pieces(html: Column) -> Column:
    """Text between tags: decoded, stripped, empty pieces left out."""
    pieces = F.transform(
        F.split(html, TAG),
        lambda p: strip_space(F.when(p.contains("&"), unescape_html(p)).otherwise(p)),
    )
    return F.filter(pieces, lambda p: p != "")


def joined_text(html: Column) -> Column:
    """Pieces with a blank between them."""
    return F.array_join(text_pieces(html), " ")


def glued_text(html: Column) -> Column:
    """Pieces with nothing between them, as titles are read."""
    return F.array_join(text_pieces(html), "")


def page_title(html: Column) -> Column:
    """Text of the first ``h1``."""
    return glued_text(first_block(drop_comments(html), "h1"))


def page_body(html: Column, tag: str = "article", drop: tuple[str, ...] = ("script", "style", "nav", "aside")) -> Column:
    """Text of the first such element without its boilerplate elements."""
    return joined_text(first_block(drop_blocks(html, drop), tag))


def hrefs(html: Column) -> Column:
    """Targets of all links in document order, outside comments and scripts."""
    visible = drop_blocks(drop_comments(html), ("script", "style"))
    quoted = F.regexp_extract_all(visible, F.lit(_HREF), F.lit(1))
    return F.transform(
        quoted,
        lambda h: F.transform(
            F.array(F.regexp_replace(h, """^["']|["']$""", "")),
            lambda v: F.when(v.contains("&"), unescape_html(v)).otherwise(v),
        )[0],
    )


def site_base(url: Column) -> Column:
    """Scheme and host of a URL."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+", 0)


def resolve(href: Column, base: Column) -> Column:
    """Put the site base before a target that starts with ``/``."""
    return F.when(href.startswith("/"), F.concat(base, href)).otherwise(href)
