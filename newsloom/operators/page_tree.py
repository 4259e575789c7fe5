"""A small element tree over the standard library's HTML parser.

Only what the site rules need: first element by selector, all elements of a
tag, and text. An end tag closes up to its nearest open element; one without an
open element is ignored; nothing else is repaired.
"""

from __future__ import annotations

import functools
import re
from collections import defaultdict
from html import unescape
from html.parser import HTMLParser

_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_HIDDEN_TEXT = frozenset(("script", "style", "template"))
_SELECTOR = re.compile(
    r"(?P<tag>[\w-]*)(?:\.(?P<cls>[\w-]+)|\[(?P<attr>[\w-]+)(?P<op>\*?=)(?P<value>[^\]]+)\])?"
)
_TAG_ALONE = re.compile(r"[\w-]+")

# Markup in its plainest forms, with the text before it: a start tag, an end tag, a comment or a document type. All
# versions of the parser read these alike, and one look at each is several times faster. Every repetition is
# possessive: no character is tried twice.
_TAG = "[a-zA-Z][-a-zA-Z0-9]*+"
_ATTRIBUTE = r"""([a-zA-Z][-a-zA-Z0-9_:]*+)(=(?:"([^"]*+)"|'([^']*+)'|([-a-zA-Z0-9_.:%#]++)(?=[ \t\r\n>]|\Z)))?+"""
_UNNAMED = re.sub(r"\((?!\?)", "(?:", _ATTRIBUTE)
_PLAIN = re.compile(
    r"([^<]*+(?:<(?![a-zA-Z/!?])[^<]*+)*+)<"
    rf"(?:({_TAG})((?:[ \t\r\n]++{_UNNAMED})*+)[ \t\r\n]*+(/?)>"
    rf"|/({_TAG})>"
    r"|!--[^->]*+(?:-[^->]++)*+-->"
    r"|!(?:DOCTYPE|doctype)[^>]*+>)"
)
_ATTRIBUTES = re.compile(_ATTRIBUTE)
# Elements whose content is no markup, or not in every version; and what may end or hide in a script.
_SCRIPTS = frozenset(("script", "style"))
_TEXTS = frozenset(("title", "textarea"))
_RAW = frozenset("iframe noembed noframes plaintext xmp".split()) | _SCRIPTS | _TEXTS
_ODD = re.compile(r"</\s*s|<!--|<s", re.I)


class Element:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag = tag
        self.attrs = attrs
        self.children: list = []

    def walk(self):
        """Descendant elements in document order."""
        stack = [c for c in reversed(self.children) if isinstance(c, Element)]
        while stack:
            node = stack.pop()
            yield node
            if node.children:
                stack += [c for c in reversed(node.children) if isinstance(c, Element)]

    def strings(self):
        stack = list(reversed(self.children))
        while stack:
            node = stack.pop()
            if isinstance(node, str):
                yield node
            elif node is not None and node.tag not in _HIDDEN_TEXT:
                stack.extend(reversed(node.children))

    def text(self, separator: str = "") -> str:
        pieces = (s.strip() for s in self.strings())
        return separator.join(p for p in pieces if p)

    def firsts(self, selectors: list[str]) -> dict:
        """The first element of each selector, found in one walk."""
        tags = {s for s in selectors if _TAG_ALONE.fullmatch(s)}
        # These ask for an attribute.
        tests = [(s, _compiled(s)) for s in selectors if s not in tags]
        found: dict[str, Element] = {}
        for node in self.walk():
            if node.tag in tags:
                found[node.tag] = node
                tags.remove(node.tag)
            if node.attrs and tests:
                hits = [s for s, test in tests if test(node)]
                if hits:
                    found.update((s, node) for s in hits)
                    tests = [t for t in tests if t[0] not in found]
            if not tags and not tests:
                break
        return found

    def first(self, selector: str):
        return self.firsts([selector]).get(selector)

    def all(self, selector: str) -> list:
        test = _compiled(selector)
        return [n for n in self.walk() if test(n)]

    def remove(self, unwanted) -> None:
        """Drop every descendant for which ``unwanted`` holds."""
        for node in [self, *self.walk()]:
            node.children = [
                c for c in node.children if not (isinstance(c, Element) and unwanted(c))
            ]


@functools.cache
def _compiled(selector: str):
    """A selector as a function of an element."""
    want = _SELECTOR.fullmatch(selector).groupdict()
    tag, cls, attr, value = want["tag"], want["cls"], want["attr"], want["value"]

    def test(node: Element) -> bool:
        if tag and node.tag != tag:
            return False
        if cls:
            return cls in (node.attrs.get("class") or "").split()
        if attr:
            own = node.attrs.get(attr) or ""
            return value in own.lower() if want["op"] == "*=" else own == value
        return True

    return test


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Element("", {})
        self.open = [self.root]
        self.counts = defaultdict(int)  # open elements by tag
        self.pieces: list[str] = []  # of a string that may still grow
        self.unclosed: str | None = None  # input in which a comment had no end

    def end_string(self):
        if self.pieces:
            self.open[-1].children.append("".join(self.pieces))
            self.pieces = []

    def handle_starttag(self, tag, attrs):
        self.end_string()
        node = Element(tag, dict(attrs))
        self.open[-1].children.append(node)
        if tag not in _VOID:
            self.open.append(node)
            self.counts[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        self.handle_endtag(tag)

    def handle_endtag(self, tag):
        self.end_string()
        while self.counts[tag]:
            closed = self.open.pop().tag
            self.counts[closed] -= 1
            if closed == tag:
                return

    def read_plain(self, html: str, end: int) -> int:
        """Read what is in the plainest forms, as the parser would, up to the first markup that is not (see ``_PLAIN``).
        Returns where that, with the text before it, begins."""
        at, opened, counts = 0, self.open, self.counts
        while found := _PLAIN.match(html, at, end):
            text, tag, attributes, closed, ended = found.groups()
            after, content = found.end(), ""
            if tag:
                tag = tag.lower()
                if tag in _RAW:
                    stop = _content_end(html, tag, after, end)
                    if closed or stop < 0 or "&" in attributes:
                        return at
                    content, after = html[after:stop], stop + len(tag) + 3
            if text:
                opened[-1].children.append(unescape(text))
            if ended:
                ended = ended.lower()
                if opened[-1].tag == ended:
                    opened.pop()
                    counts[ended] -= 1
                else:
                    self.handle_endtag(ended)
            elif tag and "&" in attributes:
                self.rawdata = html[found.end(1) : after]
                self.parse_starttag(0)
                self.rawdata = ""
            elif tag:
                node = Element(tag, _values(attributes) if attributes else {})
                opened[-1].children.append(node)
                if content:
                    node.children.append(content if tag in _SCRIPTS else unescape(content))
                elif not closed and tag not in _VOID and tag not in _RAW:
                    opened.append(node)
                    counts[tag] += 1
            at = after
        return at

    def handle_data(self, data):
        self.pieces.append(data)

    def handle_comment(self, data):
        self.end_string()

    def handle_decl(self, decl):
        self.end_string()

    def handle_pi(self, data):
        self.end_string()

    def unknown_decl(self, data):
        self.end_string()

    def parse_marked_section(self, i, report=1):
        """A marked section of any kind ends at the next ``>`` and is no text."""
        self.end_string()
        end = self.rawdata.find(">", i)
        return end + 1 if end >= 0 else -1

    def parse_comment(self, i, report=1):
        """Where one comment has no end, no later one has: it is looked for once."""
        if self.unclosed is self.rawdata:
            return -1
        end = super().parse_comment(i, report)
        if end < 0:
            self.unclosed = self.rawdata
        return end


def _values(attributes: str) -> dict[str, str | None]:
    """Attributes of a plain start tag; they hold no character references."""
    found = _ATTRIBUTES.findall(attributes)
    return {name.lower(): quoted or single or bare if given else None for name, given, quoted, single, bare in found}


def _content_end(html: str, tag: str, start: int, end: int) -> int:
    """Where the end tag of an element without markup in it begins; -1 if that is not plain."""
    if tag in _SCRIPTS:
        stop = html.find(f"</{tag}>", start, end)
        return -1 if stop >= 0 and _ODD.search(html, start, stop) else stop
    stop = html.find("<", start, end)
    return stop if tag in _TEXTS and html.startswith(f"</{tag}>", stop, end) else -1


def parse(html: str) -> Element:
    """The tree of a page, in time that grows with its length, whatever is left open in it.

    Behind the last ``>`` no tag, comment or declaration can end any more. What is there is
    text, and the parser, which would look for an end from every ``<`` on, does not get it;
    in a script that is left open it is dropped with the rest of the script.
    """
    end = html.rfind(">") + 1
    builder = _Builder()
    # The root is open whatever ends, as no tag has its name.
    plain = builder.read_plain(html, end)
    builder.feed(html[plain:end])
    builder.close()
    if builder.cdata_elem is None and end < len(html):
        builder.handle_data(unescape(html[end:]))
    builder.end_string()
    return builder.root
