"""Fields of a page by CSS selectors, from a real HTML parse.

Balanced nesting needs a parser, so this is the one place where pages go through
Python: an Arrow batch of pages at a time, each parsed once for all selectors with the
standard library's ``html.parser``. Selectors are ``tag``, ``.class.class`` and either
followed by a descendant tag (``.class tag``). Class names match whole class tokens.
Text is the element's text content with all entities decoded, trimmed; markup is the
source between the element's tags.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmart import schemas as S

# Workers need no installed copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
TEXT_FIELDS = dict(S.DOM_TEXT_SELECTORS)
MARKUP_FIELDS = dict(S.DOM_HTML_SELECTORS)


Simple = tuple[str | None, frozenset]


def _parse(selector: str) -> list[Simple]:
    return [
        (None, frozenset(c for c in part.split(".") if c)) if part.startswith(".") else (part.lower(), frozenset())
        for part in selector.split()
    ]


class Selectors:
    """Selectors taken apart once, found by the tag or a class of the element they select."""

    def __init__(self, selectors: Iterable[str]):
        self.by_tag: dict[str, list[str]] = {}
        self.by_class: dict[str, list[str]] = {}
        self.parts: dict[str, tuple[list[Simple], frozenset]] = {}
        for selector in dict.fromkeys(selectors):
            *above, (tag, classes) = _parse(selector)
            self.parts[selector] = (above, classes)
            if tag is not None:
                self.by_tag.setdefault(tag, []).append(selector)
            else:
                self.by_class.setdefault(min(classes), []).append(selector)


def _below(above: list[Simple], open_: list["_Open"]) -> bool:
    """Whether the open elements hold ``above`` in this order, outermost first."""
    rest = len(above)
    for element in reversed(open_):
        if not rest:
            break
        tag, classes = above[rest - 1]
        rest -= (tag is None or element.tag == tag) and classes <= element.classes
    return not rest


class _Match:
    """The first element that some selectors select: its place in the source, its text."""

    __slots__ = ("inner", "end", "text")

    def __init__(self, inner: int):
        self.inner, self.end, self.text = inner, inner, []


class _Open:
    __slots__ = ("tag", "classes", "match")

    def __init__(self, tag: str, classes: frozenset, match: _Match | None):
        self.tag, self.classes, self.match = tag, classes, match


_NO_CLASSES: frozenset = frozenset()
# Tags without attributes, which most are; all others go the library's long way.
_PLAIN_START = re.compile(r"<([a-zA-Z][a-zA-Z0-9]*)>")
_PLAIN_END = re.compile(r"</([a-zA-Z][a-zA-Z0-9]*)>")


class _Page(HTMLParser):
    """The first element in document order of each selector, matched while parsing: only the
    open elements and the matches are kept, and text only inside open matches."""

    def __init__(self, html: str, selectors: Selectors):
        super().__init__(convert_charrefs=True)
        self.html, self.selectors = html, selectors
        self.matches: dict[str, _Match] = {}
        self.open: list[_Open] = []
        self.depth: dict[str, int] = {}
        self.collecting: list[_Match] = []
        # The place of what is parsed now, from the start of the page.
        self.at = 0
        self.feed(html)
        self.close()
        for match in self.collecting:
            match.end = len(html)

    def updatepos(self, i: int, j: int) -> int:
        """Counts on by what has been read, instead of by lines and columns."""
        self.at += j - i
        return j

    def parse_starttag(self, i: int) -> int:
        plain = _PLAIN_START.match(self.rawdata, i)
        if plain is None:
            self.plain = 0
            return super().parse_starttag(i)
        self.lasttag = tag = plain[1].lower()
        self.plain = plain.end() - i
        self.handle_starttag(tag, ())
        if tag in self.CDATA_CONTENT_ELEMENTS:
            self.set_cdata_mode(tag)
        return plain.end()

    def parse_endtag(self, i: int) -> int:
        plain = _PLAIN_END.match(self.rawdata, i) if self.cdata_elem is None else None
        if plain is None:
            return super().parse_endtag(i)
        self.handle_endtag(plain[1].lower())
        return plain.end()

    def handle_starttag(self, tag: str, attrs: Iterable) -> None:
        classes = _NO_CLASSES
        for name, value in attrs:
            if name == "class":
                classes = frozenset((value or "").split())
        wanted = list(self.selectors.by_tag.get(tag, ()))
        for name in classes:
            wanted += self.selectors.by_class.get(name, ())
        match = None
        for selector in wanted:
            above, own = self.selectors.parts[selector]
            if selector not in self.matches and own <= classes and _below(above, self.open):
                match = match or _Match(self.at + (self.plain or len(self.get_starttag_text())))
                self.matches[selector] = match
        if tag not in VOID_TAGS:
            self.open.append(_Open(tag, classes, match))
            self.depth[tag] = self.depth.get(tag, 0) + 1
            if match is not None:
                self.collecting.append(match)

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self._close_last(None)

    def _close_last(self, end: int | None) -> None:
        element = self.open.pop()
        self.depth[element.tag] -= 1
        if element.match is not None:
            self.collecting.pop()
            element.match.end = element.match.inner if end is None else end

    def handle_endtag(self, tag: str) -> None:
        # An end tag without an open element closes nothing.
        if not self.depth.get(tag):
            return
        end = self.at
        while self.open[-1].tag != tag:
            self._close_last(end)
        self._close_last(end)

    def handle_data(self, data: str) -> None:
        for match in self.collecting:
            match.text.append(data)


FIELDS = [(s, False) for s in TEXT_FIELDS.values()] + [(s, True) for s in MARKUP_FIELDS.values()]
SELECTORS = Selectors(selector for selectors, _ in FIELDS for selector in selectors)


def fields_of(html: str | None) -> tuple[str, ...]:
    """The W8 fields of one page: of each, the first selector that yields something."""
    if not html:
        return ("",) * len(FIELDS)
    matches = _Page(html, SELECTORS).matches
    out = []
    for selectors, markup in FIELDS:
        value = ""
        for selector in selectors:
            match = matches.get(selector)
            if match is not None:
                value = html[match.inner : match.end] if markup else "".join(match.text).strip()
            if value:
                break
        out.append(value)
    return tuple(out)


@F.pandas_udf(S.DOM_RECORD)
def _records(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    names = list(TEXT_FIELDS) + list(MARKUP_FIELDS)
    for htmls in batches:
        yield pd.DataFrame([fields_of(h) for h in htmls], columns=names)


def dom_record(html: Column) -> Column:
    """W8 as a struct column (missing fields are empty text)."""
    return _records(html)
