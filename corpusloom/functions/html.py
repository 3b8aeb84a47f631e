"""The main text of a page without an article element: one pass over its tags, then the best run of blocks."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Elements whose text begins a block of its own, and among them those that hold running text.
PROSE = frozenset(["p", "pre", "blockquote", "h1", "h2", "h3", "h4", "h5", "h6"])
BLOCKS = PROSE | frozenset(
    ["address", "article", "body", "br", "caption", "center", "dd", "div", "dl", "dt", "fieldset", "figcaption", "figure", "header",
     "hr", "html", "legend", "li", "main", "ol", "section", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul"]
)
#: Elements whose content is no text of the page, and those that hold menus, forms and remarks.
RAW = frozenset(["script", "style", "title", "textarea", "noscript", "template", "iframe", "svg"])
ASIDE = frozenset(["nav", "aside", "footer", "form", "button", "select"])
#: What a block outside running text costs, in words: short ones (advertisements, captions, cells) end up below zero.
PLAIN_COST = 15
#: What a word inside a link costs beyond its own worth.
LINK_COST = 3

_TAG = re.compile(r"""<(?:!--(?P<note>.*?)(?:-->|\Z)|!\[CDATA\[(?P<data>.*?)(?:\]\]>|\Z)|[!?][^>]*(?:>|\Z)|(?P<end>/?)(?P<name>[a-zA-Z][^\s/>]*)(?:"[^"]*"|'[^']*'|[^"'>])*+(?P<closed>>?))""", re.S)
_RAW_END = {name: re.compile(rf"</{name}(?=[\s/>]|\Z)", re.I) for name in RAW}


def blocks(page: str) -> Iterator[tuple[str, int, int, bool]]:
    """Text, words, words inside links, and whether it is running text, of every block with words.

    One pass: comments, raw elements and ``ASIDE`` elements are left out, and a tag that never ends takes the rest of the
    page with it, as in browsers. Quotes may hold ``>``; a ``<`` that begins no tag is text.
    """
    parts: list[str] = []
    words = linked = links = hidden = at = 0
    prose, hiding = False, ""
    while True:
        tag = _TAG.search(page, at)
        text = page[at : tag.start() if tag else len(page)]
        if tag and tag["data"] is not None:
            text += tag["data"]
        if text and not hidden:
            text = html.unescape(text)
            parts.append(text)
            if links:
                linked += len(text.split())
        if not tag:
            break
        at = tag.end()
        name = (tag["name"] or "").lower()
        if not name:
            continue
        if not tag["closed"]:
            break
        opens = not tag["end"]
        if hidden:
            hidden += (name == hiding) * (1 if opens else -1)
            continue
        if opens and name in RAW:
            end = _RAW_END[name].search(page, at)
            at = end.start() if end else len(page)
        elif opens and name in ASIDE:
            hidden, hiding = 1, name
        elif name == "a":
            links = 1 if opens else 0  # links don't nest
        if name in BLOCKS or name in ASIDE:
            joined = " ".join("".join(parts).split())
            if joined:
                words = joined.count(" ") + 1
                yield joined, words, min(linked, words), prose
            parts, linked = [], 0
            if name != "br":
                prose = opens and name in PROSE
    joined = " ".join("".join(parts).split())
    if joined:
        words = joined.count(" ") + 1
        yield joined, words, min(linked, words), prose


def main_text(page: str | None) -> str | None:
    """The run of neighbouring blocks whose worth adds up highest (the first of equals): a word counts one, a word inside
    a link counts against its block, and a block outside running text costs some words. Null where nothing is worth
    anything."""
    found = list(blocks(page or ""))
    best, total, start, span = 0, 0, 0, None
    for i, (_, words, linked, prose) in enumerate(found):
        if total <= 0:
            total, start = 0, i
        total += words - LINK_COST * linked - (0 if prose else PLAIN_COST)
        if total > best:
            best, span = total, (start, i + 1)
    return " ".join(text for text, *_ in found[slice(*span)]) if span else None


@F.pandas_udf(T.StringType())
def _main_text(pages: pd.Series) -> pd.Series:
    return pages.map(main_text)


def article_body(page: Column) -> Column:
    """``main_text`` as a column; a parser can't be an expression, so pages go to Python in Arrow batches."""
    return _main_text(page)
