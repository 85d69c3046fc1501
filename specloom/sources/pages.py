"""Jobs over raw page HTML.

Spark splits the pages over tasks and hands them over in Arrow batches; the
tag walk below is the small per-page helper.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

# Page sections, the class names of label and value cells and of the price table.
SECTIONS = [
    "Network", "Launch", "Body", "Display", "Platform", "Memory", "Main Camera",
    "Selfie camera", "Sound", "Comms", "Features", "Battery", "Misc",
]
LABEL_CLASS, VALUE_CLASS = "ttl", "nfo"
PRICE_CLASSES = {"pricing", "inline", "widget"}
DEVICE_COUNT = r"\d+ devices"

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "wbr"}


class _Node:
    __slots__ = ("tag", "attrs", "classes", "kids", "parent")

    def __init__(self, tag, attrs, parent, classes=None):
        self.tag, self.attrs, self.parent = tag, dict(attrs) if classes is None else attrs, parent
        self.classes = set((self.attrs.get("class") or "").split()) if classes is None else classes
        self.kids = []

    def walk(self):
        """All nodes below in document order; a stack, since pages may never close their tags."""
        open_ = list(reversed(self.kids))
        while open_:
            kid = open_.pop()
            if isinstance(kid, _Node):
                yield kid
                open_.extend(reversed(kid.kids))

    def first(self, tag, cls=None):
        return next((n for n in self.walk() if n.tag == tag and (cls is None or cls in n.classes)), None)

    def text(self, strip_parts=False):
        parts = list(self._parts())
        return "".join(p.strip() for p in parts) if strip_parts else "".join(parts).strip()

    def _parts(self):
        open_ = list(reversed(self.kids))
        while open_:
            kid = open_.pop()
            if isinstance(kid, str):
                yield kid
            else:
                open_.extend(reversed(kid.kids))


class _Tree(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", [], None)

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, attrs, self.at)
        self.at.kids.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.kids.append(_Node(tag, attrs, self.at))

    def handle_endtag(self, tag):
        node = self.at
        while node is not None and node.tag != tag:
            node = node.parent
        if node is not None and node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.kids.append(data)


# Pieces that every reading of HTML agrees on: text, plain start tags, plain end tags.
_PLAIN = re.compile(
    r"""([^<]+)|<([a-zA-Z][a-zA-Z0-9]*)((?:[ \t\n\r\f]+[a-zA-Z][-a-zA-Z0-9]*(?:=(?:"[^"&<>]*"|'[^'&<>]*'|[^\s"'=<>`&/]+))?)*)[ \t\n\r\f]*>"""
    r"""|</([a-zA-Z][a-zA-Z0-9]*)>""")
_ATTR = re.compile(r"""([a-zA-Z][-a-zA-Z0-9]*)(?:=(?:"([^"]*)"|'([^']*)'|([^\s]+)))?""")
# Tags whose content is not read as tags, in some version of Python's parser.
_RAW_TEXT = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext", "svg", "math"}


@lru_cache(4096)
def _attrs(text: str) -> tuple[dict, frozenset]:
    """Attributes and class names of a plain start tag; shared, never changed."""
    attrs = {m[1].lower(): None if m.lastindex == 1 else m[m.lastindex] for m in _ATTR.finditer(text)}
    return attrs, frozenset((attrs.get("class") or "").split())


def _plain_tree(html: str) -> _Node | None:
    """The tree of a page of plain pieces only, as `_Tree` builds it; None for any other page."""
    root = at = _Node("", [], None)
    end = 0
    for m in _PLAIN.finditer(html):
        if m.start() != end:
            return None
        end = m.end()
        kind = m.lastindex
        if kind == 1:
            text = m[1]
            at.kids.append(unescape(text) if "&" in text else text)
        elif kind == 4:
            tag, node = m[4].lower(), at
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                at = node.parent
        else:
            tag = m[2].lower()
            if tag in _RAW_TEXT:
                return None
            attrs, classes = _attrs(m[3])
            node = _Node(tag, attrs, at, classes)
            at.kids.append(node)
            if tag not in _VOID:
                at = node
    return root if end == len(html) else None


def _tree(html: str | None) -> _Node:
    plain = _plain_tree(html or "")
    if plain is not None:
        return plain
    tree = _Tree()
    tree.feed(html or "")
    tree.close()
    return tree.root


def _spec_rows(html, sections):
    """(section, field, value) in page order; a section not on the page gives one NULL row."""
    tables = [n for n in _tree(html).walk() if n.tag == "table"]
    titled = {}
    for t in tables:
        th = t.first("th")
        if th is not None:
            titled.setdefault(th.text(), t)
    for section in sections:
        table = titled.get(section)
        if table is None:
            yield section, None, None
            continue
        fields = {}
        for row in (n for n in table.walk() if n.tag == "tr"):
            label, value = row.first("td", LABEL_CLASS), row.first("td", VALUE_CLASS)
            if label is not None and value is not None:
                fields[label.text()] = value.text()
        for field, value in fields.items():
            yield section, field, value


def _price_rows(html):
    table = next((n for n in _tree(html).walk() if n.tag == "table" and PRICE_CLASSES <= n.classes), None)
    prices = {}
    for row in (n for n in table.walk() if n.tag == "tr") if table is not None else ():
        cell, link = row.first("td"), row.first("a")
        config = cell.text(True) if cell is not None else ""
        price = link.text(True) if link is not None else ""
        if config and price:
            prices[config] = price
    return prices.items()


def _matches(node, step):
    tag, _, cls = step.partition(".")
    return (not tag or node.tag == tag) and (not cls or cls in node.classes)


def _selected(root, path):
    """Nodes for a descendant selector such as '.makers ul li a'."""
    *outer, last = path.split()
    for node in root.walk():
        if not _matches(node, last):
            continue
        up, todo = node.parent, list(outer)
        while todo and up is not None:
            if _matches(up, todo[-1]):
                todo.pop()
            up = up.parent
        if not todo:
            yield node


def _job(pages: DataFrame, id_col: str, html_col: str, rows, columns: str) -> DataFrame:
    """Run `rows(html)` over every page; long output rows keyed by the page id."""
    ship_package(pages.sparkSession)
    id_type = dict(pages.dtypes)[id_col]
    names = [id_col] + [c.split()[0] for c in columns.split(",")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [
                (page, *row)
                for page, html in zip(batch[id_col].tolist(), batch[html_col].tolist())
                for row in rows(html)
            ]
            yield pd.DataFrame(out, columns=names)

    return pages.select(id_col, html_col).mapInPandas(run, f"`{id_col}` {id_type}, {columns}")


def extract_spec_tables(pages: DataFrame, sections=tuple(SECTIONS), id_col="page_id", html_col="html") -> DataFrame:
    """label/value pairs of the first table titled with each wanted section."""
    wanted = list(sections)
    return _job(
        pages, id_col, html_col, lambda html: _spec_rows(html, wanted),
        "section string, field string, value string",
    )


def extract_price_table(pages: DataFrame, id_col="page_id", html_col="html") -> DataFrame:
    """Configuration and price of the first price table; broken rows are skipped."""
    return _job(pages, id_col, html_col, _price_rows, "config string, price string")


def extract_links(pages: DataFrame, css=".makers ul li a", base="", id_col="page_id", html_col="html") -> DataFrame:
    """Name and absolute URL of every link under a selector."""

    def rows(html):
        for a in _selected(_tree(html), css):
            if a.attrs.get("href") is not None:
                yield a.text(), urljoin(base, a.attrs["href"])

    return _job(pages, id_col, html_col, rows, "name string, url string")


def extract_brand_links(pages: DataFrame, base="", id_col="page_id", html_col="html") -> DataFrame:
    """Brand cells of the first table; the device count is cut from the name."""

    def rows(html):
        table = _tree(html).first("table")
        for cell in (n for n in table.walk() if n.tag == "td") if table is not None else ():
            link = cell.first("a")
            if link is not None and link.attrs.get("href") is not None:
                yield cell.text(), urljoin(base, link.attrs["href"])

    links = _job(pages, id_col, html_col, rows, "name string, url string")
    return links.withColumn("name", F.trim(F.regexp_replace("name", DEVICE_COUNT, "")))


def next_page(pages: DataFrame, base="", id_col="page_id", html_col="html") -> DataFrame:
    """URL behind the 'Next page' button, for pages that have one."""

    def rows(html):
        for a in _tree(html).walk():
            if a.tag == "a" and "prevnextbutton" in a.classes and a.attrs.get("title") == "Next page":
                if a.attrs.get("href") is not None:
                    yield (urljoin(base, a.attrs["href"]),)
                return

    return _job(pages, id_col, html_col, rows, "url string")
