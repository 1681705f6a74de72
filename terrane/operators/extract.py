"""Fields from web pages by templates, with the standard library's HTML parser, over Arrow batches of pages.

A template is a list of fields: name, selector, valueType (text, src, href, html, or an attribute such as data-phone) and
excludeWords, which are removed from the value. Selectors: steps joined by blanks, each a descendant of the one before,
of a tag, #id, .class, [attr] and [attr=value] in any mix; or the same as //tag[@attr='value']//tag. A field's value is
that of its first element in the page, or null; `many` joins the distinct values of all by "||".
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: An open element of these ends where the next of its kind starts.
_ENDED = frozenset("p li td th tr dt dd option".split())
_SILENT = frozenset(("script", "style"))
_STEP = re.compile(r"([a-zA-Z][\w-]*|\*)|#([\w-]+)|\.([\w-]+)|\[@?([\w-]+)(?:=['\"]?([^'\"\]]*)['\"]?)?\]")


@dataclass(frozen=True)
class Field:
    name: str
    selector: str
    value_type: str = "text"
    exclude: tuple[str, ...] = ()
    many: bool = False


@dataclass
class _Element:
    tag: str
    attrs: dict[str, str]
    parent: _Element | None
    start: int
    end: int = -1
    text_from: int = 0
    text_to: int = 0


class _Page(HTMLParser):
    """All elements in document order, and the text pieces between them."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.html, self.elements, self.open, self.texts = html, [], [], []
        self.lines = [0]
        for m in re.finditer("\n", html):
            self.lines.append(m.end())
        self.feed(html)
        self.close()
        for e in self.open:
            e.end, e.text_to = len(html), len(self.texts)

    def _at(self) -> int:
        line, column = self.getpos()
        return self.lines[line - 1] + column

    def handle_starttag(self, tag, attrs):
        if tag in _ENDED and self.open and self.open[-1].tag == tag:
            last = self.open.pop()
            last.end, last.text_to = self._at(), len(self.texts)
        e = _Element(tag, {k: v or "" for k, v in attrs}, self.open[-1] if self.open else None, self._at() + len(self.get_starttag_text()), text_from=len(self.texts))
        self.elements.append(e)
        if tag in _VOID:
            e.end, e.text_to = e.start, len(self.texts)
        else:
            self.open.append(e)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if any(e.tag == tag for e in self.open):
            while True:
                e = self.open.pop()
                e.end, e.text_to = self._at(), len(self.texts)
                if e.tag == tag:
                    break

    def handle_data(self, data):
        if not (self.open and self.open[-1].tag in _SILENT):
            self.texts.append(data)


def _steps(selector: str) -> list[list[tuple[str, str, str, str, str]]]:
    return [_STEP.findall(s) for s in re.split(r"\s+|//", selector.strip()) if s]


def _fits(e: _Element, step: list[tuple[str, str, str, str, str]]) -> bool:
    for tag, ident, cls, attr, value in step:
        if tag and tag != "*" and e.tag != tag.lower():
            return False
        if ident and e.attrs.get("id") != ident or cls and cls not in e.attrs.get("class", "").split():
            return False
        if attr and (attr not in e.attrs or value and e.attrs[attr] != value):
            return False
    return True


def _matches(e: _Element, steps: list) -> bool:
    if not _fits(e, steps[-1]):
        return False
    above, left = e.parent, len(steps) - 2
    while above is not None and left >= 0:
        left -= _fits(above, steps[left])
        above = above.parent
    return left < 0


def fields_of(html: str | None, template: list[tuple[Field, list]]) -> list[str | None]:
    page = _Page(html or "")
    out = []
    for field, steps in template:
        found = []
        for e in page.elements:
            if steps and _matches(e, steps):
                if field.value_type == "text":
                    v = " ".join("".join(page.texts[e.text_from : e.text_to]).split())
                elif field.value_type == "html":
                    v = page.html[e.start : e.end]
                else:
                    v = e.attrs.get(field.value_type)
                if v is not None:
                    for w in field.exclude:
                        v = v.replace(w, "")
                    if v.strip() and v.strip() not in found:
                        found.append(v.strip())
                if found and not field.many:
                    break
        out.append("||".join(found) if found else None)
    return out


def extracted(pages: DataFrame, template: list[Field], html: str = "html") -> DataFrame:
    """`pages` without the HTML, with a text column for each field."""
    kept = [f for f in pages.schema.fields if f.name != html]
    steps = [(f, _steps(f.selector)) for f in template]

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [fields_of(h, steps) for h in batch[html]]
            made = pd.DataFrame(rows, columns=[f.name for f in template], index=batch.index, dtype=object)
            yield pd.concat([batch[[f.name for f in kept]], made], axis=1)

    return pages.mapInPandas(run, T.StructType([*kept, *[T.StructField(f.name, T.StringType()) for f in template]]))


@dataclass(frozen=True)
class Cell:
    """A value of a table row: in its cell, the child of kind `child` at `nth` (from 0) if given, and in that the first
    element of `selector` if given."""

    name: str
    at: int
    child: str = ""
    nth: int = 0
    selector: str = ""


def _cell_text(page: _Page, inside: dict[int, list[_Element]], cell: _Element, want: Cell) -> str | None:
    """The text in which `want` is found, without blanks around it; None if it is empty or absent."""
    at: _Element | None = cell
    if want.child:
        same = [e for e in inside.get(id(cell), []) if e.tag == want.child]
        at = same[want.nth] if want.nth < len(same) else None
    if at is not None and want.selector:
        steps, below = _steps(want.selector), []
        open_ = list(reversed(inside.get(id(at), [])))
        while open_:
            below.append(open_.pop())
            open_ += reversed(inside.get(id(below[-1]), []))
        at = next((e for e in below if _matches(e, steps)), None)
    return (" ".join("".join(page.texts[at.text_from : at.text_to]).split()) or None) if at is not None else None


def rows_of(html: str | None, rows: list, cells: list[Cell], least: int) -> list[list[str | None]]:
    page, inside = _Page(html or ""), {}
    for e in page.elements:
        inside.setdefault(id(e.parent), []).append(e)
    out = []
    for e in page.elements:
        if _matches(e, rows):
            own = [c for c in inside.get(id(e), []) if c.tag == "td"]
            if len(own) >= least:
                out.append([_cell_text(page, inside, own[c.at], c) for c in cells])
    return out


def table_rows(pages: DataFrame, rows: str, cells: list[Cell], least: int, html: str = "html") -> DataFrame:
    """One row for each table row of the pages that `rows` selects and that has `least` cells or more: the other columns
    of the page, `place` among its rows, and a text column for each cell. Null pages and those without a table give none."""
    kept = [f for f in pages.schema.fields if f.name != html]
    steps, names = _steps(rows), [c.name for c in cells]
    if max(c.at for c in cells) >= least:
        raise ValueError("a cell beyond the least number of cells")

    def run(batches: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [rows_of(h, steps, cells, least) for h in batch[html]]
            repeated = batch[[f.name for f in kept]].loc[batch.index.repeat([len(f) for f in found])].reset_index(drop=True)
            made = pd.DataFrame([r for f in found for r in f], columns=names, dtype=object)
            places = pd.Series([i for f in found for i in range(len(f))], name="place", dtype="int32")
            yield pd.concat([repeated, places, made], axis=1)

    return pages.mapInPandas(run, T.StructType([*kept, T.StructField("place", T.IntegerType()), *[T.StructField(n, T.StringType()) for n in names]]))


def by_patterns(text: Column, patterns: dict[str, str]) -> dict[str, Column]:
    """For each label all matches of its pattern's first group (or of all of it), in order."""
    return {label: F.regexp_extract_all(text, F.lit(p), F.lit(1 if re.compile(p).groups else 0)) for label, p in patterns.items()}
