"""Table rows of one page in one pass over its tokens, without an element tree.

A stack holds the open elements. Each ``tr`` joins the rows of every open
table (and of the open grid element), each ``td`` the cells of every open
``tr``, and each piece of text the cells of every open ``td``: exactly the
descendant relations the layouts ask for, found as the tokens go by. Elements
left open end with the element that closes around them. An element on the
stack learns the first base-class table inside it when that table opens, so the
header of the event layout finds its table among its five nearest ancestors
once the page is read. Only rows and cells are kept, never the page's structure.
"""

from __future__ import annotations

import re
from html import unescape

from touchline.functions import fixed_values as fixed
from touchline.functions.markup import _HAS_TABLE, _NO_TEXT, _RAW_END, _VOID, _attributes

# Attribute text in runs rather than letter by letter.
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)
      | <[!?][^>]*(?:>|\Z)
      | <(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^>"']++|["'])*+)(?P<end>>|\Z)
      | (?P<text>[^<]+|<)
    """,
    re.VERBOSE | re.DOTALL,
)
_ANCESTORS = 5


class _Element:
    __slots__ = ("tag", "attrs", "first_base", "rows", "opened")

    def __init__(self, tag: str, attrs: dict, opened: int) -> None:
        self.tag, self.attrs, self.first_base, self.rows, self.opened = tag, attrs, None, None, opened


class _Row:
    __slots__ = ("cells", "has_th")

    def __init__(self) -> None:
        self.cells, self.has_th = [], False


class _Cell:
    __slots__ = ("label", "pieces", "labelled")

    def __init__(self, attrs: dict) -> None:
        mark = fixed.CELL_LABEL_ATTRIBUTE
        self.label = attrs.get(mark, "").strip().lower() if attrs else ""
        self.pieces: list[str] = []
        self.labelled = bool(attrs) and mark in " ".join(attrs)

    def tight(self) -> str:
        return "".join(s.strip() for s in self.pieces)

    def loose(self) -> str:
        return "".join(self.pieces).strip()


class Scan:
    """What one pass over a page finds: tables with their rows, the grid's rows, header owners."""

    def __init__(self, html: str) -> None:
        self.tables: list[_Element] = []
        self.grid: _Element | None = None
        self.headers: list[list[_Element]] = []
        self._read(html)
        # Owners in the order of a walk from the top: by where they open, then their own pieces in turn.
        self.headers.sort(key=lambda chain: chain[0].opened)

    def _read(self, html: str) -> None:
        root = _Element("", {}, 0)
        stack, collectors, rows, cells = [root], [], [], []  # the last three hold (depth, item)
        mark, base_class, grid_id, needle = fixed.CELL_LABEL_ATTRIBUTE, fixed.BASE_TABLE_CLASS, fixed.GRID_TABLE_ID, fixed.EVENTS_HEADER
        position, size = 0, len(html)
        while position < size:
            token = _TOKEN.match(html, position)
            position = token.end()
            closing, tag, written, words, end = token.group("close", "tag", "attrs", "text", "end")
            if words is not None:
                if "&" in words:
                    words = unescape(words)
                for _, cell in cells:
                    cell.pieces.append(words)
                    if mark in words:
                        cell.labelled = True
                if needle in words:
                    self.headers.append(stack[-_ANCESTORS:][::-1])
                continue
            if not end:
                continue
            tag = tag.lower()
            if closing:
                depth = len(stack) - 1
                while depth > 0 and stack[depth].tag != tag:
                    depth -= 1
                if depth > 0:
                    del stack[depth:]
                    for held in (collectors, rows, cells):
                        while held and held[-1][0] >= depth:
                            held.pop()
                continue
            attrs = _attributes(written) if written else {}
            element = _Element(tag, attrs, position)
            if attrs and cells and mark in " ".join(attrs):
                for _, cell in cells:
                    cell.labelled = True
            depth = len(stack)
            if tag == "table":
                element.rows = []
                self.tables.append(element)
                if base_class in (attrs.get("class") or "").split():
                    for above in stack:
                        if above.first_base is None:
                            above.first_base = element
            if self.grid is None and attrs.get("id") == grid_id:
                self.grid = element
                element.rows = element.rows if element.rows is not None else []
            if tag == "tr":
                row = _Row()
                for _, holder in collectors:
                    holder.rows.append(row)
            elif tag == "td":
                cell = _Cell(attrs)
                for _, row in rows:
                    row.cells.append(cell)
            elif tag == "th":
                for _, row in rows:
                    row.has_th = True
            if tag in _NO_TEXT:
                stop = _RAW_END[tag].search(html, position)
                position = stop.end() if stop else size
                continue
            if tag in _VOID or written.endswith("/"):
                continue
            stack.append(element)
            if element.rows is not None:
                collectors.append((depth, element))
            if tag == "tr":
                rows.append((depth, row))
            elif tag == "td":
                cells.append((depth, cell))

    def schedule_table(self) -> _Element | None:
        tests = [lambda t, i=i: t.attrs.get("id") == i for i in fixed.SCHEDULE_TABLE_IDS]
        tests.append(lambda t: fixed.SCHEDULE_TABLE_CLASS in (t.attrs.get("class") or "").split())
        tests.append(lambda t: any(fixed.BASE_TABLE_CLASS in c for c in (t.attrs.get("class") or "").split()))
        for test in tests:
            for table in self.tables:
                if test(table):
                    return table
        return None


def schedule_rows(html: str):
    """(row number, labelled layout?, cells) below the header of the schedule table."""
    if not _HAS_TABLE.search(html):
        return
    table = Scan(html).schedule_table()
    for number, row in enumerate(table.rows if table is not None else []):
        if number and row.cells:
            first = row.cells[0]
            yield number, first.labelled, [(c.label, c.tight()) for c in row.cells]


def event_rows(html: str):
    """(row number, found through a header?, cells) of the day-event layout."""
    if not _HAS_TABLE.search(html):
        return
    scan, number = Scan(html), 0
    for chain in scan.headers:
        table = next((e.first_base for e in chain if e.first_base is not None), None)
        for row in table.rows if table is not None else []:
            if len(row.cells) >= 4:
                number += 1
                yield number, True, [(c.label, c.loose()) for c in row.cells]
    if number:
        return
    for table in scan.tables:
        if fixed.BASE_TABLE_CLASS in (table.attrs.get("class") or "").split():
            for row in table.rows:
                if len(row.cells) >= 4:
                    number += 1
                    yield number, False, [(c.label, c.loose()) for c in row.cells]


def grid_rows(html: str):
    """(row number, False, cells) of the plain grid; rows with header cells are left out."""
    if fixed.GRID_TABLE_ID not in html:
        return
    grid = Scan(html).grid
    for number, row in enumerate(grid.rows if grid is not None else []):
        if not row.has_th:
            yield number, False, [(c.label, c.tight()) for c in row.cells]


LAYOUTS = {"schedule": schedule_rows, "events": event_rows, "grid": grid_rows}
