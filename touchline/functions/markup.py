"""Rows of the schedule table of one page.

The only Python that touches data. It tokenises one page and returns its table
rows as cells; all mapping of cells to columns happens in Spark expressions.
"""

from __future__ import annotations

import re
from html import unescape

from touchline.functions import fixed_values as fixed

_VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input",
    "link", "meta", "param", "source", "track", "wbr",
}
_NO_TEXT = {"script", "style"}
_RAW_END = {tag: re.compile(rf"</{tag}\s*>", re.IGNORECASE) for tag in _NO_TEXT}
_TOKEN = re.compile(
    r"""<!--.*?(?:-->|\Z)                       # comment
      | <[!?][^>]*(?:>|\Z)                      # declaration
      | <(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:"[^"]*"|'[^']*'|[^>"']|["'])*+)(?P<end>>|\Z)
      | (?P<text>[^<]+|<)                       # text, or a stray bracket
    """,
    re.VERBOSE | re.DOTALL,
)
_HAS_TABLE = re.compile(r"<table\b", re.IGNORECASE)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_ANCESTORS = 5


class Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag, attrs, parent):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self):
        """This element's descendants in page order; text comes as ``str``."""
        stack = list(reversed(self.children))
        while stack:
            item = stack.pop()
            yield item
            if isinstance(item, Node):
                stack.extend(reversed(item.children))

    def all(self, tag):
        """Descendants with a tag, in page order."""
        found, stack = [], self.children[::-1]
        while stack:
            item = stack.pop()
            if item.__class__ is Node:
                if item.tag == tag:
                    found.append(item)
                if item.children:
                    stack += item.children[::-1]
        return found

    def classes(self):
        return (self.attrs.get("class") or "").split()

    def strings(self):
        """Pieces of text, in page order."""
        if len(self.children) == 1 and self.children[0].__class__ is str:
            return self.children
        found, stack = [], self.children[::-1]
        while stack:
            item = stack.pop()
            if item.__class__ is Node:
                stack += item.children[::-1]
            else:
                found.append(item)
        return found


def parse(html: str) -> Node:
    """Element tree of a page; unclosed elements end with their parent."""
    root = here = Node("", {}, None)
    position, size = 0, len(html)
    while position < size:
        token = _TOKEN.match(html, position)
        position = token.end()
        closing, tag, attributes, words, end = token.group("close", "tag", "attrs", "text", "end")
        if words is not None:
            here.children.append(unescape(words) if "&" in words else words)
        elif not end:  # a comment, a declaration, or a tag that the page breaks off
            continue
        elif closing:
            tag = tag.lower()
            node = here
            while node is not None and node.tag != tag:
                node = node.parent
            if node is not None and node.parent is not None:
                here = node.parent
        else:
            tag = tag.lower()
            node = Node(tag, _attributes(attributes) if attributes else {}, here)
            here.children.append(node)
            if tag in _NO_TEXT:
                end = _RAW_END[tag].search(html, position)
                position = end.end() if end else size
            elif tag not in _VOID and not attributes.endswith("/"):
                here = node
    return root


def _attributes(written: str) -> dict[str, str]:
    found = {}
    for name, value in _ATTRIBUTE.findall(written):
        if value[:1] in ("'", '"'):
            value = value[1:-1]
        found[name.lower()] = unescape(value) if "&" in value else value
    return found


def _tight(node: Node) -> str:
    """Text with every piece stripped before joining."""
    return "".join(s.strip() for s in node.strings())


def _loose(node: Node) -> str:
    """Text joined as written, stripped at the ends only."""
    return "".join(node.strings()).strip()


def _labelled(cell: Node) -> bool:
    """Whether the label mark occurs anywhere in the cell, tags and text included."""
    label = fixed.CELL_LABEL_ATTRIBUTE
    stack = [cell]
    while stack:
        item = stack.pop()
        if item.__class__ is not Node:
            if label in item:
                return True
        else:
            if item.attrs and label in " ".join(item.attrs):
                return True
            stack += item.children
    return False


def _cells(found: list[Node], text) -> list[tuple[str, str]]:
    label = fixed.CELL_LABEL_ATTRIBUTE
    return [(c.attrs.get(label, "").strip().lower() if c.attrs else "", text(c)) for c in found]


def _schedule_table(root: Node) -> Node | None:
    tables = root.all("table")
    tests = [lambda t, i=i: t.attrs.get("id") == i for i in fixed.SCHEDULE_TABLE_IDS]
    tests.append(lambda t: fixed.SCHEDULE_TABLE_CLASS in t.classes())
    tests.append(lambda t: any(fixed.BASE_TABLE_CLASS in c for c in t.classes()))
    for test in tests:
        for table in tables:
            if test(table):
                return table
    return None


def schedule_rows(html: str):
    """(row number, labelled layout?, cells) below the header of the schedule table."""
    if not _HAS_TABLE.search(html):
        return
    table = _schedule_table(parse(html))
    if table is None:
        return
    for number, row in enumerate(table.all("tr")):
        if number == 0:
            continue
        found = row.all("td")
        if found:
            yield number, _labelled(found[0]), _cells(found, _tight)


def _near_header(parent: Node | None) -> Node | None:
    for _ in range(_ANCESTORS):
        if parent is None:
            return None
        for table in parent.all("table"):
            if fixed.BASE_TABLE_CLASS in table.classes():
                return table
        parent = parent.parent
    return None


def _owners_of(node: Node, needle: str):
    """Elements whose own text holds ``needle``, once per piece of text."""
    stack = [node]
    while stack:
        item = stack.pop()
        for child in item.children:
            if isinstance(child, str) and needle in child:
                yield item
        stack.extend(reversed([c for c in item.children if isinstance(c, Node)]))


def event_rows(html: str):
    """(row number, found through a header?, cells) of the day-event layout."""
    if not _HAS_TABLE.search(html):
        return
    root = parse(html)
    number = 0
    for owner in _owners_of(root, fixed.EVENTS_HEADER):
        table = _near_header(owner)
        for row in table.all("tr") if table is not None else []:
            cells = row.all("td")
            if len(cells) >= 4:
                number += 1
                yield number, True, _cells(cells, _loose)
    if number:
        return
    for table in root.all("table"):
        if fixed.BASE_TABLE_CLASS not in table.classes():
            continue
        for row in table.all("tr"):
            cells = row.all("td")
            if len(cells) >= 4:
                number += 1
                yield number, False, _cells(cells, _loose)


def grid_rows(html: str):
    """(row number, False, cells) of the plain grid; rows with header cells are left out."""
    if fixed.GRID_TABLE_ID not in html:
        return
    for node in parse(html).walk():
        if isinstance(node, Node) and node.attrs.get("id") == fixed.GRID_TABLE_ID:
            for number, row in enumerate(node.all("tr")):
                if not row.all("th"):
                    yield number, False, _cells(row.all("td"), _tight)
            return


LAYOUTS = {"schedule": schedule_rows, "events": event_rows, "grid": grid_rows}
