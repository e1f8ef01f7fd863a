"""Table rows of many pages at once: the tokens of a batch of pages as numpy arrays.

Gives what :mod:`touchline.functions.page_scan` gives. It takes the pages whose
elements close in the order in which they open and whose table holds no row in
a row and no cell in a cell; an element then is a run of tokens, and rows, cells
and text are found by comparing token numbers. It names all other pages, which
are left to the scan.
"""

from __future__ import annotations

import re
from functools import lru_cache
from html import unescape

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from touchline.functions import fixed_values as fixed
from touchline.functions.markup import _NO_TEXT, _VOID, _attributes

BATCH_BYTES, BATCH_PAGES = 4_000_000, 1024
_LT, _GT, _DOUBLE, _SINGLE, _AMP, _CONTROL = range(1, 7)
_CLASS = np.zeros(256, np.uint8)
_CLASS[:32] = _CONTROL
_CLASS[[9, 10, 13]] = 0
_CLASS[[ord(c) for c in "<>\"'&"]] = [_LT, _GT, _DOUBLE, _SINGLE, _AMP]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 13, 32]] = True
_NAME_END = _SPACE.copy()
_NAME_END[[ord("/"), ord(">")]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_STEP = np.uint64(0x100000001B3)
_MARK = re.compile(fixed.CELL_LABEL_ATTRIBUTE.encode(), re.IGNORECASE)
_GRID = re.compile(re.escape(fixed.GRID_TABLE_ID.encode()))


def _code(name: str) -> np.uint64:
    code = 0
    for byte in name.encode():
        code = (code * int(_STEP) + byte) % 2**64
    return np.uint64(code)


_TABLE, _TR, _TD, _TH = (_code(n) for n in ("table", "tr", "td", "th"))
_VOID_CODES = np.array([_code(n) for n in sorted(_VOID)])
_RAW_CODES = np.array([_code(n) for n in sorted(_NO_TEXT)])


@lru_cache(4096)
def _attrs(written: bytes) -> dict[str, str]:
    return _attributes(written.decode())


@lru_cache(4096)
def _cell_mark(written: bytes) -> tuple[str, bool]:
    attrs, mark = _attrs(written), fixed.CELL_LABEL_ATTRIBUTE
    return attrs.get(mark, "").strip().lower(), mark in " ".join(attrs)


@lru_cache(4096)
def _table_rank(written: bytes) -> int | None:
    """Which of the tests for the schedule table an element meets first."""
    attrs = _attrs(written)
    classes = (attrs.get("class") or "").split()
    if attrs.get("id") in fixed.SCHEDULE_TABLE_IDS:
        return fixed.SCHEDULE_TABLE_IDS.index(attrs["id"])
    if fixed.SCHEDULE_TABLE_CLASS in classes:
        return len(fixed.SCHEDULE_TABLE_IDS)
    return len(fixed.SCHEDULE_TABLE_IDS) + 1 if any(fixed.BASE_TABLE_CLASS in c for c in classes) else None


@lru_cache(65536)
def _words(raw: bytes) -> str:
    return unescape(raw.decode())


@lru_cache(65536)
def _clean(raw: bytes) -> str:
    return unescape(raw.decode()).strip()


class _Tokens:
    """Tokens of the pages that can be read this way, in order, and ``bad``: the pages that cannot."""

    def __init__(self, pages: pa.Array) -> None:
        pages = pc.fill_null(pages.cast(pa.string()), "")
        _, ends, buffer = pages.buffers()
        offsets = np.frombuffer(ends, np.int32)[pages.offset : pages.offset + len(pages) + 1].astype(np.int64)
        whole = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
        self.data = whole[offsets[0] : offsets[-1]]
        self.raw = memoryview(self.data)
        self.offsets = offsets - offsets[0]
        self.bad = np.zeros(len(pages), bool)
        self._find()
        self._name()
        self._pair()

    def _page(self, positions: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, positions, "right") - 1

    def _keep(self, kept: np.ndarray, *names: str) -> None:
        for name in names:
            setattr(self, name, getattr(self, name)[kept])

    def _find(self) -> None:
        """Where tags start and end; a tag that a bracket or a quote may run on from makes its page bad."""
        kind = _CLASS[self.data]
        self.kind = kind
        self.bad[self._page(np.flatnonzero(kind == _CONTROL))] = True
        start, closes = np.flatnonzero(kind == _LT), np.flatnonzero(kind == _GT)
        page = self._page(start)
        at = np.searchsorted(closes, start)
        end = np.append(closes, len(self.data))[at]
        limit = np.minimum(np.append(start[1:], len(self.data)), self.offsets[page + 1])
        self.bad[page[end >= limit]] = True
        fine = ~self.bad[page]
        self.start, self.end, self.limit, self.page = start[fine], end[fine], limit[fine], page[fine]

    def _name(self) -> None:
        data, start, end = self.data, self.start, self.end
        after = data[start + 1]
        self.closing = after == ord("/")
        declared = (after == ord("!")) | (after == ord("?"))
        first = start + 1 + self.closing
        letter = (data[first] | 32) - ord("a") < 26
        wrong = ~declared & ~letter
        comment = np.flatnonzero(declared & (end - start >= 3))
        comment = comment[(data[start[comment] + 2] == ord("-")) & (data[start[comment] + 3] == ord("-"))]
        inner = end[comment] - 2
        wrong[comment] = (inner < start[comment] + 4) | (data[inner] != ord("-")) | (data[inner + 1] != ord("-"))
        code, length = np.zeros(len(start), np.uint64), np.zeros(len(start), np.int64)
        alive = np.flatnonzero(~declared & letter)
        while len(alive):
            byte = data[first[alive] + length[alive]]
            going = ~_NAME_END[byte]
            alive, byte = alive[going], byte[going]
            wrong[alive[byte >= 128]] = True
            code[alive] = code[alive] * _STEP + _LOWER[byte]
            length[alive] += 1
        self.code, self.words = code, first + length
        # Quotes of one sort, all closed, cannot hide the end of the tag.
        held = np.flatnonzero(~declared & (self.words < end))
        counts = []
        for quote in (_DOUBLE, _SINGLE):
            places = np.flatnonzero(self.kind == quote)
            counts.append(np.searchsorted(places, end[held]) - np.searchsorted(places, start[held]))
        wrong[held] |= (counts[0] % 2 == 1) | (counts[1] % 2 == 1) | ((counts[0] > 0) & (counts[1] > 0))
        opening = ~declared & ~self.closing
        self.alone = opening & (self.words < end) & (data[end - 1] == ord("/")) | opening & np.isin(code, _VOID_CODES)
        # The text of a script ends at the next tag, or the page is bad.
        raw = np.flatnonzero(opening & np.isin(code, _RAW_CODES))
        self.mute = np.zeros(len(start), bool)
        self.mute[raw] = True
        follow = np.minimum(raw + 1, len(start) - 1)
        ended = (follow > raw) & (self.page[follow] == self.page[raw]) & self.closing[follow]
        wrong[raw] |= ~(ended & (code[follow] == code[raw]) & (self.words[follow] == end[follow]))
        self.alone[raw] = True
        self.effect = np.where(self.closing, -1, 1)
        self.effect[declared | self.alone | (self.closing & np.isin(code, _VOID_CODES))] = 0
        self.effect[follow[ended]] = 0
        self.opening = opening
        self._drop(wrong)

    def _drop(self, wrong: np.ndarray) -> None:
        self.bad[self.page[wrong]] = True
        names = ("start", "end", "limit", "page", "closing", "code", "words", "alone", "mute", "effect", "opening")
        self._keep(~self.bad[self.page], *names)

    def _pair(self) -> None:
        """``last``: number of the token that ends an element; the page's end if none does, itself if it holds nothing."""
        count = len(self.start)
        total = np.cumsum(self.effect)
        head = np.searchsorted(self.page, self.page)
        depth = total - (total - self.effect)[head] if count else total
        wrong = depth < 0
        moved = np.flatnonzero(self.effect)
        level = np.where(self.effect[moved] > 0, depth[moved], depth[moved] + 1)
        key = self.page[moved] * (count + 2) + level
        order = np.argsort(key, kind="stable")
        token, key = moved[order], key[order]
        close = np.flatnonzero(self.effect[token] < 0)
        ended, opener = token[close], token[close - 1]
        fits = (close > 0) & (key[close - 1] == key[close]) & (self.effect[opener] > 0) & (self.code[opener] == self.code[ended])
        wrong[ended[~fits]] = True
        last = np.where(self.effect > 0, np.searchsorted(self.page, self.page, "right"), np.arange(count))
        last[opener[fits]] = ended[fits]
        self.last = last
        self.bad[self.page[wrong]] = True

    def written(self, token: int) -> bytes:
        return bytes(self.raw[self.words[token] : self.end[token]])


def _schedule_tables(t: _Tokens) -> dict[int, int]:
    chosen: dict[int, tuple[int, int]] = {}
    for token in np.flatnonzero(t.opening & (t.code == _TABLE)).tolist():
        rank, page = _table_rank(t.written(token)), int(t.page[token])
        if rank is not None and (page not in chosen or rank < chosen[page][0]):
            chosen[page] = (rank, token)
    return {page: token for page, (_, token) in chosen.items()}


def _grids(t: _Tokens) -> dict[int, int]:
    places = np.array([m.start() for m in _GRID.finditer(t.raw)], np.int64)
    asked = np.zeros(len(t.bad), bool)
    asked[t._page(places)] = True
    references = np.flatnonzero(t.kind == _AMP)
    references = references[asked[t._page(references)]]
    places = np.union1d(places, references)  # an id may be written with references
    token = np.unique(np.searchsorted(t.start, places, "right") - 1)
    chosen: dict[int, int] = {}
    for i in token[token >= 0].tolist():
        page = int(t.page[i])
        if page not in chosen and t.opening[i] and asked[page] and _attrs(t.written(i)).get("id") == fixed.GRID_TABLE_ID:
            chosen[page] = i
            t.bad[page] |= bool(t.alone[i])
    return chosen


LAYOUTS = {"schedule": _schedule_tables, "grid": _grids}


def _ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """All positions of all ranges, one range after the other."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(lengths.sum())


def _labelled(t: _Tokens, cell: int) -> bool:
    """Whether the mark stands in the attributes or in the text of a cell."""
    mark = fixed.CELL_LABEL_ATTRIBUTE
    for i in range(cell, max(t.last[cell], cell + 1)):
        if t.opening[i] and mark in " ".join(_attrs(t.written(i))):
            return True
        if i < t.last[cell] and not t.mute[i] and mark in _words(bytes(t.raw[t.end[i] + 1 : t.limit[i]])):
            return True
    return False


def parts(pages: pa.Array):
    """(start, count) of runs of pages that are read at once: some megabytes of text, one page at least."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(pages), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(pages):
        before = sizes[start - 1] if start else 0
        stop = min(max(int(np.searchsorted(sizes, before + BATCH_BYTES, "right")), start + 1), start + BATCH_PAGES)
        stop = min(stop, len(pages))
        yield start, stop - start
        start = stop


def rows(pages: pa.Array, layout: str):
    """(page, row number, labelled?, first cell of each row and the end, labels, texts), and the pages left out."""
    t = _Tokens(pages)
    tables = LAYOUTS[layout](t)
    table = np.full(len(t.bad), -1)
    table[list(tables)] = list(tables.values())
    own = table[t.page]  # the table of the token's page
    number = np.arange(len(t.start))
    inside = (own >= 0) & (number > own) & (number < t.last[own]) & t.opening
    row, cell = np.flatnonzero(inside & (t.code == _TR)), np.flatnonzero(inside & (t.code == _TD))
    for element in (row, cell):
        nested = (t.last[element[:-1]] > element[1:]) & (t.page[element[:-1]] == t.page[element[1:]])
        t.bad[t.page[element[:-1][nested]]] = True
    row, cell = row[~t.bad[t.page[row]]], cell[~t.bad[t.page[cell]]]
    row_no = np.arange(len(row)) - np.searchsorted(t.page[row], t.page[row])

    def row_of(tokens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(row, tokens) - 1
        return at, (at >= 0) & (tokens < t.last[row[at]]) if len(row) else np.zeros(len(tokens), bool)

    at, held = row_of(cell)
    cell, at = cell[held], at[held]
    counts = np.bincount(at, minlength=len(row))
    if layout == "grid":
        header, held = row_of(np.flatnonzero(inside & (t.code == _TH)))
        kept = np.ones(len(row), bool)
        kept[header[held]] = False
    else:
        kept = (row_no > 0) & (counts > 0)
    cell = cell[kept[at]]
    row, row_no, counts = row[kept], row_no[kept], counts[kept]
    ends = np.append(0, np.cumsum(counts)).astype(np.int32)

    labels, marked = _labels(t, cell)
    texts = _texts(t, cell)
    marks = np.zeros(len(row), bool)
    if layout == "schedule" and len(row):
        first = cell[ends[:-1]]
        marks = marked[ends[:-1]]
        # Elsewhere in the first cell the mark has to be looked for only if it is there, or a reference that may give it.
        hints = np.array([m.start() for m in _MARK.finditer(t.raw)], np.int64)
        hints = np.union1d(hints, np.flatnonzero(t.kind == _AMP))
        stop = np.append(t.start, len(t.data))[np.minimum(t.last[first], len(t.start))]
        maybe = np.searchsorted(hints, t.start[first]) < np.searchsorted(hints, np.maximum(stop, t.end[first]))
        for i in np.flatnonzero(maybe & ~marks).tolist():
            marks[i] = _labelled(t, int(first[i]))
    return t.page[row], row_no, marks, ends, labels, texts, np.flatnonzero(t.bad)


def _labels(t: _Tokens, cell: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    kinds, codes, marked = {"": 0}, np.zeros(len(cell), np.int64), np.zeros(len(cell), bool)
    for i in np.flatnonzero(t.words[cell] < t.end[cell]).tolist():
        label, marked[i] = _cell_mark(t.written(int(cell[i])))
        codes[i] = kinds.setdefault(label, len(kinds))
    return pa.array(list(kinds), pa.string()).take(pa.array(codes)), marked


def _texts(t: _Tokens, cell: np.ndarray) -> pa.Array:
    """Text of every cell: its pieces without the space around each."""
    token = _ranges(cell, np.maximum(t.last[cell] - cell, 0))
    owner = np.repeat(np.arange(len(cell)), np.maximum(t.last[cell] - cell, 0))
    begin, stop = t.end[token] + 1, t.limit[token]
    filled = (begin < stop) & ~t.mute[token]
    owner, begin, stop = owner[filled], begin[filled], stop[filled]
    left, right = begin.copy(), stop.copy()
    todo = np.arange(len(left))
    while len(todo):
        todo = todo[left[todo] < right[todo]]
        todo = todo[_SPACE[t.data[left[todo]]]]
        left[todo] += 1
    todo = np.arange(len(left))
    while len(todo):
        todo = todo[left[todo] < right[todo]]
        todo = todo[_SPACE[t.data[right[todo] - 1]]]
        right[todo] -= 1
    references = np.flatnonzero(t.kind == _AMP)
    hard = np.searchsorted(references, left) < np.searchsorted(references, right)
    some = np.flatnonzero(left < right)
    hard[some] |= (t.data[left[some]] >= 128) | (t.data[right[some] - 1] >= 128)
    lengths = right - left
    ends = np.append(0, np.cumsum(np.bincount(owner, lengths, len(cell)).astype(np.int64))).astype(np.int32)
    data = t.data[_ranges(left, lengths)]
    texts = pa.StringArray.from_buffers(len(cell), pa.py_buffer(ends), pa.py_buffer(data.tobytes()))
    special = np.zeros(len(cell), bool)
    special[owner[hard]] = True
    if not special.any():
        return texts
    # References, and space beyond ASCII at an end: by the text functions of Python.
    fixed_texts = dict.fromkeys(np.flatnonzero(special).tolist(), "")
    asked = np.flatnonzero(special[owner] & (left < right))
    for i, first, end in zip(owner[asked].tolist(), left[asked].tolist(), right[asked].tolist()):
        piece = _clean(bytes(t.raw[first:end]))
        fixed_texts[i] = fixed_texts[i] + piece if fixed_texts[i] else piece
    return pc.replace_with_mask(texts, pa.array(special), pa.array(list(fixed_texts.values()), pa.string()))
