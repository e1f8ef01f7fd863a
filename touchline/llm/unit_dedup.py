"""Repeated passages inside documents, by hashing of lines, sentences, runs of short units and windows of words.

A unit starts with a line, after the end of a sentence, and at a word in upper
case. A unit with fewer than ``MIN_WORDS`` words says little alone, so it is
hashed together with the units before it, and with those after it, until there
are enough words; a whole line counts from ``LINE_WORDS`` words on. Words are
compared in lower case and without regard to the white space between them.

A passage need not hold whole units, so every window of ``WINDOW`` words that
occurs elsewhere is compared too, whatever its letters and marks. Storing all
windows would cost a row per word; instead each window names its smallest run
of ``ANCHOR`` words, two windows with the same words name the same one, and
only windows whose run stands at two places or more are hashed.

Digests are grouped over all documents. The earliest occurrence, by document
key and then by place, stays; every other one is removed. A passage of
``WINDOW`` words or more is found wherever it stands, up to its first and last
repeated word. Of shorter ones, what makes up lines or runs of units is found.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.sources.scratch import staged

MIN_WORDS = 10
LINE_WORDS = 5
WINDOW = 50
ANCHOR = 20
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_ENDS = r"[.!?\x{2026}][\"'\x{201d}\x{2019})\]]*\z"
_BATCH_ROWS = 1000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _words(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Of all words in order: the document, whether a line starts, whether a unit starts, and the hash."""
    import xxhash

    lines = pc.split_pattern(pc.fill_null(texts, ""), "\n")
    per_doc = pc.list_value_length(lines).to_numpy(zero_copy_only=False).astype(np.int64)
    split = pc.ascii_split_whitespace(lines.flatten())
    per_line = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    line = np.repeat(np.arange(len(per_line)), per_line)
    coded = split.flatten().dictionary_encode()
    distinct, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
    filled = pc.not_equal(distinct, "").to_numpy(zero_copy_only=False)[codes] if len(distinct) else np.zeros(0, bool)
    line, codes = line[filled], codes[filled]
    doc = np.repeat(np.arange(len(per_doc)), per_doc)[line]
    if not len(codes):
        return doc, np.zeros(0, bool), np.zeros(0, bool), np.zeros(0, np.uint64)
    upper = pc.utf8_is_upper(pc.utf8_slice_codeunits(distinct, 0, 1)).to_numpy(zero_copy_only=False)[codes]
    ends = pc.match_substring_regex(distinct, _ENDS).to_numpy(zero_copy_only=False)[codes]
    hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in pc.utf8_lower(distinct).to_pylist()], np.uint64)[codes]
    first = np.concatenate([[True], line[1:] != line[:-1]])
    return doc, first, first | upper | np.concatenate([[True], ends[:-1]]), hashes


def _digests(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, bases: tuple = _BASES) -> list[np.ndarray]:
    """128 bits per word range, as two columns, from running sums of word hashes times powers of a base."""
    out = []
    for base in bases:
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        powers = np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(hashes), base))])
        back = np.concatenate([[np.uint64(1)], np.cumprod(np.full(len(hashes), inverse))])
        sums = np.concatenate([[np.uint64(0)], np.cumsum(_mix(hashes ^ base) * powers[:-1])])
        out.append(_mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64)))
    return out


def _extents(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and end word of each document; ``doc`` must not be empty."""
    bounds = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1], [True]]))
    begin, stop = np.zeros(doc[-1] + 1, np.int64), np.zeros(doc[-1] + 1, np.int64)
    begin[doc[bounds[:-1]]], stop[doc[bounds[:-1]]] = bounds[:-1], bounds[1:]
    return begin, stop


def _anchored(doc: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First words of all windows, and the first word of the smallest run in each.

    Of equal runs the last one counts. Nothing outside a window decides on its run.
    """
    starts = np.arange(max(0, len(doc) - WINDOW + 1))
    starts = starts[doc[starts] == doc[starts + WINDOW - 1]]
    if not len(starts):
        return starts, starts
    at = np.arange(len(doc) - ANCHOR + 1)
    digest = _digests(hashes, at, at + ANCHOR, _BASES[:1])[0]
    low = np.uint64(0xFFFFFFFF)
    least, wide, n = (digest & ~low) | (low - at.astype(np.uint64)), 1, WINDOW - ANCHOR + 1
    while wide < n:  # the minimum of ``n`` neighbours, by doubling
        step = min(wide, n - wide)
        least, wide = np.minimum(least[:-step], least[step:]), wide + step
    return starts, (low - (least[starts] & low)).astype(np.int64)


def anchors_of(texts: pa.Array) -> tuple[np.ndarray, ...]:
    """Like :func:`runs_of`, the runs that windows name, once each."""
    doc, _first, _opens, hashes = _words(texts)
    named = np.unique(_anchored(doc, hashes)[1])
    start = named - _extents(doc)[0][doc[named]] if len(named) else named
    return doc[named], start, start + ANCHOR, *_digests(hashes, named, named + ANCHOR)


def windows_of(texts: pa.Array, shared: pa.Array) -> tuple[np.ndarray, ...]:
    """Like :func:`runs_of`, the windows whose run starts at one of the words listed for their document."""
    doc, _first, _opens, hashes = _words(texts)
    starts, named = _anchored(doc, hashes)
    if not len(starts):
        return starts, starts, starts, *_digests(hashes, starts, starts)
    begin, stop = _extents(doc)
    found = np.zeros(len(doc), bool)
    of = np.repeat(np.arange(len(shared)), pc.fill_null(pc.list_value_length(shared), 0).to_numpy(zero_copy_only=False))
    within = shared.flatten().to_numpy(zero_copy_only=False)
    fits = of < len(begin)
    of, within = of[fits], within[fits]
    # Rows that share a key share their lists, so a place may lie behind the end of a text.
    fits = within < (stop - begin)[of]
    found[begin[of[fits]] + within[fits]] = True
    a = starts[found[named]]
    one, two = _digests(hashes, a, a + WINDOW)
    return doc[a], a - begin[doc[a]], a - begin[doc[a]] + WINDOW, one, two


def runs_of(texts: pa.Array, min_words: int = MIN_WORDS, line_words: int = LINE_WORDS) -> tuple[np.ndarray, ...]:
    """Runs to compare: document number, first word, end word (both counted inside the document), two digest columns."""
    doc, first, opens, hashes = _words(texts)
    if not len(doc):
        none = np.zeros(0, np.int64)
        return none, none, none, none.view(np.uint64), none.view(np.uint64)
    n = len(doc)
    begin, stop = _extents(doc)

    starts = np.flatnonzero(opens)
    ends = np.concatenate([starts[1:], [n]])
    before = np.searchsorted(starts, ends - min_words, side="right") - 1
    after = np.searchsorted(ends, starts + min_words, side="left")
    left = (before >= 0) & (starts[np.maximum(before, 0)] >= begin[doc[starts]])
    right = (after < len(ends)) & (ends[np.minimum(after, len(ends) - 1)] <= stop[doc[starts]])
    lines = np.flatnonzero(first)
    line_ends = np.concatenate([lines[1:], [n]])
    whole = line_ends - lines >= line_words
    a = np.concatenate([starts[before[left]], starts[right], lines[whole]])
    b = np.concatenate([ends[left], ends[after[right]], line_ends[whole]])
    spans = np.unique(np.stack([a, b]), axis=1) if len(a) else np.zeros((2, 0), np.int64)
    a, b = spans
    one, two = _digests(hashes, a, b)
    return doc[a], a - begin[doc[a]], b - begin[doc[a]], one, two


_RUN = "one long, two long, doc long, span long, anchor boolean"


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, whole.num_rows, _BATCH_ROWS):
            yield whole.slice(at, _BATCH_ROWS)


def _rows(batch: pa.RecordBatch, anchor: bool, doc: np.ndarray, start: np.ndarray, end: np.ndarray, *digest: np.ndarray) -> pa.RecordBatch:
    one, two = (pa.array(d.view(np.int64)) for d in digest)
    columns = [one, two, batch.column(0).take(pa.array(doc)), pa.array((start << 32) | end), pa.array(np.full(len(doc), anchor))]
    return pa.RecordBatch.from_arrays(columns, ["one", "two", "doc", "span", "anchor"])


def _repeated(rows: DataFrame) -> DataFrame:
    """``(doc, span, anchor)`` of the runs that occur earlier, and of all anchors that stand at two places.

    Rows of a digest stream past in order, so that a digest of any number of rows takes no memory.
    """
    inside = Window.partitionBy("one", "two", "anchor").orderBy("doc", "span")
    before = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    near = F.lag("doc").over(inside).isNotNull() | F.lead("doc").over(inside).isNotNull()
    placed = rows.withColumns({"first": F.first(F.struct("doc", "span")).over(before), "near": near})
    start, end = F.shiftright("span", 32), F.col("span").bitwiseAND(F.lit(0xFFFFFFFF))
    again = (F.col("doc") > F.col("first.doc")) | (start >= F.shiftright("first.span", 32) + end - start)
    return placed.where(F.when(F.col("anchor"), F.col("near")).otherwise(again)).select("doc", "span", "anchor")


def _spans(docs: DataFrame, min_words: int, line_words: int) -> DataFrame:
    """``(doc, span)``: all word ranges to remove."""

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            yield _rows(batch, False, *runs_of(batch.column(1), min_words, line_words))
            yield _rows(batch, True, *anchors_of(batch.column(1)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            yield _rows(batch, False, *windows_of(batch.column(1), batch.column(2)))

    docs = docs.where("doc IS NOT NULL").select("doc", "body")
    # Only what is repeated is stored.
    found = staged(_repeated(docs.mapInArrow(index, _RUN)), "repeated")
    places = found.where("anchor").groupBy("doc").agg(F.collect_set(F.shiftright("span", 32)).alias("places"))
    windows = _repeated(docs.join(places, "doc").select("doc", "body", "places").mapInArrow(compare, _RUN))
    windows = staged(windows, "windows")  # frees the shuffle of all windows before the texts are read again
    return found.where("not anchor").unionByName(windows).select("doc", "span")


def _cut(text: str, spans: list[int]) -> tuple[str, list[tuple[int, int]]]:
    """What is left of a text, and the code points removed: each range goes up to the next word that stays."""
    places = [m.span() for m in _WORD.finditer(text)]
    gone, ranges = np.zeros(len(places) + 1, np.int64), np.array(spans, np.int64)
    np.add.at(gone, ranges >> 32, 1)
    np.add.at(gone, ranges & 0xFFFFFFFF, -1)
    dropped = np.cumsum(gone)[:-1] > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], dropped.astype(np.int8), [0]])))
    cuts, kept, at = [], [], 0
    for first, end in edges.reshape(-1, 2).tolist():
        start, stop = places[first][0], places[end][0] if end < len(places) else len(text)
        kept.append(text[at:start])
        cuts.append((start, stop))
        at = stop
    return "".join([*kept, text[at:]]), cuts


def remove_repeats(
    docs: DataFrame, key: str = "doc_id", text: str = "text", min_words: int = MIN_WORDS, line_words: int = LINE_WORDS
) -> DataFrame:
    """``docs`` with ``text`` freed of repeats, and ``removed``, their offsets in the original text.

    The key must be a whole number; smaller ones come first. Null texts stay
    null, empty ones empty. Rows that share a key count as one document, so
    they do not take text from each other; rows without a key are left as
    they are and take part in nothing. Other columns stay, a column
    ``removed`` is replaced. An empty table gives an empty table.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).alias("body"))
    spans = _spans(rows, min_words, line_words).groupBy("doc").agg(F.collect_set("span").alias("__llm_spans"))

    @F.arrow_udf("struct<text:string,removed:array<struct<start:int,end:int>>>")
    def freed(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out, cuts = [], []
        for body, found in zip(texts.to_pylist(), lists.to_pylist(), strict=True):
            left, gone = _cut(body, found) if body and found else (body, [])
            out.append(left)
            cuts.append([{"start": a, "end": b} for a, b in gone])
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        return pa.StructArray.from_arrays([pa.array(out, pa.string()), pa.array(cuts, kind)], ["text", "removed"])

    base = docs.drop("removed") if text != "removed" else docs
    spans = spans.withColumnRenamed("doc", "__llm_doc")
    joined = base.join(spans, F.col(key).cast("bigint") == F.col("__llm_doc"), "left")
    done = joined.withColumn("__llm_freed", freed(F.col(text), F.col("__llm_spans")))
    columns = [F.col("__llm_freed.text").alias(c) if c == text else F.col(f"`{c}`") for c in base.columns]
    return done.select(*columns, F.col("__llm_freed.removed").alias("removed"))
