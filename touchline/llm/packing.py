"""Vector best-fit packing of token pieces into sequences.

A piece takes up tokens, one document slot and an attention cost, the square
of its length, so all pieces of one length are alike. Packing therefore works
on the number of pieces per length, at most as many rows as a sequence has
tokens: the plan says how many sequences of each pattern there are, and each
piece finds its place by its rank among the pieces of its length. The plan
covers every piece, and its size does not depend on how many there are.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import POSITION, part_of, positioned, row_in_part
from touchline.llm.tokens import encoder_for, ranges, read_definition
from touchline.sources.scratch import staged

MAX_TOKENS = 2048


@dataclass(frozen=True)
class Capacity:
    """Limits of one sequence, weights of the three measures, and the rule that picks among fitting sequences.

    ``norm`` takes the one whose residual after the piece is shortest, ``dot``
    the one whose residual has the largest product with the piece; measures
    are taken as shares of their limits.
    """

    tokens: int = MAX_TOKENS
    documents: int = MAX_TOKENS
    cost: int = MAX_TOKENS * MAX_TOKENS
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0)
    rule: str = "norm"

    def limits(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.cost], np.int64)


def plan(counts: Iterable[tuple[int, int]], capacity: Capacity = Capacity()) -> list[tuple[int, list[tuple[int, int]]]]:
    """``(number of sequences, [(length, pieces of it)])`` for the pieces counted in ``(length, count)``.

    Lengths go from long to short. Sequences with the same content are one
    group; a piece goes to the best group that it fits under every limit, with
    as many of its kind as fit, and to a new sequence when it fits none.
    """
    limits, weights = capacity.limits(), np.array(capacity.weights)
    left = np.zeros((0, 3), np.int64)  # residual of each group
    number = np.zeros(0, np.int64)
    content: list[list[tuple[int, int]]] = []
    for length, count in sorted(counts, reverse=True):
        need = np.array([length, 1, length * length], np.int64)
        most = int(np.min(limits[need > 0] // need[need > 0]))
        if most < 1:
            raise ValueError(f"a piece of {length} tokens does not fit an empty sequence")
        share = need / limits
        fits = np.flatnonzero((left >= need).all(axis=1) & (number > 0))
        after = left[fits] / limits - share
        score = (weights * after**2).sum(axis=1) if capacity.rule == "norm" else -(weights * (after + share) * share).sum(axis=1)
        added: list[tuple[np.ndarray, int, list]] = []
        for group in fits[np.argsort(score, kind="stable")]:
            if not count:
                break
            each = int(np.min(left[group][need > 0] // need[need > 0]))
            full = min(int(number[group]), count // each)
            for sequences, pieces in ((full, each), (int(number[group]) > full and 1, count - full * each)):
                pieces = min(pieces, each, count)
                if sequences and pieces:
                    number[group] -= sequences
                    count -= sequences * pieces
                    added.append((left[group] - pieces * need, sequences, [*content[group], (length, pieces)]))
        if count >= most:
            added.append((limits - most * need, count // most, [(length, most)]))
        if count % most:
            added.append((limits - count % most * need, 1, [(length, count % most)]))
        left = np.concatenate([left, *(a[0][None] for a in added)])
        number = np.concatenate([number, np.array([a[1] for a in added], np.int64)])
        content += [a[2] for a in added]
    return [(int(n), c) for n, c in zip(number, content, strict=True) if n]


def places(patterns: list[tuple[int, list[tuple[int, int]]]]) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length, ordered by first rank: that rank, pieces per sequence, first sequence id, offset of the first piece."""
    found: dict[int, list[list[int]]] = {}
    first = 0
    for number, content in patterns:
        offset = 0
        for length, pieces in content:
            spans = found.setdefault(length, [[0, 0, 0, 0]])
            spans[-1][3:4] = [offset]
            spans[-1][1:3] = [pieces, first]
            spans.append([spans[-1][0] + number * pieces, 0, 0, 0])
            offset += length * pieces
        first += number
    return {length: tuple(np.array(spans[:-1], np.int64).T) for length, spans in found.items()}


def pack(pieces: DataFrame, *order: str, capacity: Capacity = Capacity(), length: str = "length") -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``.

    ``length`` must lie between 1 and the token limit; ``order`` names columns
    that tell rows apart (rows alike in all of them are interchangeable).
    Columns of the two names are replaced, all others stay. Sequences have no
    gaps. An empty table gives an empty table.
    """
    pieces = pieces.drop("sequence_id", "offset")
    stored = positioned(pieces, F.col(length).desc(), *order)
    part, row = part_of(F.col(POSITION)).alias("part"), row_in_part(F.col(POSITION)).alias("row")
    grouped = stored.select(F.col(length).alias("length"), part, row).groupBy("length", "part")
    # Ranges are ordered by length: at most one row per length and one more per partition.
    spans = grouped.agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")).collect()
    totals: dict[int, int] = {}
    ranks: dict[tuple[int, int], int] = {}
    for size, where, first, n in sorted((r["length"], r["part"], r["first"], r["n"]) for r in spans):
        ranks[size, where] = totals.get(size, 0) - first
        totals[size] = totals.get(size, 0) + n
    shared = pieces.sparkSession.sparkContext.broadcast((ranks, places(plan(totals.items(), capacity))))

    @F.arrow_udf("struct<sequence_id:bigint,offset:bigint>")
    def placed(lengths: pa.Array, parts: pa.Array, rows: pa.Array) -> pa.Array:
        base, where = shared.value
        sizes, numbers, rank = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in (lengths, parts, rows))
        sequence, offset = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
        kinds, inverse = np.unique(np.stack([sizes, numbers]), axis=1, return_inverse=True)
        inverse = inverse.reshape(-1)
        for k in range(kinds.shape[1]):
            size, number = int(kinds[0, k]), int(kinds[1, k])
            own = np.flatnonzero(inverse == k)
            at = rank[own] + base[size, number]
            starts, each, first, begin = where[size]
            span = np.searchsorted(starts, at, side="right") - 1
            inside = at - starts[span]
            sequence[own] = first[span] + inside // each[span]
            offset[own] = begin[span] + inside % each[span] * size
        return pa.StructArray.from_arrays([pa.array(sequence), pa.array(offset)], ["sequence_id", "offset"])

    place = placed(F.col(length), part_of(F.col(POSITION)), row_in_part(F.col(POSITION))).alias("__llm_place")
    return stored.select(*pieces.columns, place).select(*[F.col(f"`{c}`") for c in pieces.columns], "__llm_place.*")


def token_pieces(
    docs: DataFrame,
    tokenizer_path: str,
    end_id: int = 0,
    max_tokens: int = MAX_TOKENS,
    key: str = "doc_id",
    text: str = "text",
    with_ids: bool = False,
) -> DataFrame:
    """Encode, end every document with ``end_id`` and cut it into pieces of ``max_tokens``; the first may be shorter.

    Per piece: key, ``piece``, ``start`` (ids of its document before it),
    ``length``, ``ids_crc32`` over its ids as little-endian unsigned 32-bit
    integers, and with ``with_ids`` those bytes as ``ids``. A null text counts
    as empty and so has the end id alone. Repeated rows give repeated pieces.
    """
    definition = docs.sparkSession.sparkContext.broadcast(read_definition(tokenizer_path))
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zlib

        for batch in batches:
            offsets, ids = encoder_for(definition.value).encode(batch.column(1))
            sizes = np.diff(offsets) + 1
            flat = np.insert(ids, offsets[1:], end_id).astype("<u4", copy=False)
            number = -(-sizes // max_tokens)
            owner = np.repeat(np.arange(len(sizes)), number)
            piece = ranges(np.zeros(len(sizes), np.int64), number)
            short = sizes - (number - 1) * max_tokens
            start = np.where(piece == 0, 0, short[owner] + (piece - 1) * max_tokens)
            length = np.where(piece == 0, short[owner], max_tokens)
            begin = (np.cumsum(sizes) - sizes)[owner] + start
            whole = memoryview(flat).cast("B")
            views = [whole[4 * a : 4 * (a + n)] for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
            columns = {
                key: batch.column(0).take(pa.array(owner)),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array(start, pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(v) for v in views], pa.int64()),
            }
            if with_ids:
                columns["ids"] = pa.array([bytes(v) for v in views], pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    more = ", ids binary" if with_ids else ""
    schema = f"`{key}` {kind}, piece int, start long, length long, ids_crc32 long{more}"
    return docs.select(key, text).mapInArrow(cut, schema)


def pack_documents(
    docs: DataFrame, tokenizer_path: str, end_id: int = 0, capacity: Capacity = Capacity(), key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """The pieces of all documents with their sequence and their place in it."""
    # Stored, because dealing them out reads them twice: once for the ranges, once for the rows.
    pieces = staged(token_pieces(docs, tokenizer_path, end_id, capacity.tokens, key, text), "pieces")
    return pack(pieces, key, "piece", "ids_crc32", capacity=capacity)
