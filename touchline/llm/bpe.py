"""Byte-pair encoding and decoding of texts of any length.

A text longer than a leaf is cut in halves, again and again, the leaves are
encoded in parallel tasks, and the encodings are joined up the tree. Around
each join a window is encoded anew; it grows until its first token is the left
side's own and its last token the right side's own. Two encodings that agree
at such tokens can be joined there, because a byte-pair encoding is right
exactly if each pair of neighbouring tokens is.

Cuts lie before a space wherever a leaf has one. Only text that the
pre-tokeniser itself leaves unsplit for longer than a leaf is cut inside; it
is brought to the symbols of the model first, so that the model alone decides.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.llm.common import shuffle_width
from touchline.llm.tokens import encoder_for, read_definition

LEAF_CHARS = 16_384
_KEY = "__llm_text_key"
_CODED = "__llm_coded"
# A cut before this space is one that no white space, mark or joined letter reaches across.
_CUT = re.compile(r"(?<=[^\s]) (?=[^\W_])")
_PLAIN, _INNER, _LAST = 0, 1, 2  # a run of words; a fragment inside a piece; the last fragment of a piece
_LEAF_SCHEMA = f"{_KEY} string, leaf int, kind int, content string"
_DECODED_IDS = 1 << 16
_MODELS: dict[str, tuple] = {}


def halves(text: str, leaf: int) -> list[str]:
    """The leaves of the binary tree over ``text``: cut in the middle while longer than ``leaf``.

    The cut is the safe one nearest after the middle, else nearest before it;
    a part without any is kept whole.
    """
    todo, leaves = [text], []
    while todo:
        part = todo.pop()
        middle = len(part) // 2
        if len(part) <= leaf:
            leaves.append(part)
            continue
        found = _CUT.search(part, middle)
        at = found.start() if found else max((m.start() for m in _CUT.finditer(part, 0, middle)), default=0)
        if at <= 0:
            leaves.append(part)
        else:
            todo += [part[at:], part[:at]]
    return leaves


def model_of(definition: str):
    """``(model without word ends, model, suffix)`` of a definition, one per worker process that meets fragments."""
    if definition not in _MODELS:
        from tokenizers import Tokenizer, models

        parts = json.loads(definition)
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parts["model"]["merges"]]
        suffix = parts["model"].get("end_of_word_suffix") or None
        inner = final = Tokenizer(models.BPE(vocab=parts["model"]["vocab"], merges=merges))
        if suffix:
            final = Tokenizer(models.BPE(vocab=parts["model"]["vocab"], merges=merges, end_of_word_suffix=suffix))
        _MODELS.clear()
        _MODELS[definition] = (inner.model, final.model, suffix)
    return _MODELS[definition]


def leaves_of(text: str, definition: str, leaf: int) -> Iterator[tuple[int, str]]:
    """``(kind, content)`` of the leaves in order; see the module's text."""
    special = encoder_for(definition).special
    for part in halves(text, leaf):
        if len(part) <= leaf or any(name in part for name in special):
            yield _PLAIN, part
            continue
        tokenizer = encoder_for(definition).tokenizer
        normal = tokenizer.normalizer.normalize_str(part) if tokenizer.normalizer else part
        for symbols, _span in tokenizer.pre_tokenizer.pre_tokenize_str(normal):
            pieces = [symbols]
            while max(map(len, pieces)) > leaf:
                pieces = [half for p in pieces for half in (p[: len(p) // 2], p[len(p) // 2 :]) if half]
            yield from ((_INNER, p) for p in pieces[:-1])
            yield _LAST, pieces[-1]


def join_fragments(left: list[str], right: list[str], inner, final, suffix: str | None) -> list[str]:
    """Tokens of two neighbouring fragments of one piece, given the tokens of each.

    The window doubles until both sides agree; when it covers both fragments
    its encoding is the answer as it stands.
    """
    width = 2
    while True:
        a, b = min(width, len(left)), min(width, len(right))
        ends = b == len(right) and suffix is not None and right[-1].endswith(suffix)
        text = "".join(left[-a:]) + "".join(right[:b])
        window = [t.value for t in (final if ends else inner).tokenize(text.removesuffix(suffix) if ends else text)]
        if (a == len(left) or window[0] == left[-a]) and (b == len(right) or window[-1] == right[b - 1]):
            return left[:-a] + window + right[b:]
        width *= 2


def join_plain(left: tuple[str, np.ndarray], right: tuple[str, np.ndarray], encode: Callable) -> tuple[str, np.ndarray]:
    """Text and ids of two neighbouring runs of words.

    The window starts with the words next to the join and doubles until its
    first and last tokens are those of the two sides.
    """
    (before, ids), (after, more) = left, right
    width = 1
    while True:
        head = _back(before, width)
        end = _ahead(after, width)
        tail, front, window = encode(before[head:]), encode(after[:end]), encode(before[head:] + after[:end])
        starts = head == 0 or (len(tail) and len(window) and window[0] == tail[0])
        stops = end == len(after) or (len(front) and len(window) and window[-1] == front[-1])
        if starts and stops:
            return before + after, np.concatenate([ids[: len(ids) - len(tail)], window, more[len(front) :]])
        width *= 2


def _back(text: str, words: int) -> int:
    """Start of the last so many words; zero when there are fewer."""
    at = len(text)
    for _ in range(words):
        at = text.rfind(" ", 0, at)
        while at > 0 and not _CUT.match(text, at):
            at = text.rfind(" ", 0, at)
        if at <= 0:
            return 0
    return at


def _ahead(text: str, words: int) -> int:
    """End of the first so many words; the text's length when there are fewer."""
    at = 0
    for _ in range(words):
        found = _CUT.search(text, at + 1)
        if not found:
            return len(text)
        at = found.start()
    return at


def encode_leaves(leaves: list[tuple[int, str]], definition: str) -> list[np.ndarray]:
    """Ids of each leaf alone."""
    plain = [content for kind, content in leaves if kind == _PLAIN]
    offsets, ids = encoder_for(definition).encode(pa.array(plain, pa.string()))
    runs = iter(np.split(ids, offsets[1:-1]) if plain else [])
    inner, final, _suffix = model_of(definition) if len(plain) < len(leaves) else (None, None, None)
    models = {_INNER: inner, _LAST: final}
    return [
        next(runs) if kind == _PLAIN else np.array([t.id for t in models[kind].tokenize(content)], np.uint32)
        for kind, content in leaves
    ]


def join_leaves(leaves: list[tuple[int, str, np.ndarray]], definition: str) -> np.ndarray:
    """Ids of one text from its encoded leaves in order, joined pair by pair up the tree."""
    tokenizer = encoder_for(definition).tokenizer
    encode = lambda text: encoder_for(definition).encode(pa.array([text]))[1]

    def up(nodes: list, join: Callable):
        while len(nodes) > 1:
            pairs = [nodes[i : i + 2] for i in range(0, len(nodes), 2)]
            nodes = [join(*p) if len(p) == 2 else p[0] for p in pairs]
        return nodes[0]

    out, plain, piece = [], [], []
    for kind, content, ids in [*leaves, (None, "", None)]:
        if kind == _PLAIN:
            plain.append((content, ids))
            continue
        if plain:
            out.append(up(plain, lambda a, b: join_plain(a, b, encode))[1])
            plain = []
        if kind is not None:
            piece.append([tokenizer.id_to_token(int(i)) for i in ids])
        if kind == _LAST:
            inner, final, suffix = model_of(definition)
            tokens = up(piece, lambda a, b: join_fragments(a, b, inner, final, suffix))
            out.append(np.array([tokenizer.token_to_id(t) for t in tokens], np.uint32))
            piece = []
    return np.concatenate(out) if out else np.zeros(0, np.uint32)


def _id_lists(offsets: np.ndarray, ids: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int32)))


def _decoded(lists: pa.Array, definition: str) -> pa.Array:
    """Texts of lists of ids; null lists give empty ones. A call of the library gets ``_DECODED_IDS`` ids, or one list."""
    tokenizer, texts = encoder_for(definition).tokenizer, []
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < len(lists):
        begun = int(ends[at - 1]) if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, begun + _DECODED_IDS, side="right")))
        rows = [[] if x is None else x.tolist() for x in lists.slice(at, stop - at).to_numpy(zero_copy_only=False)]
        texts.append(pa.array(tokenizer.decode_batch(rows, skip_special_tokens=False), pa.string()))
        at = stop
    return pa.concat_arrays(texts) if texts else pa.array([], pa.string())


def encode(
    df: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    ids: str = "ids",
    leaf: int = LEAF_CHARS,
    decoded: str | None = None,
    derived: Callable[[DataFrame], DataFrame] = lambda coded: coded,
) -> DataFrame:
    """``df`` with the token ids of ``text`` as an int array in the column ``ids``.

    Equal to the library's ``encode(text, add_special_tokens=False)``. A null
    text counts as empty and gets no ids; so does the empty text. Rows may
    repeat, and all other columns stay as they are; a column of the name
    ``ids`` is replaced. An empty table gives an empty table. With ``decoded``
    the ids are decoded as well, into a column of that name; a text that is one
    leaf is then encoded and decoded by the same worker, with one tokenizer.
    ``derived`` replaces ids and decoded text by what is wanted of them; for
    long texts it does so before their rows are joined, so no ids are shuffled.
    """
    definition = df.sparkSession.sparkContext.broadcast(read_definition(tokenizer_path))
    body = F.coalesce(F.col(text), F.lit(""))
    df = df.drop(ids) if ids != text else df

    @F.arrow_udf("array<int>")
    def whole(texts: pa.Array) -> pa.Array:
        return _id_lists(*encoder_for(definition.value).encode(texts))

    @F.arrow_udf("struct<ids:array<int>,decoded:string>")
    def both(texts: pa.Array) -> pa.Array:
        lists = _id_lists(*encoder_for(definition.value).encode(texts))
        return pa.StructArray.from_arrays([lists, _decoded(lists, definition.value)], ["ids", "decoded"])

    short, long = df.where(F.length(body) <= leaf), df.where(F.length(body) > leaf).withColumn(_KEY, F.sha2(body, 256))
    long = long.join(derived(_long_ids(long, text, ids, definition, leaf, decoded)), _KEY).drop(_KEY)
    if decoded is None:
        return derived(short.withColumn(ids, whole(body))).unionByName(long)
    coded = short.withColumn(_CODED, both(body)).withColumns({ids: F.col(f"{_CODED}.ids"), decoded: F.col(f"{_CODED}.decoded")})
    return derived(coded.drop(_CODED)).unionByName(long)


def _long_ids(long: DataFrame, text: str, ids: str, definition, leaf: int, decoded: str | None) -> DataFrame:
    """``(key, ids)``, if wanted with the decoded text, per distinct long text: leaves dealt over the tasks, then one small group per text."""

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                kinds, parts = zip(*leaves_of(content, definition.value, leaf), strict=True)
                n = len(parts)
                yield pa.RecordBatch.from_pydict(
                    {
                        _KEY: pa.array([key] * n),
                        "leaf": pa.array(range(n), pa.int32()),
                        "kind": pa.array(kinds, pa.int32()),
                        "content": pa.array(parts, pa.string()),
                    }
                )

    @F.arrow_udf("array<int>")
    def one(kinds: pa.Array, contents: pa.Array) -> pa.Array:
        got = encode_leaves(list(zip(kinds.to_pylist(), contents.to_pylist(), strict=True)), definition.value)
        return _id_lists(np.cumsum([0, *map(len, got)]), np.concatenate([np.zeros(0, np.uint32), *got]))

    def join(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("leaf")
        leaves = zip(
            rows["kind"].to_pylist(),
            rows["content"].to_pylist(),
            [np.array(x.values.to_numpy(), np.uint32) for x in rows["ids"]],
            strict=True,
        )
        got = join_leaves(list(leaves), definition.value)
        lists = _id_lists(np.array([0, len(got)]), got)
        found = {_KEY: [key[0].as_py()], ids: lists}
        return pa.table(found if decoded is None else found | {decoded: _decoded(lists, definition.value)})

    # Texts are cut where they are read, so only leaves are shuffled; those of repeated texts meet and count once.
    leaves = long.select(_KEY, text).mapInArrow(split, _LEAF_SCHEMA).repartition(shuffle_width(long.sparkSession), _KEY, "leaf")
    leaves = leaves.dropDuplicates([_KEY, "leaf"])
    encoded = leaves.withColumn("ids", one("kind", "content"))
    schema = f"{_KEY} string, `{ids}` array<int>" + (f", `{decoded}` string" if decoded else "")
    return encoded.groupBy(_KEY).applyInArrow(join, schema)


def decode(df: DataFrame, tokenizer_path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """``df`` with the library's ``decode(ids, skip_special_tokens=False)`` in ``text``; null ids give an empty text."""
    definition = df.sparkSession.sparkContext.broadcast(read_definition(tokenizer_path))

    @F.arrow_udf("string")
    def whole(lists: pa.Array) -> pa.Array:
        return _decoded(lists, definition.value)

    return df.withColumn(text, whole(F.col(ids)))


def digests(df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text", leaf: int = LEAF_CHARS) -> DataFrame:
    """Per row of ``key``: number of ids, and SHA-256 of the ids in decimal and of the decoded text."""
    joined = F.array_join(F.col("ids").cast("array<string>"), " ")
    columns = {
        "n_tokens": F.size("ids").cast("bigint"),
        "ids_sha256": F.sha2(joined, 256),
        "decoded_sha256": F.sha2("decoded", 256),
    }
    digested = lambda coded: coded.withColumns(columns).drop("ids", "decoded")
    return encode(df.select(key, text), tokenizer_path, text, "ids", leaf, "decoded", digested).select(key, *columns)
