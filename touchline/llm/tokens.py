"""Byte-pair encoding of whole texts, one distinct word at a time.

Spaces end every piece that a pre-tokeniser makes, so a text may be cut before
a space and the parts encoded alone. The library then encodes each distinct
word of a batch once, and a bounded table keeps words between batches; the
result is the library's own. A text where such a cut could change the result
(a space between other white space, the name of a special token) goes to the
library whole.
"""

from __future__ import annotations

import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_WHITE = r"[\t\n\x0B\f\r \x{85}\x{A0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_UNSAFE = rf"{_WHITE} (?:{_WHITE}|\z)"
_KEPT_WORDS = 1_600_000
_KEPT_BYTES = 32 << 20
_BATCH_BYTES = 8 << 20
_CALL_WORDS = 16_384
_DIRECT_BYTES = 1 << 17
_SPACES_MEET = re.compile(r"\s\s|\s\Z")
_SEPARATOR = "\x00"
_ENCODERS: dict[str, WordEncoder] = {}


def library_tokenizer(definition: str):
    """The tokenizer of a JSON definition, without truncation, padding and threads of its own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(definition)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def read_definition(path: str) -> str:
    """The definition file, read on the driver; tasks get its text, so only the driver needs the file."""
    with open(path, encoding="utf-8") as file:
        return file.read()


def encoder_for(definition: str) -> WordEncoder:
    """One encoder per worker process and definition."""
    if definition not in _ENCODERS:
        _ENCODERS[definition] = WordEncoder(definition)
    return _ENCODERS[definition]


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """``starts[i], starts[i] + 1, ...`` for ``lengths[i]`` steps each, one after another."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - lengths), lengths) + np.arange(total)


def _joined(words: pa.Array, separator: str) -> str:
    """The words as one text; they become no Python strings of their own."""
    return pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(words)], pa.int32()), words), separator)[0].as_py()


class WordEncoder:
    """Encodes Arrow string arrays; see the module's text."""

    def __init__(self, definition: str) -> None:
        from tokenizers import pre_tokenizers

        # What the tokenizer knows is asked of it: the parsed definition would take more room than the tokenizer.
        self.tokenizer = library_tokenizer(definition)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._joins_space = isinstance(self.tokenizer.pre_tokenizer, pre_tokenizers.ByteLevel)
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        # In a byte-level vocabulary the space is written as this letter; only a word's first token has it in front.
        self._opens = np.zeros(max(vocabulary.values()) + 1, bool)
        self._opens[[i for token, i in vocabulary.items() if token.startswith("\u0120")]] = True
        self._separator = self.tokenizer.encode(_SEPARATOR, add_special_tokens=False).ids
        self._forget()

    def _forget(self) -> None:
        self._words, self._starts, self._sizes = pa.array([], pa.string()), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._pool = np.zeros(0, np.uint32)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Offsets (one more than texts) and the ids of all texts, nulls as empty texts."""
        texts = pc.fill_null(texts, "")
        if len(texts) == 0:
            return np.zeros(1, np.int64), np.zeros(0, np.uint32)
        if texts.nbytes < _DIRECT_BYTES:  # looking words up costs more than it saves
            sizes, ids = self._encode_alone(texts.to_pylist())
            return np.concatenate([[0], np.cumsum(sizes)]), ids
        offsets, ids = self._in_batches(texts)
        whole = np.flatnonzero(self._whole(texts).to_numpy(zero_copy_only=False))
        if len(whole) == 0:
            return offsets, ids
        parts = [ids[offsets[i] : offsets[i + 1]] for i in range(len(texts))]
        for i in whole:
            parts[i] = np.array(self.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, np.uint32)
        sizes = np.array([len(p) for p in parts], np.int64)
        return np.concatenate([[0], np.cumsum(sizes)]), np.concatenate(parts)

    def _in_batches(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        offsets, ids, at = [np.zeros(1, np.int64)], [], 0
        while at < len(texts):
            begun = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, begun + _BATCH_BYTES, side="right")))
            found, flat = self._by_word(texts.slice(at, stop - at))
            offsets.append(found[1:] + offsets[-1][-1])
            ids.append(flat)
            at = stop
        pa.default_memory_pool().release_unused()  # a worker lives on after its task
        return np.concatenate(offsets), np.concatenate(ids)

    def _whole(self, texts: pa.Array) -> pa.Array:
        found = pc.match_substring_regex(texts, _UNSAFE)
        for name in self.special:
            found = pc.or_(found, pc.match_substring(texts, name))
        return found

    def _by_word(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        split = pc.split_pattern(texts, " ")
        counts = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
        distinct = split.flatten().dictionary_encode()
        words, codes = distinct.dictionary, distinct.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        starts = np.cumsum(counts) - counts
        at, sizes, pool = self._known(words)
        if self._joins_space:  # a word carries the space before it; the first of a text has none
            first, place = np.unique(codes[starts], return_inverse=True)
            codes[starts] = len(words) + place
            more, ids = self._encode_alone(words.take(pa.array(first)).to_pylist())
            at = np.concatenate([at, len(pool) + np.cumsum(more) - more])
            sizes, pool = np.concatenate([sizes, more]), np.concatenate([pool, ids])
        lengths = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        return ends[np.concatenate([starts, [len(codes)]])], pool[ranges(at[codes], lengths)]

    def _known(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where the ids of each word start in the pool, how many there are, and the pool."""
        found = pc.index_in(words, value_set=self._words)
        if len(self._words) + found.null_count > _KEPT_WORDS or self._words.nbytes > _KEPT_BYTES:
            self._forget()
            found = pc.index_in(words, value_set=self._words)
        if found.null_count:
            missing = words.filter(pc.is_null(found))
            parts = [self._encode_words(missing.slice(i, _CALL_WORDS)) for i in range(0, len(missing), _CALL_WORDS)]
            sizes = np.concatenate([p[0] for p in parts])
            known = len(self._words)
            self._starts = np.concatenate([self._starts, len(self._pool) + np.cumsum(sizes) - sizes])
            self._sizes = np.concatenate([self._sizes, sizes])
            self._pool = np.concatenate([self._pool, *(p[1] for p in parts)])
            self._words = pa.concat_arrays([self._words, missing])
            place = found.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
            place[place < 0] = known + np.arange(len(missing))
        else:
            place = found.to_numpy(zero_copy_only=False)
        return self._starts[place], self._sizes[place], self._pool

    def _encode_words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Sizes and ids of words as they stand inside a text. They go to the library as one text and are told apart again."""
        if self._joins_space:
            joined = " " + _joined(words, " ")
            if not _SPACES_MEET.search(joined):
                ids = self._encode_alone([joined])[1]
                starts = np.flatnonzero(self._opens[ids])
                if len(starts) == len(words) and starts[0] == 0:
                    return np.diff(np.append(starts, len(ids))), ids
            return self._encode_alone([" " + w for w in words.to_pylist()])
        joined = _joined(words, f" {_SEPARATOR} ")
        if len(self._separator) == 1 and joined.count(_SEPARATOR) == len(words) - 1:
            ids = self._encode_alone([joined])[1]
            marks = ids == self._separator[0]
            if marks.sum() == len(words) - 1:
                ends = np.append(np.flatnonzero(marks), len(ids))
                return np.diff(np.append(-1, ends)) - 1, ids[~marks]
        return self._encode_alone(words.to_pylist())

    def _encode_alone(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        got = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        return sizes, np.fromiter(chain.from_iterable(got), np.uint32, int(sizes.sum()))
